"""DuckDB SQL for every registered query (the correctness oracle).

Each text runs on DuckDB with the driver's parquet tables registered as views.  The SQL is
written independently of the Spark code: holidays come from a generated date table, regions
from a crossing count over every edge, the geodesic from an unrolled iteration (the stations lie
close together, where it always settles).
"""

from __future__ import annotations

from tripflow.functions.geo import WGS84_A, WGS84_B, WGS84_F
from tripflow.functions.timefn import DETECT_FORMATS
from tripflow.operators.profile import poisson_cuts
from tripflow.operators.rollup import HOURLY_CONDITIONAL_COUNTS
from tripflow.queries import (BOOTSTRAP_REPLICATES, CHAIN_EPS, CHAIN_MIN_SAMPLES, CHAIN_YEAR, DBSCAN_EPS, DBSCAN_MIN_SAMPLES,
                              DBSCAN_SWEEP, EVENT_DOC, K_DISTANCE_K, KMEANS_ROUNDS, KMEANS_START, NESTED_DOC, NESTED_SCHEMA, PASADENA_REGION,
                              QUALITY_LABEL_MOD, CATEGORY_COLUMNS, CI_CATEGORIES, HOURLY_NUMERIC,
                              TAG_REGIONS, TRIP_REGIONS)
from tripflow.schema import DESCRIBE_COLUMNS, STATS_COLUMNS, TRIP_CATEGORY_DECODINGS, TRIP_CATEGORY_ENCODINGS
from tripflow.sources.adapter import TRIPS_FROM_ORDERS_SQL

RAW_TRIPS = TRIPS_FROM_ORDERS_SQL.replace("{orders}", "orders")

_MDY = r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}"
_YMD = r"\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}"


def parse_time(s: str) -> str:
    return (f"(CASE WHEN regexp_full_match({s}, '{_MDY}') THEN try_strptime({s}, '%m/%d/%Y %H:%M') "
            f"WHEN regexp_full_match({s}, '{_YMD}') THEN try_strptime({s}, '%Y-%m-%d %H:%M:%S') END)")


def season(d: str) -> str:
    m, dd = f"month({d})", f"day({d})"
    return (f"(CASE WHEN {m} IN (1, 2) THEN 1 WHEN {m} = 3 THEN (CASE WHEN {dd} < 21 THEN 1 ELSE 2 END) "
            f"WHEN {m} IN (4, 5) THEN 2 WHEN {m} = 6 THEN (CASE WHEN {dd} < 21 THEN 2 ELSE 3 END) "
            f"WHEN {m} IN (7, 8) THEN 3 WHEN {m} = 9 THEN (CASE WHEN {dd} < 21 THEN 3 ELSE 4 END) "
            f"WHEN {m} IN (10, 11) THEN 4 WHEN {m} = 12 THEN (CASE WHEN {dd} < 21 THEN 4 ELSE 1 END) END)")


# Holiday dates for 1980..2099 generated from the calendar rules, observed days included.
HOLIDAYS_CTE = """
hy AS (SELECT CAST(range AS INTEGER) AS y FROM range(1980, 2100)),
hfixed AS (
  SELECT make_date(y, f.m, f.d) AS hd FROM hy, (VALUES (1, 1), (7, 4), (11, 11), (12, 25)) f(m, d)
  UNION ALL SELECT make_date(y, 6, 19) FROM hy WHERE y >= 2021),
hobs AS (
  SELECT CASE isodow(hd) WHEN 6 THEN hd - 1 ELSE hd + 1 END AS hd FROM hfixed WHERE isodow(hd) IN (6, 7)),
hfloat AS (
  SELECT make_date(y, r.m, 1) + CAST((r.wd - isodow(make_date(y, r.m, 1)) + 7) % 7 + 7 * (r.n - 1) AS INTEGER) AS hd
  FROM hy, (VALUES (1, 1, 3), (2, 1, 3), (9, 1, 1), (10, 1, 2), (11, 4, 4)) r(m, wd, n)
  UNION ALL
  SELECT make_date(y, 5, 31) - CAST((isodow(make_date(y, 5, 31)) - 1 + 7) % 7 AS INTEGER) FROM hy),
holidays AS (SELECT DISTINCT hd FROM (SELECT hd FROM hfixed UNION ALL SELECT hd FROM hobs UNION ALL SELECT hd FROM hfloat))
"""


def holiday(d: str) -> str:
    return f"(CASE WHEN {d} IS NULL THEN NULL WHEN CAST({d} AS DATE) IN (SELECT hd FROM holidays) THEN 1 ELSE 0 END)"


def workingday(d: str) -> str:
    return (f"(CASE WHEN {d} IS NULL THEN NULL WHEN isodow(CAST({d} AS DATE)) <= 5 AND "
            f"CAST({d} AS DATE) NOT IN (SELECT hd FROM holidays) THEN 1 ELSE 0 END)")


def hour_flags(hour: str) -> str:
    moe = f"({hour} BETWEEN 6 AND 9 OR {hour} BETWEEN 16 AND 19)"
    noon = f"({hour} BETWEEN 11 AND 13)"
    return (f"CAST(CASE WHEN {moe} THEN 1 ELSE 0 END AS INTEGER) AS hour_is_morning_evening, "
            f"CAST(CASE WHEN NOT {moe} AND {noon} THEN 1 ELSE 0 END AS INTEGER) AS hour_is_noon, "
            f"CAST(CASE WHEN NOT {moe} AND NOT {noon} THEN 1 ELSE 0 END AS INTEGER) AS hour_is_idle")


def edges_values(regions) -> str:
    rows = []
    for name, parts in regions:
        for rings in parts:
            for ring in rings:
                pts = list(ring)
                n = len(pts)
                for i in range(n):
                    (x1, y1), (x2, y2) = pts[i], pts[(i + 1) % n]
                    rows.append(f"('{name}', CAST({x1!r} AS DOUBLE), CAST({y1!r} AS DOUBLE), "
                                f"CAST({x2!r} AS DOUBLE), CAST({y2!r} AS DOUBLE))")
    return "(VALUES " + ", ".join(rows) + ") e(name, x1, y1, x2, y2)"


def region_tags_cte(points: str, regions) -> str:
    """CTE body: (px, py, region) for points strictly inside a region."""
    return f"""
SELECT px, py, min(name) AS region FROM (
  SELECT p.px, p.py, e.name,
    max(CASE WHEN (e.x2 - e.x1) * (p.py - e.y1) - (e.y2 - e.y1) * (p.px - e.x1) = 0
              AND p.px BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
              AND p.py BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2) THEN 1 ELSE 0 END) AS on_edge,
    sum(CASE WHEN (e.y1 > p.py) <> (e.y2 > p.py)
              AND p.px < (e.x2 - e.x1) * (p.py - e.y1) / (e.y2 - e.y1) + e.x1 THEN 1 ELSE 0 END) AS crossings
  FROM {points} p CROSS JOIN {edges_values(regions)}
  GROUP BY p.px, p.py, e.name) c
WHERE on_edge = 0 AND crossings % 2 = 1
GROUP BY px, py"""


def vincenty_ctes(src: str, prefix: str = "v") -> tuple[list[str], str]:
    """CTEs computing ``dist_m`` for rows (lat1, lon1, lat2, lon2) of ``src``."""
    f, a, b = repr(WGS84_F), repr(WGS84_A), repr(WGS84_B)
    base = "lat1, lon1, lat2, lon2, big_l, su1, cu1, su2, cu2"
    ctes = [
        f"{prefix}0 AS (SELECT lat1, lon1, lat2, lon2, radians(lon2) - radians(lon1) AS big_l, "
        f"atan((1 - {f}) * tan(radians(lat1))) AS u1, atan((1 - {f}) * tan(radians(lat2))) AS u2 FROM {src})",
        f"{prefix}1 AS (SELECT lat1, lon1, lat2, lon2, big_l, sin(u1) AS su1, cos(u1) AS cu1, sin(u2) AS su2, "
        f"cos(u2) AS cu2, big_l AS lam, big_l + 1.0 AS prev FROM {prefix}0)",
    ]
    sa = "(CASE WHEN ss = 0 THEN 0.0 ELSE cu1 * cu2 * sin(lam) / ss END)"
    c2a = f"(1 - {sa} * {sa})"
    c2sm = f"(CASE WHEN {c2a} = 0 THEN 0.0 ELSE cs - 2 * su1 * su2 / {c2a} END)"
    cc = f"({f} / 16 * {c2a} * (4 + {f} * (4 - 3 * {c2a})))"
    prev = f"{prefix}1"
    for i in range(20):
        x, y = f"{prefix}x{i}", f"{prefix}y{i}"
        ctes.append(f"{x} AS (SELECT *, sqrt(pow(cu2 * sin(lam), 2) + pow(cu1 * su2 - su1 * cu2 * cos(lam), 2)) AS ss, "
                    f"su1 * su2 + cu1 * cu2 * cos(lam) AS cs FROM {prev})")
        new_lam = (f"big_l + (1 - {cc}) * {f} * {sa} * (atan2(ss, cs) + {cc} * ss * "
                   f"({c2sm} + {cc} * cs * (-1 + 2 * {c2sm} * {c2sm})))")
        ctes.append(f"{y} AS (SELECT {base}, CASE WHEN ss = 0 THEN lam ELSE {new_lam} END AS lam, lam AS prev FROM {x})")
        prev = y
    fx = f"{prefix}fx"
    ctes.append(f"{fx} AS (SELECT *, sqrt(pow(cu2 * sin(lam), 2) + pow(cu1 * su2 - su1 * cu2 * cos(lam), 2)) AS ss, "
                f"su1 * su2 + cu1 * cu2 * cos(lam) AS cs FROM {prev})")
    usq = f"({c2a} * ({a} * {a} - {b} * {b}) / ({b} * {b}))"
    big_a = f"(1 + {usq} / 16384 * (4096 + {usq} * (-768 + {usq} * (320 - 175 * {usq}))))"
    big_b = f"({usq} / 1024 * (256 + {usq} * (-128 + {usq} * (74 - 47 * {usq}))))"
    dsig = (f"({big_b} * ss * ({c2sm} + {big_b} / 4 * (cs * (-1 + 2 * {c2sm} * {c2sm}) - {big_b} / 6 * {c2sm} "
            f"* (-3 + 4 * ss * ss) * (-3 + 4 * {c2sm} * {c2sm}))))")
    s = f"({b} * {big_a} * (atan2(ss, cs) - {dsig}))"
    out = f"{prefix}out"
    ctes.append(f"{out} AS (SELECT lat1, lon1, lat2, lon2, CASE WHEN ss = 0 THEN 0.0 "
                f"WHEN abs(lam - prev) < 1e-12 THEN {s} END AS dist_m FROM {fx})")
    return ctes, out


def _enriched_ctes(regions=TRIP_REGIONS) -> str:
    pairs = "(SELECT DISTINCT start_lat AS lat1, start_lon AS lon1, end_lat AS lat2, end_lon AS lon2 FROM clean)"
    vctes, vout = vincenty_ctes(pairs, "g")
    hav = ("round(2 * asin(sqrt(pow(sin((radians(end_lat) - radians(start_lat)) / 2), 2) + cos(radians(start_lat)) "
           "* cos(radians(end_lat)) * pow(sin((radians(end_lon) - radians(start_lon)) / 2), 2))) * 6371.0, 3)")
    st, et = parse_time("start_time"), parse_time("end_time")
    return f"""
raw AS ({RAW_TRIPS}),
clean AS (SELECT * FROM raw WHERE start_lat IS NOT NULL AND start_lon IS NOT NULL
          AND end_lat IS NOT NULL AND end_lon IS NOT NULL),
{HOLIDAYS_CTE.strip()},
tpts AS (SELECT DISTINCT start_lon AS px, start_lat AS py FROM clean),
tags AS MATERIALIZED ({region_tags_cte('tpts', regions)}),
{", ".join(vctes)},
parsed AS (SELECT c.*, {st} AS sdt, {et} AS edt, t.region, g.dist_m FROM clean c
  LEFT JOIN tags t ON t.px = c.start_lon AND t.py = c.start_lat
  LEFT JOIN {vout} g ON g.lat1 = c.start_lat AND g.lon1 = c.start_lon AND g.lat2 = c.end_lat AND g.lon2 = c.end_lon),
trips AS MATERIALIZED (SELECT trip_id, duration, start_station, start_lat, start_lon, end_station, end_lat, end_lon, bike_id,
  plan_duration,
  CAST(CASE trip_route_category WHEN 'One Way' THEN 1 WHEN 'Round Trip' THEN 2 END AS INTEGER) AS trip_route_type,
  CAST(CASE passholder_type WHEN 'Walk-up' THEN 1 WHEN 'One Day Pass' THEN 2 WHEN 'Monthly Pass' THEN 3
       WHEN 'Annual Pass' THEN 4 END AS INTEGER) AS passholder_type,
  CAST(CASE bike_type WHEN 'standard' THEN 1 WHEN 'electric' THEN 2 WHEN 'smart' THEN 3 END AS INTEGER) AS bike_type,
  CAST(dist_m AS FLOAT) AS distance, CAST({hav} AS FLOAT) AS distance_cal,
  coalesce(region, 'UNKNOWN') AS city_name,
  strftime(sdt, '%Y-%m-%d') AS used_date, CAST(hour(sdt) AS INTEGER) AS used_hour,
  CAST({season('sdt')} AS INTEGER) AS season, CAST({holiday('sdt')} AS INTEGER) AS holiday,
  CAST({workingday('sdt')} AS INTEGER) AS workingday,
  sdt AS start_datetime, edt AS end_datetime, strftime(sdt, '%Y-%m-%d %H:00:00') AS start_hour, ptd
  FROM parsed)"""


def _with(body: str, tail: str) -> str:
    return f"WITH {body.strip()}\n{tail}"


COUNT_COLS = [(n, c, v) for n, (c, v) in HOURLY_CONDITIONAL_COUNTS.items()]


def _hourly_select(src: str = "trips") -> str:
    counts = ", ".join(f"CAST(sum(CASE WHEN {c} = {v} THEN 1 ELSE 0 END) AS BIGINT) AS {n}" for n, c, v in COUNT_COLS)
    return (f"SELECT start_hour, CAST(count(*) AS BIGINT) AS used_count, CAST(sum(duration) AS BIGINT) AS total_duration, "
            f"{counts}, max(season) AS season, max(holiday) AS holiday, max(workingday) AS workingday "
            f"FROM {src} WHERE city_name = 'LA' GROUP BY start_hour")


def q_trip_enrich() -> str:
    return _with(_enriched_ctes(), "SELECT * FROM trips")


def q_calendar_flags() -> str:
    tail = f"""SELECT strftime(d, '%Y-%m-%d') AS used_date, CAST(isodow(d) AS INTEGER) AS iso_weekday,
  CAST({season('d')} AS INTEGER) AS season, CAST({holiday('d')} AS INTEGER) AS holiday,
  CAST({workingday('d')} AS INTEGER) AS workingday,
  CAST(CASE WHEN isodow(d) <= 5 THEN 1 ELSE 0 END AS INTEGER) AS business_day
FROM (SELECT DISTINCT CAST(start_datetime AS DATE) AS d FROM trips WHERE start_datetime IS NOT NULL) x"""
    return _with(_enriched_ctes(), tail)


def q_hour_rollup() -> str:
    tail = f"SELECT *, {hour_flags('CAST(substr(start_hour, 12, 2) AS INTEGER)')} FROM ({_hourly_select()}) h"
    return _with(_enriched_ctes(), tail)


def q_hour_rollup_filled() -> str:
    zero = ", ".join(f"coalesce(h.{n}, 0) AS {n}" for n, _c, _v in COUNT_COLS)
    tail = f"""SELECT s.start_hour, coalesce(h.used_count, 0) AS used_count, coalesce(h.total_duration, 0) AS total_duration,
  {zero}, h.season, h.holiday, h.workingday,
  {hour_flags('CAST(substr(s.start_hour, 12, 2) AS INTEGER)')}
FROM (SELECT strftime(ts, '%Y-%m-%d %H:00:00') AS start_hour FROM (
        SELECT unnest(generate_series(min(CAST(start_hour AS TIMESTAMP)), max(CAST(start_hour AS TIMESTAMP)),
                                      INTERVAL 1 HOUR)) AS ts FROM h0) g) s
LEFT JOIN h0 h ON h.start_hour = s.start_hour"""
    body = _enriched_ctes() + f",\nh0 AS ({_hourly_select()})"
    return _with(body, tail)


def q_distance_by_bike() -> str:
    tail = """SELECT bike_id, round(sum(distance), 1) AS sum_distance_m, round(sum(distance_cal), 3) AS sum_distance_km,
  CAST(count(*) AS BIGINT) AS trips FROM trips WHERE trip_route_type = 1 GROUP BY bike_id"""
    return _with(_enriched_ctes(), tail)


def q_geodesic_by_trip() -> str:
    pairs = ("(SELECT DISTINCT start_lat AS lat1, start_lon AS lon1, end_lat AS lat2, end_lon AS lon2 FROM raw "
             "WHERE start_lat IS NOT NULL AND start_lon IS NOT NULL AND end_lat IS NOT NULL AND end_lon IS NOT NULL)")
    vctes, vout = vincenty_ctes(pairs, "g")
    hav = ("round(2 * asin(sqrt(pow(sin((radians(lat2) - radians(lat1)) / 2), 2) + cos(radians(lat1)) "
           "* cos(radians(lat2)) * pow(sin((radians(lon2) - radians(lon1)) / 2), 2))) * 6371.0, 3)")
    body = f"raw AS ({RAW_TRIPS}),\n" + ",\n".join(vctes)
    tail = (f"SELECT lat1 AS start_lat, lon1 AS start_lon, lat2 AS end_lat, lon2 AS end_lon, "
            f"round(dist_m, 3) AS geodesic_m, round(dist_m / 1609.344, 6) AS geodesic_mi, {hav} AS haversine_km "
            f"FROM {vout}")
    return _with(body, tail)


def q_region_tag() -> str:
    body = f"""raw AS ({RAW_TRIPS}),
pts AS (SELECT DISTINCT lon AS px, lat AS py FROM (
  SELECT start_lon AS lon, start_lat AS lat FROM raw UNION ALL SELECT end_lon, end_lat FROM raw) u
  WHERE lon IS NOT NULL AND lat IS NOT NULL),
tags AS ({region_tags_cte('pts', TAG_REGIONS)})"""
    tail = ("SELECT p.px AS lon, p.py AS lat, coalesce(t.region, 'UNKNOWN') AS city_name FROM pts p "
            "LEFT JOIN tags t ON t.px = p.px AND t.py = p.py")
    return _with(body, tail)


Z95 = 1.959963984540054
RAW_COLUMNS = ["trip_id", "duration", "start_time", "end_time", "start_station", "start_lat", "start_lon",
               "end_station", "end_lat", "end_lon", "bike_id", "plan_duration", "trip_route_category",
               "passholder_type", "bike_type", "ptd"]


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def q_partition_counts() -> str:
    return _with(_enriched_ctes(), "SELECT ptd, count(*) AS row_count FROM trips GROUP BY ptd")


def q_partition_stats() -> str:
    parts = [f"""SELECT ptd, '{c}' AS "column", count(CAST({c} AS DOUBLE)) AS count,
  round(avg(CAST({c} AS DOUBLE)), 6) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS stddev,
  round(min(CAST({c} AS DOUBLE)), 6) AS min, round(max(CAST({c} AS DOUBLE)), 6) AS max FROM trips GROUP BY ptd"""
             for c in STATS_COLUMNS]
    return _with(_enriched_ctes(), _union(parts))


def q_partition_quartiles() -> str:
    parts = []
    for c in DESCRIBE_COLUMNS:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT ptd, '{c}' AS "column", count({x}) AS count, round(avg({x}), 6) AS mean,
  round(stddev_samp({x}), 6) AS stddev, round(min({x}), 6) AS min, round(quantile_cont({x}, 0.25), 6) AS p25,
  round(quantile_cont({x}, 0.5), 6) AS p50, round(quantile_cont({x}, 0.75), 6) AS p75, round(max({x}), 6) AS max
  FROM trips GROUP BY ptd""")
    return _with(_enriched_ctes(), _union(parts))


def _describe(src: str, cols, group: str = "") -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS "column", count({x}) AS count, round(avg({x}), 6) AS mean,
  round(stddev_samp({x}), 6) AS stddev, round(min({x}), 6) AS min, round(quantile_cont({x}, 0.25), 6) AS p25,
  round(quantile_cont({x}, 0.5), 6) AS p50, round(quantile_cont({x}, 0.75), 6) AS p75, round(max({x}), 6) AS max FROM {src}""")
    return _union(parts)


def q_describe_all() -> str:
    return _with(_enriched_ctes(), _describe("trips", DESCRIBE_COLUMNS))


def q_hourly_describe() -> str:
    return _with(_hourly_ctes(), _describe("h", HOURLY_NUMERIC))


def q_year_trips() -> str:
    return _with(_enriched_ctes(), f"SELECT * EXCLUDE (city_name) FROM trips WHERE ptd = '{CHAIN_YEAR}'")


def q_null_audit() -> str:
    parts = [f"""SELECT '{c}' AS "column", CAST(count(*) - count({c}) AS BIGINT) AS nulls, count(*) AS rows FROM raw"""
             for c in RAW_COLUMNS]
    return _with(f"raw AS MATERIALIZED ({RAW_TRIPS})", _union(parts))


def q_category_counts() -> str:
    parts = [f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS count FROM trips GROUP BY {c}"""
             for c in CATEGORY_COLUMNS]
    return _with(_enriched_ctes(), _union(parts))


def q_category_decode() -> str:
    sel, names = [], []
    for c, mapping in TRIP_CATEGORY_DECODINGS.items():
        whens = " ".join(f"WHEN {code} THEN '{label}'" for label, code in mapping.items())
        sel.append(f"CASE {c} {whens} END AS {c}_label")
        names.append(f"{c}_label")
    tail = (f"SELECT {', '.join(names)}, count(*) AS trips FROM (SELECT {', '.join(sel)} FROM trips) d "
            f"GROUP BY {', '.join(names)}")
    return _with(_enriched_ctes(), tail)


def _hourly_ctes() -> str:
    hf = hour_flags('CAST(substr(start_hour, 12, 2) AS INTEGER)')
    return _enriched_ctes() + f",\nh AS MATERIALIZED (SELECT *, {hf} FROM ({_hourly_select()}) x)"


def _pair_list():
    return [(a, b) for i, a in enumerate(HOURLY_NUMERIC) for b in HOURLY_NUMERIC[i + 1:]]


def q_corr_matrix() -> str:
    parts = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS value FROM h"
             for a, b in _pair_list()]
    return _with(_hourly_ctes(), _union(parts))


def q_cov_matrix() -> str:
    parts = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(covar_samp(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 4) AS value FROM h"
             for a, b in _pair_list()]
    return _with(_hourly_ctes(), _union(parts))


def q_mean_ci_by_category() -> str:
    parts = []
    for c in CI_CATEGORIES:
        m, sd, n = "avg(CAST(used_count AS DOUBLE))", "stddev_samp(CAST(used_count AS DOUBLE))", "count(used_count)"
        parts.append(f"""SELECT '{c}' AS category, CAST({c} AS VARCHAR) AS level, {n} AS n, round({m}, 6) AS mean,
  round({sd}, 6) AS stddev, round({m} - {Z95} * {sd} / sqrt({n}), 6) AS ci_low,
  round({m} + {Z95} * {sd} / sqrt({n}), 6) AS ci_high FROM h GROUP BY {c}""")
    return _with(_hourly_ctes(), _union(parts))


def q_station_dim() -> str:
    tail = """SELECT start_station AS station, 'start' AS side, arg_min(start_lat, trip_id) AS lat,
  arg_min(start_lon, trip_id) AS lon FROM trips WHERE start_station IS NOT NULL GROUP BY start_station
UNION ALL
SELECT end_station AS station, 'end' AS side, arg_min(end_lat, trip_id) AS lat,
  arg_min(end_lon, trip_id) AS lon FROM trips WHERE end_station IS NOT NULL GROUP BY end_station"""
    return _with(_enriched_ctes(), tail)


def q_station_activity() -> str:
    fmt = "'%Y-%m-%d %H:%M:%S'"
    tail = f"""SELECT coalesce(d.station, a.station) AS station, coalesce(d.departures, 0) AS departures,
  coalesce(a.arrivals, 0) AS arrivals, strftime(d.fd, {fmt}) AS first_departure, strftime(d.ld, {fmt}) AS last_departure,
  strftime(a.fa, {fmt}) AS first_arrival, strftime(a.la, {fmt}) AS last_arrival
FROM (SELECT start_station AS station, min(start_datetime) AS fd, max(start_datetime) AS ld, count(*) AS departures
      FROM trips WHERE start_station IS NOT NULL GROUP BY start_station) d
FULL OUTER JOIN (SELECT end_station AS station, min(start_datetime) AS fa, max(start_datetime) AS la, count(*) AS arrivals
      FROM trips WHERE end_station IS NOT NULL GROUP BY end_station) a ON d.station = a.station"""
    return _with(_enriched_ctes(), tail)


def q_od_counts() -> str:
    return _with(_enriched_ctes(),
                 "SELECT start_station, end_station, count(*) AS trips FROM trips GROUP BY start_station, end_station")


def q_station_share() -> str:
    tail = """SELECT station, starts, ends, round_trips, starts + ends - round_trips AS touching,
  round((starts + ends - round_trips) / (SELECT count(*) FROM trips), 8) AS share,
  round(round_trips / nullif(starts, 0), 8) AS self_loop_share
FROM (SELECT station, CAST(sum(s) AS BIGINT) AS starts, CAST(sum(e) AS BIGINT) AS ends, CAST(sum(r) AS BIGINT) AS round_trips
      FROM (SELECT start_station AS station, 1 AS s, 0 AS e, CASE WHEN start_station = end_station THEN 1 ELSE 0 END AS r
            FROM trips UNION ALL SELECT end_station, 0, 1, 0 FROM trips) u
      WHERE station IS NOT NULL GROUP BY station) p"""
    return _with(_enriched_ctes(), tail)


def q_station_set_diff() -> str:
    tail = """(SELECT DISTINCT start_station AS value, 'start_station' AS only_in FROM raw WHERE start_station IS NOT NULL
   AND start_station NOT IN (SELECT end_station FROM raw WHERE end_station IS NOT NULL))
UNION ALL
(SELECT DISTINCT end_station AS value, 'end_station' AS only_in FROM raw WHERE end_station IS NOT NULL
   AND end_station NOT IN (SELECT start_station FROM raw WHERE start_station IS NOT NULL))"""
    return _with(f"raw AS MATERIALIZED ({RAW_TRIPS})", tail)


def q_json_conformance() -> str:
    docs = f"SELECT {EVENT_DOC} AS doc FROM events"
    good = ("(coalesce(json_valid(doc), false) AND json_type(doc) = 'OBJECT' "
            "AND coalesce(json_type(doc, '$.k'), 'NULL') IN ('NULL', 'UBIGINT', 'BIGINT'))")
    there = "coalesce(json_type(doc, '$.k'), 'NULL') <> 'NULL'"
    return f"""WITH docs AS ({docs})
SELECT count(*) AS rows, count(*) - count(doc) AS nulls,
  count(*) FILTER (WHERE doc IS NOT NULL AND NOT CASE WHEN json_valid(doc) THEN {good} ELSE false END) AS invalid,
  count(*) FILTER (WHERE CASE WHEN json_valid(doc) THEN {good} AND NOT {there} ELSE false END) AS missing_required,
  count(*) FILTER (WHERE CASE WHEN json_valid(doc) THEN {good} AND {there} ELSE false END) AS valid
FROM docs"""


def q_json_validation() -> str:
    number = "('UBIGINT', 'BIGINT', 'DOUBLE')"

    def kind(path: str) -> str:
        return f"json_type(j, '{path}')"

    def integer(path: str) -> str:
        return f"({kind(path)} IN {number} AND {value(path)} = floor({value(path)}))"

    def value(path: str) -> str:
        return f"TRY_CAST(json_extract_string(j, '{path}') AS DOUBLE)"

    props = NESTED_SCHEMA["properties"]
    when = [("doc IS NULL", "$: no document"), ("j IS NULL", "$: not JSON"), ("json_type(j) <> 'OBJECT'", "$: type")]
    when += [(f"{kind(f'$.{p}')} IS NULL", f"$.{p}: required") for p in NESTED_SCHEMA["required"]]
    when += [("json_exists(j, '$.extra')", "$.extra: not allowed"), (f"NOT {integer('$.id')}", "$.id: type"),
             (f"{value('$.id')} < 0", "$.id: minimum"), (f"{kind('$.kind')} <> 'VARCHAR'", "$.kind: type"),
             (f"json_extract_string(j, '$.kind') NOT IN ({', '.join(repr(e) for e in props['kind']['enum'])})", "$.kind: enum"),
             (f"{kind('$.props')} <> 'OBJECT'", "$.props: type"), (f"{kind('$.props.k')} IS NULL", "$.props.k: required"),
             (f"NOT {integer('$.props.k')}", "$.props.k: type"), (f"{value('$.props.k')} < 0", "$.props.k: minimum"),
             (f"{value('$.props.k')} > {props['props']['properties']['k']['maximum']}", "$.props.k: maximum"),
             (f"{kind('$.tags')} <> 'ARRAY'", "$.tags: type"), ("json_array_length(j, '$.tags') > 3", "$.tags: maxItems")]
    for i in range(3):
        tag = f"json_extract_string(j, '$.tags[{i}]')"
        when += [(f"{kind(f'$.tags[{i}]')} <> 'VARCHAR'", f"$.tags[{i}]: type"), (f"length({tag}) > 3", f"$.tags[{i}]: maxLength"),
                 (f"NOT regexp_matches({tag}, '^t[0-9]+$')", f"$.tags[{i}]: pattern")]
    when.append((f"{kind('$.note')} NOT IN ('VARCHAR', 'NULL')", "$.note: type"))
    cases = " ".join(f"WHEN {c} THEN '{m}'" for c, m in when)
    return f"""WITH docs AS (SELECT event_id, {NESTED_DOC} AS doc FROM events),
parsed AS MATERIALIZED (SELECT event_id, doc, CASE WHEN json_valid(doc) THEN doc END AS j FROM docs)
SELECT event_id, CASE {cases} ELSE 'Success' END AS verdict FROM parsed"""


def q_time_functions() -> str:
    st, et = parse_time("start_time"), parse_time("end_time")
    fmts = DETECT_FORMATS
    fmt = "CASE " + " ".join(f"WHEN regexp_matches(start_time, '{rx}') THEN '{name}'" for name, rx in fmts) + " END"
    d = "split_part(start_time, ' ', 1)"
    slash = f"contains({d}, '/')"
    yy = f"TRY_CAST(CASE WHEN {slash} THEN split_part({d}, '/', 3) ELSE split_part({d}, '-', 1) END AS INTEGER)"
    mm = f"TRY_CAST(CASE WHEN {slash} THEN split_part({d}, '/', 1) ELSE split_part({d}, '-', 2) END AS INTEGER)"
    dd = f"TRY_CAST(CASE WHEN {slash} THEN split_part({d}, '/', 2) ELSE split_part({d}, '-', 3) END AS INTEGER)"
    sec = "(epoch(et) - epoch(st))"
    tail = f"""SELECT trip_id, {fmt} AS start_format, {d} AS date_token,
  CASE WHEN contains(start_time, ' ') AND contains(start_time, ':')
       THEN TRY_CAST(split_part(split_part(start_time, ' ', 2), ':', 1) AS INTEGER) END AS hour_token,
  CASE WHEN contains(start_time, '/') THEN split_part(start_time, '/', 3) ELSE 'UnknownYear' END AS year_token,
  {yy} AS part_year, {mm} AS part_month, {dd} AS part_day,
  CAST(trunc({sec} / 60) AS INTEGER) AS used_minutes,
  CAST(floor(((-{sec}) % 86400 + 86400) % 86400 / 60) AS INTEGER) AS used_minutes_wrapped,
  epoch_ms(st) AS epoch_ms, CAST(epoch(st) AS BIGINT) AS epoch_s,
  strftime(st, '%Y-%m-%d %H:%M:%S') AS from_epoch,
  strftime(st - INTERVAL 1 DAY, '%Y-%m-%d') AS prev_day, strftime(st + INTERVAL 1 DAY, '%Y-%m-%d') AS next_day,
  CAST(year(CAST(st AS DATE) - INTERVAL 1 MONTH) AS VARCHAR) || '-' || CAST(month(CAST(st AS DATE) - INTERVAL 1 MONTH) AS VARCHAR) AS last_month,
  strftime(st, '%Y-%m-%d') AS day_str, strftime(st, '%H') AS hour_str, strftime(st, '%Y-%m') AS month_str,
  CAST(sign(epoch(st) - epoch(et)) AS INTEGER) AS cmp_time,
  CAST(sign(CAST(st AS DATE) - CAST(et AS DATE)) AS INTEGER) AS cmp_date,
  (CAST(et AS DATE) - CAST(st AS DATE)) BETWEEN 0 AND 1 AS within_a_day
FROM (SELECT trip_id, start_time, {st} AS st, {et} AS et FROM raw) x"""
    return _with(f"raw AS ({RAW_TRIPS})", tail)


def q_date_spine() -> str:
    tail = """SELECT strftime(s.day, '%Y-%m-%d') AS day, coalesce(d.trips, 0) AS trips, CAST(isodow(s.day) AS INTEGER) AS iso_weekday
FROM (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM daily) s
LEFT JOIN daily d ON d.day = s.day"""
    body = _enriched_ctes() + ",\ndaily AS (SELECT CAST(start_datetime AS DATE) AS day, count(*) AS trips FROM trips " \
        "WHERE start_datetime IS NOT NULL GROUP BY 1)"
    return _with(body, tail)


def q_month_shift() -> str:
    cols = ["strftime(d, '%Y-%m-%d') AS day"]
    for n in (1, -1, -13, 12):
        tag = f"p{n}" if n >= 0 else f"m{-n}"
        shifted = f"CAST(d + INTERVAL ({n}) MONTH AS DATE)"
        cols.append(f"strftime({shifted}, '%Y-%m-%d') AS shift_{tag}")
        cols.append(f"CASE WHEN day({shifted}) = day(d) THEN strftime({shifted}, '%Y-%m-%d') END AS strict_{tag}")
    tail = f"SELECT {', '.join(cols)} FROM (SELECT DISTINCT CAST(start_datetime AS DATE) AS d FROM trips WHERE start_datetime IS NOT NULL) x"
    return _with(_enriched_ctes(), tail)


START_POINTS = f"""raw AS ({RAW_TRIPS}),
sp AS MATERIALIZED (SELECT trip_id, start_station, start_lon AS x, start_lat AS y FROM raw
                    WHERE start_lon IS NOT NULL AND start_lat IS NOT NULL),
pts AS MATERIALIZED (SELECT x, y, count(*) AS w, row_number() OVER (ORDER BY x, y) AS id FROM sp GROUP BY x, y)"""


def q_standard_scale() -> str:
    tail = """SELECT trip_id, round((x - avg(x) OVER ()) / stddev_pop(x) OVER (), 9) AS x_scaled,
  round((y - avg(y) OVER ()) / stddev_pop(y) OVER (), 9) AS y_scaled FROM sp"""
    return _with(START_POINTS, tail)


def _pair_cte(eps: float | None = None) -> str:
    cond = f"WHERE d <= {eps!r}" if eps is not None else ""
    return f"""pairs AS MATERIALIZED (SELECT * FROM (SELECT a.id AS id_a, b.id AS id_b, b.w AS w_b,
  sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) AS d FROM pts a CROSS JOIN pts b) q {cond})"""


def q_k_distance() -> str:
    body = START_POINTS + ",\n" + _pair_cte() + f""",
cum AS (SELECT id_a, d, sum(w_b) OVER (PARTITION BY id_a ORDER BY d RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c
        FROM pairs)"""
    tail = f"""SELECT p.x, p.y, p.w, round(k.kdist, 9) AS kdist FROM pts p JOIN
  (SELECT id_a, min(d) AS kdist FROM cum WHERE c >= {K_DISTANCE_K} GROUP BY id_a) k ON k.id_a = p.id"""
    return _with(body, tail)


def _dbscan_body(settings, eps: float = DBSCAN_EPS, points: str | None = None) -> str:
    ms = ", ".join(f"({m})" for m in settings)
    return (points or START_POINTS) + ",\n" + _pair_cte(eps) + f""",
deg AS (SELECT id_a AS id, CAST(sum(w_b) AS BIGINT) AS degree FROM pairs GROUP BY id_a),
settings AS (SELECT * FROM (VALUES {ms}) s(ms)),
nodes AS MATERIALIZED (SELECT s.ms, p.id, p.x, p.y, p.w, d.degree, d.degree >= s.ms AS is_core
        FROM pts p JOIN deg d ON d.id = p.id CROSS JOIN settings s),
core_edges AS (SELECT a.ms, pr.id_a AS src, pr.id_b AS dst FROM pairs pr
        JOIN nodes a ON a.id = pr.id_a JOIN nodes b ON b.id = pr.id_b AND b.ms = a.ms
        WHERE a.is_core AND b.is_core AND pr.id_a <> pr.id_b),
cc AS (WITH RECURSIVE walk(ms, id, comp) AS (
          SELECT ms, id, id FROM nodes WHERE is_core
          UNION
          SELECT e.ms, e.dst, w.comp FROM walk w JOIN core_edges e ON e.ms = w.ms AND e.src = w.id)
       SELECT ms, id, min(comp) AS comp FROM walk GROUP BY ms, id),
border AS (SELECT a.ms, pr.id_a AS id, min(c.comp) AS comp FROM pairs pr
        JOIN nodes a ON a.id = pr.id_a AND NOT a.is_core
        JOIN cc c ON c.id = pr.id_b AND c.ms = a.ms GROUP BY a.ms, pr.id_a),
member AS (SELECT * FROM cc UNION ALL SELECT * FROM border),
ranks AS (SELECT ms, comp, dense_rank() OVER (PARTITION BY ms ORDER BY comp) - 1 AS label
          FROM (SELECT DISTINCT ms, comp FROM member) u),
labelled AS (SELECT n.ms, n.x, n.y, n.w, n.degree, n.is_core, CAST(coalesce(r.label, -1) AS BIGINT) AS label
        FROM nodes n LEFT JOIN member m ON m.ms = n.ms AND m.id = n.id
        LEFT JOIN ranks r ON r.ms = m.ms AND r.comp = m.comp)"""


def q_dbscan() -> str:
    return _with(_dbscan_body([DBSCAN_MIN_SAMPLES]), "SELECT x, y, w, degree, is_core, label FROM labelled")


def q_dbscan_sweep() -> str:
    tail = """SELECT CAST(ms AS BIGINT) AS min_samples, count(DISTINCT CASE WHEN label <> -1 THEN label END) AS clusters,
  count(*) FILTER (WHERE label = -1) AS noise_points, count(*) FILTER (WHERE is_core) AS core_points,
  count(*) FILTER (WHERE label <> -1 AND NOT is_core) AS border_points,
  CAST(coalesce(sum(CASE WHEN label = -1 THEN w END), 0) AS BIGINT) AS noise_weight
FROM labelled GROUP BY ms"""
    return _with(_dbscan_body(DBSCAN_SWEEP), tail)


def _labelled_sp() -> str:
    return START_POINTS + f",\nlp AS MATERIALIZED (SELECT x, y, CAST(start_station % {QUALITY_LABEL_MOD} AS BIGINT) AS label FROM sp)"


def q_davies_bouldin() -> str:
    body = _labelled_sp() + """,
cent AS (SELECT label, avg(x) AS cx, avg(y) AS cy FROM lp GROUP BY label),
sc AS (SELECT lp.label, avg(sqrt(pow(lp.x - c.cx, 2) + pow(lp.y - c.cy, 2))) AS s FROM lp JOIN cent c USING (label)
       GROUP BY lp.label),
info AS (SELECT c.label, c.cx, c.cy, s.s FROM cent c JOIN sc s USING (label))"""
    tail = """SELECT round(avg(r), 6) AS davies_bouldin FROM (
  SELECT a.label, max((a.s + b.s) / sqrt(pow(a.cx - b.cx, 2) + pow(a.cy - b.cy, 2))) AS r
  FROM info a JOIN info b ON a.label <> b.label GROUP BY a.label) t"""
    return _with(body, tail)


def q_silhouette(distance: str = "(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))") -> str:
    body = _labelled_sp() + """,
lpts AS (SELECT x, y, label, count(*) AS w FROM lp GROUP BY x, y, label),
csz AS (SELECT label, sum(w) AS W FROM lpts GROUP BY label),
dist AS (SELECT a.x, a.y, a.label, a.w, b.label AS lb, sum(b.w * """ + distance + """) AS ssum
         FROM lpts a CROSS JOIN lpts b GROUP BY a.x, a.y, a.label, a.w, b.label),
per AS (SELECT d.x, d.y, d.label, d.w,
          max(CASE WHEN d.lb = d.label THEN d.ssum / nullif(c.W - 1, 0) END) AS a,
          min(CASE WHEN d.lb <> d.label THEN d.ssum / c.W END) AS b,
          max(CASE WHEN d.lb = d.label THEN c.W END) AS own_w
        FROM dist d JOIN csz c ON c.label = d.lb GROUP BY d.x, d.y, d.label, d.w)"""
    tail = """SELECT round(sum(w * CASE WHEN own_w <= 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END) / sum(w), 6) AS silhouette
FROM per"""
    return _with(body, tail)


def q_silhouette_euclidean() -> str:
    return q_silhouette("sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))")


def q_csv_roundtrip() -> str:
    st = parse_time("start_time")
    cols = ", ".join(RAW_COLUMNS[:-1])
    tail = f"""SELECT {cols}, period, split_part(period, '-', 1) AS ptd FROM (
  SELECT *, CAST(year({st}) AS VARCHAR) || '-q' || CAST(quarter({st}) AS VARCHAR) AS period FROM raw) x"""
    return _with(f"raw AS ({RAW_TRIPS})", tail)


def q_partition_reload() -> str:
    return q_trip_enrich()


def q_trip_job() -> str:
    st = parse_time("start_time")
    period = f"CAST(year({st}) AS VARCHAR) || '-q' || CAST(quarter({st}) AS VARCHAR)"
    missing = "(start_lat IS NULL OR start_lon IS NULL OR end_lat IS NULL OR end_lon IS NULL)"
    parts = f"""SELECT 'trips' AS part, {period} AS key, CAST(count(*) AS DOUBLE) AS value FROM raw WHERE NOT {missing} GROUP BY 2
UNION ALL SELECT 'hour', start_hour, CAST(count(*) AS DOUBLE) FROM trips WHERE city_name = 'LA' GROUP BY 2
UNION ALL SELECT 'bike', CAST(bike_id AS VARCHAR), round(sum(distance), 1) FROM trips WHERE trip_route_type = 1 GROUP BY 2
UNION ALL SELECT 'rejected', 'metro-trips-' || {period} || '.csv no coordinates', CAST(count(*) AS DOUBLE) FROM raw WHERE {missing} GROUP BY 2"""
    return _with(_enriched_ctes(), parts)


def q_top_od_pairs() -> str:
    return _with(_enriched_ctes(), """SELECT start_station, end_station, count(*) AS trips FROM trips
GROUP BY start_station, end_station ORDER BY trips DESC, start_station, end_station LIMIT 10""")


def q_unmapped_categories() -> str:
    parts = []
    for src, (_dst, mapping) in TRIP_CATEGORY_ENCODINGS.items():
        labels = ", ".join(f"'{k}'" for k in mapping)
        parts.append(f"""SELECT '{src}' AS "column", count(*) FILTER (WHERE {src} IS NOT NULL AND {src} NOT IN ({labels})) AS unmapped FROM raw""")
    return _with(f"raw AS MATERIALIZED ({RAW_TRIPS})", _union(parts))


def q_complete_rows() -> str:
    cond = " AND ".join(f"{c} IS NOT NULL" for c in RAW_COLUMNS)
    return _with(f"raw AS ({RAW_TRIPS})", f"""SELECT ptd, count(*) AS rows,
  count(*) FILTER (WHERE {cond}) AS complete_rows FROM raw GROUP BY ptd""")


def q_k_distance_curve() -> str:
    inner = q_k_distance()
    return f"SELECT kdist, CAST(sum(w) AS BIGINT) AS weight FROM ({inner}) k GROUP BY kdist"


def q_mean_ci_bootstrap() -> str:
    draw = "CAST('0x' || substr(md5(concat_ws('|', start_hour, '7', CAST(rep AS VARCHAR))), 1, 8) AS BIGINT)"
    weight = " + ".join(f"CASE WHEN draw >= {c} THEN 1.0 ELSE 0.0 END" for c in poisson_cuts(1))
    body = _hourly_ctes() + f""",
drawn AS (SELECT CAST(workingday AS VARCHAR) AS level, CAST(used_count AS DOUBLE) AS v, rep, {draw} AS draw
          FROM h, range(1, {BOOTSTRAP_REPLICATES + 1}) r(rep)),
weighed AS (SELECT level, v, rep, {weight} AS w FROM drawn),
reps AS (SELECT level, rep, sum(v * w) / nullif(sum(CASE WHEN v IS NOT NULL THEN w END), 0) AS m FROM weighed GROUP BY level, rep)"""
    tail = """SELECT a.level, round(a.mean, 6) AS mean, round(b.lo, 6) AS ci_low, round(b.hi, 6) AS ci_high
FROM (SELECT CAST(workingday AS VARCHAR) AS level, avg(CAST(used_count AS DOUBLE)) AS mean FROM h GROUP BY 1) a
JOIN (SELECT level, quantile_cont(m, 0.025) AS lo, quantile_cont(m, 0.975) AS hi FROM reps GROUP BY level) b
  ON a.level IS NOT DISTINCT FROM b.level"""
    return _with(body, tail)


def _kmeans_body() -> str:
    rows = ", ".join(f"({i}, CAST({x!r} AS DOUBLE), CAST({y!r} AS DOUBLE))" for i, (x, y) in enumerate(KMEANS_START))
    out = START_POINTS + f",\nkc0 AS (SELECT * FROM (VALUES {rows}) c(label, cx, cy))"
    near = """SELECT x, y, w, label FROM (SELECT p.x, p.y, p.w, c.label, row_number() OVER (PARTITION BY p.x, p.y
  ORDER BY (p.x - c.cx) * (p.x - c.cx) + (p.y - c.cy) * (p.y - c.cy), c.label) AS rn FROM pts p CROSS JOIN {c} c) q WHERE rn = 1"""
    for i in range(KMEANS_ROUNDS):
        out += f""",\nka{i} AS MATERIALIZED ({near.format(c=f'kc{i}')}),
kc{i + 1} AS MATERIALIZED (SELECT c.label, coalesce(m.cx, c.cx) AS cx, coalesce(m.cy, c.cy) AS cy FROM kc{i} c
  LEFT JOIN (SELECT label, sum(w * x) / sum(w) AS cx, sum(w * y) / sum(w) AS cy FROM ka{i} GROUP BY label) m USING (label))"""
    return out + f",\nkl AS MATERIALIZED ({near.format(c=f'kc{KMEANS_ROUNDS}')})"


def q_kmeans_centers() -> str:
    return _with(_kmeans_body(), f"""SELECT CAST(label AS BIGINT) AS label, round(cx, 9) AS center_x, round(cy, 9) AS center_y
FROM kc{KMEANS_ROUNDS}""")


def q_kmeans_labels() -> str:
    return _with(_kmeans_body(), "SELECT x, y, w, CAST(label AS BIGINT) AS label FROM kl")


def q_kmeans_sizes() -> str:
    return _with(_kmeans_body(), f"""SELECT CAST(label AS BIGINT) AS label, CAST(sum(w) AS BIGINT) AS size, round(any_value(cx), 9) AS center_x,
  round(any_value(cy), 9) AS center_y FROM kl JOIN kc{KMEANS_ROUNDS} USING (label) GROUP BY label""")


def _chain_body() -> str:
    body = _dbscan_body([CHAIN_MIN_SAMPLES], CHAIN_EPS, f"""raw AS ({RAW_TRIPS}),
one AS MATERIALIZED (SELECT start_lon AS rx, start_lat AS ry FROM raw WHERE ptd = '{CHAIN_YEAR}' AND start_lon IS NOT NULL AND start_lat IS NOT NULL),
stat AS (SELECT avg(rx) AS mx, stddev_pop(rx) AS sx, avg(ry) AS my, stddev_pop(ry) AS sy FROM one),
pts AS MATERIALIZED (SELECT x, y, rx, ry, w, row_number() OVER (ORDER BY x, y) AS id FROM (
  SELECT (rx - mx) / sx AS x, (ry - my) / sy AS y, rx, ry, count(*) AS w FROM one, stat GROUP BY ALL) g)""")
    return body + """,
chain AS MATERIALIZED (SELECT p.rx AS x, p.ry AS y, p.w, l.is_core, l.label FROM pts p JOIN labelled l ON l.x = p.x AND l.y = p.y)"""


def q_dbscan_scaled() -> str:
    return _with(_chain_body(), "SELECT x, y, w, is_core, label FROM chain")


def q_davies_bouldin_dbscan() -> str:
    body = _chain_body() + """,
cent AS (SELECT label, sum(w * x) / sum(w) AS cx, sum(w * y) / sum(w) AS cy FROM chain GROUP BY label),
sc AS (SELECT c.label, sum(w * sqrt(pow(c.x - t.cx, 2) + pow(c.y - t.cy, 2))) / sum(w) AS s FROM chain c JOIN cent t USING (label) GROUP BY c.label),
info AS (SELECT c.label, c.cx, c.cy, s.s FROM cent c JOIN sc s USING (label))"""
    tail = """SELECT round(avg(r), 6) AS davies_bouldin FROM (
  SELECT a.label, max((a.s + b.s) / sqrt(pow(a.cx - b.cx, 2) + pow(a.cy - b.cy, 2))) AS r
  FROM info a JOIN info b ON a.label <> b.label GROUP BY a.label) t"""
    return _with(body, tail)


def q_dbscan_cluster_sizes() -> str:
    return _with(_dbscan_body(DBSCAN_SWEEP), """SELECT CAST(ms AS BIGINT) AS min_samples, label, count(*) AS points, CAST(sum(w) AS BIGINT) AS size
FROM labelled GROUP BY ms, label""")


def q_rejected_rows() -> str:
    st = parse_time("start_time")
    missing = "(start_lat IS NULL OR start_lon IS NULL OR end_lat IS NULL OR end_lon IS NULL)"
    return _with(f"""raw AS ({RAW_TRIPS}),
named AS (SELECT *, CASE WHEN trip_id % 10 = 0 THEN 'latest' ELSE CAST(year({st}) AS VARCHAR) || '-q' || CAST(quarter({st}) AS VARCHAR) END AS p,
  {st} AS sdt FROM raw),
why AS (SELECT 'metro-trips-' || p || '.csv' AS source_file, 'no period' AS reason FROM named WHERE p = 'latest'
  UNION ALL SELECT 'metro-trips-' || p || '.csv', 'no coordinates' FROM named WHERE {missing}
  UNION ALL SELECT 'metro-trips-' || p || '.csv', 'no start time' FROM named WHERE sdt IS NULL)""",
                 "SELECT source_file, reason, count(*) AS rows FROM why GROUP BY source_file, reason")


def q_export_roundtrip() -> str:
    return _with(_hourly_ctes(), "SELECT start_hour, used_count, total_duration, used_count AS json_count, total_duration AS json_duration FROM h")


def q_region_document() -> str:
    x1, y1, x2, y2 = (PASADENA_REGION[1][0][0][i][j] for i in (0, 2) for j in (0, 1))
    return _with(START_POINTS, f"""SELECT CASE WHEN x BETWEEN {x1!r} AND {x2!r} AND y BETWEEN {y1!r} AND {y2!r} THEN 'PASADENA' END AS region,
  count(*) AS points, CAST(sum(w) AS BIGINT) AS trips FROM pts GROUP BY 1""")


def q_month_spine() -> str:
    parts = []
    for unit, step, cut, closed in (("M", "INTERVAL 2 MONTH", "month", True), ("W", "INTERVAL 7 DAY", "week", False), ("Y", "INTERVAL 1 YEAR", "year", True)):
        ends = "" if closed else " WHERE ts <> lo AND ts <> hi"
        parts.append(f"""SELECT '{unit}' AS unit, strftime(s.ts, '%Y-%m-%d') AS day, coalesce(c.trips, 0) AS trips
FROM (SELECT ts FROM (SELECT lo, hi, unnest(generate_series(lo, hi, {step})) AS ts FROM span) g{ends}) s
LEFT JOIN (SELECT date_trunc('{cut}', start_datetime) AS at, count(*) AS trips FROM t GROUP BY 1) c ON c.at = date_trunc('{cut}', s.ts)""")
    body = _enriched_ctes() + """,
t AS MATERIALIZED (SELECT start_datetime FROM trips WHERE start_datetime IS NOT NULL),
span AS (SELECT CAST(date_trunc('month', min(start_datetime)) AS TIMESTAMP) AS lo, CAST(date_trunc('month', max(start_datetime)) AS TIMESTAMP) AS hi FROM t)"""
    return _with(body, _union(parts))


ORACLE = {
    "trip_enrich": q_trip_enrich,
    "calendar_flags": q_calendar_flags,
    "hour_rollup": q_hour_rollup,
    "hour_rollup_filled": q_hour_rollup_filled,
    "distance_by_bike": q_distance_by_bike,
    "geodesic_by_trip": q_geodesic_by_trip,
    "region_tag": q_region_tag,
    "partition_counts": q_partition_counts,
    "partition_stats": q_partition_stats,
    "partition_quartiles": q_partition_quartiles,
    "null_audit": q_null_audit,
    "category_counts": q_category_counts,
    "category_decode": q_category_decode,
    "corr_matrix": q_corr_matrix,
    "cov_matrix": q_cov_matrix,
    "mean_ci_by_category": q_mean_ci_by_category,
    "mean_ci_bootstrap": q_mean_ci_bootstrap,
    "describe_all": q_describe_all,
    "hourly_describe": q_hourly_describe,
    "year_trips": q_year_trips,
    "kmeans_sizes": q_kmeans_sizes,
    "kmeans_centers": q_kmeans_centers,
    "kmeans_labels": q_kmeans_labels,
    "dbscan_scaled": q_dbscan_scaled,
    "davies_bouldin_dbscan": q_davies_bouldin_dbscan,
    "dbscan_cluster_sizes": q_dbscan_cluster_sizes,
    "rejected_rows": q_rejected_rows,
    "export_roundtrip": q_export_roundtrip,
    "region_document": q_region_document,
    "month_spine": q_month_spine,
    "station_dim": q_station_dim,
    "station_activity": q_station_activity,
    "od_counts": q_od_counts,
    "station_share": q_station_share,
    "station_set_diff": q_station_set_diff,
    "json_conformance": q_json_conformance,
    "json_validation": q_json_validation,
    "time_functions": q_time_functions,
    "date_spine": q_date_spine,
    "month_shift": q_month_shift,
    "standard_scale": q_standard_scale,
    "k_distance": q_k_distance,
    "dbscan": q_dbscan,
    "dbscan_sweep": q_dbscan_sweep,
    "davies_bouldin": q_davies_bouldin,
    "silhouette": q_silhouette,
    "silhouette_euclidean": q_silhouette_euclidean,
    "csv_roundtrip": q_csv_roundtrip,
    "partition_reload": q_partition_reload,
    "trip_job": q_trip_job,
    "top_od_pairs": q_top_od_pairs,
    "unmapped_categories": q_unmapped_categories,
    "complete_rows": q_complete_rows,
    "k_distance_curve": q_k_distance_curve,
}


def oracle_sql() -> dict[str, str]:
    return {k: fn() for k, fn in ORACLE.items()}
