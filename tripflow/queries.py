"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole
input tables.  Used by ``__spark_entry__`` and ``bench.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions import calendar, geo, timefn
from tripflow.functions.categories import decode
from tripflow.operators import cluster, json_schema, profile, stations
from tripflow.operators.enrich import enrich_trips
from tripflow.operators.region import tag_points
from tripflow.operators.rollup import HOURLY_COLUMNS, count_by_partition, fill_hour_gaps, hourly_usage
from tripflow.operators.silhouette import silhouette_euclidean_df
from tripflow.schema import DESCRIBE_COLUMNS, STATS_COLUMNS
from tripflow.sources.adapter import load_raw_trips
from tripflow.sources.regions import regions_from_rows

# --- Query parameters ---------------------------------------------------------------------
# Service region used by the trip queries: a two-part MultiPolygon ([lon, lat] pairs) whose
# first part has a hole.  A second region exists for the tagging query.
LA_REGION = (
    "LA",
    [
        [[[-118.65, 33.875], [-118.25, 33.875], [-118.25, 34.175], [-118.65, 34.175], [-118.65, 33.875]],
         [[-118.45, 33.975], [-118.35, 33.975], [-118.35, 34.025], [-118.45, 34.025], [-118.45, 33.975]]],
        [[[-118.26, 34.18], [-118.14, 34.18], [-118.2, 34.3], [-118.26, 34.18]]],
    ],
)
PASADENA_REGION = (
    "PASADENA",
    [[[[-118.225, 33.925], [-118.125, 33.925], [-118.125, 34.125], [-118.225, 34.125], [-118.225, 33.925]]]],
)
TRIP_REGIONS = [LA_REGION]
CATEGORY_COLUMNS = ["plan_duration", "trip_route_type", "passholder_type", "bike_type", "season", "holiday",
                    "workingday"]
CI_CATEGORIES = ["workingday", "season", "holiday", "hour_is_morning_evening"]
HOURLY_NUMERIC = [c for c in HOURLY_COLUMNS if c != "start_hour"]
# Clustering parameters (degrees, unscaled coordinates; weights = trips per coordinate).
DBSCAN_EPS = 0.06
DBSCAN_MIN_SAMPLES = 1100
DBSCAN_SWEEP = [900, 1100, 1150, 1200]
K_DISTANCE_K = 1000
# The clustering chain: one year, scaled coordinates (units: standard deviations).
CHAIN_YEAR, CHAIN_EPS, CHAIN_MIN_SAMPLES = "1997", 0.5, 170
# Start centres (lon, lat) and rounds of the k-means queries.
KMEANS_START = [(-118.57, 33.93), (-118.41, 34.11), (-118.23, 34.22)]
KMEANS_ROUNDS = 6
BOOTSTRAP_REPLICATES = 100
# Label rule for the quality metrics (a given clustering, so metrics are tested on their own).
QUALITY_LABEL_MOD = 3
TAG_REGIONS = [LA_REGION, PASADENA_REGION]

QueryFn = Callable[[SparkSession, str], DataFrame]


def _round(c, n=6):
    return F.round(c, n)


def trips(spark: SparkSession, sf_dir: str, with_region: bool = True) -> DataFrame:
    """Enriched trips over the whole ``orders``-derived trip feed.  Queries whose result does
    not read ``city_name`` pass ``with_region=False`` and skip the region-tagging job (the
    column is then the default label) - the same outcome as pruning an unused column."""
    regions = regions_from_rows(spark, TRIP_REGIONS) if with_region else None
    return enrich_trips(load_raw_trips(spark, sf_dir), regions)


def q_trip_enrich(spark, sf_dir):
    return trips(spark, sf_dir)


def q_calendar_flags(spark, sf_dir):
    """Calendar flags of every distinct trip start date."""
    t = trips(spark, sf_dir, with_region=False).select(F.to_date("start_datetime").alias("d")).where(F.col("d").isNotNull()).distinct()
    return t.select(
        timefn.date_label("d").alias("used_date"),
        (F.weekday("d") + 1).cast("int").alias("iso_weekday"),
        timefn.season("d").alias("season"),
        calendar.holiday_flag("d").alias("holiday"),
        calendar.workingday_flag("d").alias("workingday"),
        timefn.is_business_day("d").cast("int").alias("business_day"))


def q_hour_rollup(spark, sf_dir):
    return hourly_usage(trips(spark, sf_dir)).orderBy("start_hour")


def q_hour_rollup_filled(spark, sf_dir):
    return fill_hour_gaps(hourly_usage(trips(spark, sf_dir)))


def q_distance_by_bike(spark, sf_dir):
    t = trips(spark, sf_dir, with_region=False).where(F.col("trip_route_type") == 1)
    return t.groupBy("bike_id").agg(
        _round(F.sum("distance"), 1).alias("sum_distance_m"),
        _round(F.sum("distance_cal"), 3).alias("sum_distance_km"),
        F.count(F.lit(1)).alias("trips"))


def q_geodesic_by_trip(spark, sf_dir):
    """Geodesic and haversine distance of every distinct (start, end) coordinate pair."""
    raw = load_raw_trips(spark, sf_dir)
    pairs = raw.select("start_lat", "start_lon", "end_lat", "end_lon").dropna().distinct()
    g = geo.geodesic("start_lat", "start_lon", "end_lat", "end_lon", "m")
    return pairs.withColumn("__m", g).select(
        "start_lat", "start_lon", "end_lat", "end_lon",
        _round(F.col("__m"), 3).alias("geodesic_m"),
        _round(F.col("__m") / geo.METRES_PER_MILE, 6).alias("geodesic_mi"),
        geo.haversine_km("start_lat", "start_lon", "end_lat", "end_lon").alias("haversine_km"))


def q_region_tag(spark, sf_dir):
    """Region of every distinct start and end point (strict interior, else UNKNOWN)."""
    raw = load_raw_trips(spark, sf_dir)
    pts = (raw.select(F.col("start_lon").alias("lon"), F.col("start_lat").alias("lat"))
           .unionByName(raw.select(F.col("end_lon").alias("lon"), F.col("end_lat").alias("lat")))
           .dropna().distinct())
    tags = tag_points(pts, regions_from_rows(spark, TAG_REGIONS), "lon", "lat")
    out = pts.join(tags, ["lon", "lat"], "left")
    return out.select("lon", "lat", F.coalesce("region", F.lit("UNKNOWN")).alias("city_name"))


def q_partition_counts(spark, sf_dir):
    return count_by_partition(trips(spark, sf_dir, with_region=False), "ptd")


def q_partition_stats(spark, sf_dir):
    d = profile.describe_by(trips(spark, sf_dir, with_region=False), STATS_COLUMNS, by="ptd")
    return d.select("ptd", "column", "count", *[_round(F.col(c)).alias(c) for c in ("mean", "stddev", "min", "max")])


def q_partition_quartiles(spark, sf_dir):
    d = profile.describe_quartiles(trips(spark, sf_dir, with_region=False), DESCRIBE_COLUMNS, by="ptd")
    stats = ("mean", "stddev", "min", "p25", "p50", "p75", "max")
    return d.select("ptd", "column", "count", *[_round(F.col(c)).alias(c) for c in stats])


def q_describe_all(spark, sf_dir):
    """The 8 describe statistics over all partitions together."""
    d = profile.describe_quartiles(trips(spark, sf_dir, with_region=False), DESCRIBE_COLUMNS)
    return d.select("column", "count", *[_round(F.col(c)).alias(c) for c in ("mean", "stddev", "min", "p25", "p50", "p75", "max")])


def q_hourly_describe(spark, sf_dir):
    """The 8 describe statistics of the hourly table."""
    d = profile.describe_quartiles(_hourly(spark, sf_dir), HOURLY_NUMERIC)
    return d.select("column", "count", *[_round(F.col(c)).alias(c) for c in ("mean", "stddev", "min", "p25", "p50", "p75", "max")])


def q_year_trips(spark, sf_dir):
    """One year of the enriched trips (a partition filter)."""
    return trips(spark, sf_dir, with_region=False).where(F.col("ptd") == CHAIN_YEAR).drop("city_name")


def q_null_audit(spark, sf_dir):
    return profile.null_audit(load_raw_trips(spark, sf_dir))


def q_category_counts(spark, sf_dir):
    return profile.category_counts(trips(spark, sf_dir, with_region=False), CATEGORY_COLUMNS)


def q_category_decode(spark, sf_dir):
    """Trips per decoded label combination (codes -> labels, unknown code -> NULL)."""
    from tripflow.schema import TRIP_CATEGORY_DECODINGS
    t = trips(spark, sf_dir, with_region=False)
    labels = [decode(c, m).alias(f"{c}_label") for c, m in TRIP_CATEGORY_DECODINGS.items()]
    return t.select(*labels).groupBy(*[f"{c}_label" for c in TRIP_CATEGORY_DECODINGS]).agg(
        F.count(F.lit(1)).alias("trips"))


def _hourly(spark, sf_dir):
    return hourly_usage(trips(spark, sf_dir))


def q_corr_matrix(spark, sf_dir):
    c = profile.corr_long(_hourly(spark, sf_dir), HOURLY_NUMERIC)
    return c.select("col_a", "col_b", _round(F.col("value")).alias("value"))


def q_cov_matrix(spark, sf_dir):
    c = profile.cov_long(_hourly(spark, sf_dir), HOURLY_NUMERIC)
    return c.select("col_a", "col_b", _round(F.col("value"), 4).alias("value"))


def q_mean_ci_by_category(spark, sf_dir):
    m = profile.mean_ci(_hourly(spark, sf_dir), "used_count", CI_CATEGORIES)
    return m.select("category", "level", "n", *[_round(F.col(c)).alias(c)
                                                for c in ("mean", "stddev", "ci_low", "ci_high")])


def q_station_dim(spark, sf_dir):
    return stations.station_dim(trips(spark, sf_dir, with_region=False))


def q_station_activity(spark, sf_dir):
    return stations.station_activity(trips(spark, sf_dir, with_region=False))


def q_od_counts(spark, sf_dir):
    return stations.od_counts(trips(spark, sf_dir, with_region=False))


def q_station_share(spark, sf_dir):
    s = stations.station_share(trips(spark, sf_dir, with_region=False))
    return s.select("station", "starts", "ends", "round_trips", "touching",
                    _round(F.col("share"), 8).alias("share"), _round(F.col("self_loop_share"), 8).alias("self_loop_share"))


def q_station_set_diff(spark, sf_dir):
    """Origin-only and destination-only stations (raw trips, so even rows without
    coordinates take part)."""
    return stations.set_diff(load_raw_trips(spark, sf_dir), "start_station", "end_station")


# Event documents and, in between, ones that are missing, broken, of another type or incomplete.
EVENT_DOC = """CASE event_id % 13 WHEN 1 THEN NULL WHEN 2 THEN '{"k":"x"}' WHEN 3 THEN '[1,2]' WHEN 4 THEN 'bad' WHEN 5 THEN '7'
  WHEN 6 THEN '{"ref":"r"}' WHEN 7 THEN '{"k":null}' WHEN 8 THEN '{"k":' ELSE props END"""


def q_json_conformance(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return profile.json_conformance(ev.selectExpr(f"{EVENT_DOC} AS doc"), "doc", "k INT, ref STRING", required=["k"])


#: Nested documents over the events, one kind of broken ones for most remainders (both engines).
NESTED_DOC = """CASE event_id % 17 WHEN 1 THEN NULL WHEN 2 THEN 'bad' WHEN 3 THEN '[1]' ELSE concat('{"id":',
  CASE event_id % 17 WHEN 14 THEN '1.5' WHEN 15 THEN '-1' ELSE CAST(event_id AS STRING) END, ',"kind":"', event_type, '"',
  CASE event_id % 17 WHEN 5 THEN '' WHEN 6 THEN ',"props":{"ref":"r"}' WHEN 7 THEN ',"props":{"k":"x"}' ELSE concat(',"props":', props) END,
  CASE event_id % 17 WHEN 8 THEN ',"tags":["t1","x2"]' WHEN 9 THEN ',"tags":["t1","t2",3]' WHEN 10 THEN ',"tags":["t1","t2","t3","t4"]'
    WHEN 16 THEN ',"tags":["t1234"]' WHEN 0 THEN '' ELSE ',"tags":["t1","t22"]' END,
  CASE event_id % 17 WHEN 11 THEN ',"extra":1' WHEN 12 THEN ',"note":null' WHEN 13 THEN ',"note":3' ELSE ',"note":"n"' END,
  '}', CASE event_id % 17 WHEN 4 THEN '}' ELSE '' END) END"""
NESTED_SCHEMA = {
    "type": "object", "required": ["id", "kind", "props"], "additionalProperties": False,
    "properties": {
        "id": {"type": "integer", "minimum": 0},
        "kind": {"type": "string", "enum": ["click", "view", "purchase", "signup"]},
        "props": {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "minimum": 0, "maximum": 89}}},
        "tags": {"type": "array", "maxItems": 3, "items": {"type": "string", "maxLength": 3, "pattern": "^t[0-9]+$"}},
        "note": {"type": ["string", "null"]},
    },
}


def q_json_validation(spark, sf_dir):
    """Every event's document against a nested schema: ``Success`` or the first broken path."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id", f"{NESTED_DOC} AS doc")
    return ev.select("event_id", json_schema.validate("doc", NESTED_SCHEMA).alias("verdict"))


def q_time_functions(spark, sf_dir):
    """Every per-row date/time helper over the whole raw trip feed."""
    raw = load_raw_trips(spark, sf_dir)
    st = timefn.parse_trip_time("start_time")
    et = timefn.parse_trip_time("end_time")
    t = raw.select("trip_id", "start_time", st.alias("st"), et.alias("et"))
    parts = timefn.date_parts("start_time")
    return t.select(
        "trip_id",
        timefn.time_format("start_time").alias("start_format"),
        timefn.date_token("start_time").alias("date_token"),
        timefn.hour_token("start_time").alias("hour_token"),
        timefn.year_token("start_time").alias("year_token"),
        parts["year"].alias("part_year"), parts["month"].alias("part_month"), parts["day"].alias("part_day"),
        timefn.minutes_between("st", "et").alias("used_minutes"),
        timefn.minutes_between("et", "st", wrap_days=True).alias("used_minutes_wrapped"),
        timefn.epoch_millis("st").alias("epoch_ms"),
        timefn.epoch_seconds("st").alias("epoch_s"),
        timefn.datetime_label(timefn.from_epoch_seconds(timefn.epoch_seconds("st"))).alias("from_epoch"),
        timefn.prev_day("st").alias("prev_day"),
        timefn.next_day_label("st").alias("next_day"),
        timefn.last_month_label("st").alias("last_month"),
        timefn.date_label("st").alias("day_str"),
        timefn._pad(F.hour("st"), 2).alias("hour_str"),
        timefn.month_label("st").alias("month_str"),
        timefn.compare_times("st", "et").alias("cmp_time"),
        timefn.compare_dates("st", "et").alias("cmp_date"),
        timefn.days_within("st", "et", 0, 1).alias("within_a_day"),
    )


def q_date_spine(spark, sf_dir):
    """Trips per calendar day from the first to the last trip day, zero-filled."""
    from tripflow.operators.rollup import fill_gaps
    t = trips(spark, sf_dir, with_region=False)
    daily = t.groupBy(F.to_date("start_datetime").alias("day")).agg(F.count(F.lit(1)).alias("trips"))
    daily = daily.where(F.col("day").isNotNull())
    filled = fill_gaps(daily, "day", "D", zero_cols=["trips"])
    return filled.select(timefn.date_label("day").alias("day"), "trips",
                         (F.weekday("day") + 1).cast("int").alias("iso_weekday"))


def q_month_shift(spark, sf_dir):
    """Month shifts of every distinct trip day: clamped and strict forms."""
    days = trips(spark, sf_dir, with_region=False).select(F.to_date("start_datetime").alias("d")).where(F.col("d").isNotNull()).distinct()
    cols = [timefn.date_label("d").alias("day")]
    for n in (1, -1, -13, 12):
        tag = f"p{n}" if n >= 0 else f"m{-n}"
        cols.append(timefn.date_label(timefn.shift_months("d", n)).alias(f"shift_{tag}"))
        cols.append(timefn.date_label(timefn.shift_months("d", n, strict=True)).alias(f"strict_{tag}"))
    return days.select(*cols)


def start_points(spark, sf_dir):
    """Trip start coordinates (x = lon, y = lat) of every trip with a start point."""
    raw = load_raw_trips(spark, sf_dir)
    return raw.select("trip_id", "start_station", F.col("start_lon").alias("x"), F.col("start_lat").alias("y")).dropna(
        subset=["x", "y"])


def weighted_start_points(spark, sf_dir):
    return cluster.with_point_ids(cluster.weighted_points(start_points(spark, sf_dir), ["x", "y"]), ["x", "y"])


def q_standard_scale(spark, sf_dir):
    s = cluster.standard_scale(start_points(spark, sf_dir), ["x", "y"], suffix="_scaled")
    return s.select("trip_id", _round(F.col("x_scaled"), 9).alias("x_scaled"), _round(F.col("y_scaled"), 9).alias("y_scaled"))


def q_k_distance(spark, sf_dir):
    kd = cluster.k_distance(weighted_start_points(spark, sf_dir), K_DISTANCE_K)
    return kd.select("x", "y", "w", _round(F.col("kdist"), 9).alias("kdist"))


def q_dbscan(spark, sf_dir):
    lab = cluster.dbscan(weighted_start_points(spark, sf_dir), DBSCAN_EPS, DBSCAN_MIN_SAMPLES)
    return lab.select("x", "y", "w", "degree", "is_core", "label")


def q_dbscan_sweep(spark, sf_dir):
    lab = cluster.dbscan_sweep(weighted_start_points(spark, sf_dir), DBSCAN_EPS, DBSCAN_SWEEP)
    return cluster.dbscan_summary(lab)


def _labelled_points(spark, sf_dir):
    return start_points(spark, sf_dir).withColumn("label", (F.col("start_station") % QUALITY_LABEL_MOD).cast("long"))


def q_davies_bouldin(spark, sf_dir):
    d = cluster.davies_bouldin_df(_labelled_points(spark, sf_dir), ["x", "y"], "label")
    return d.select(_round(F.col("davies_bouldin"), 6).alias("davies_bouldin"))


def q_silhouette(spark, sf_dir):
    s = cluster.silhouette_df(_labelled_points(spark, sf_dir), ["x", "y"], "label")
    return s.select(_round(F.col("silhouette"), 6).alias("silhouette"))


def q_silhouette_euclidean(spark, sf_dir):
    s = silhouette_euclidean_df(_labelled_points(spark, sf_dir), "x", "y", "label", tolerance=1e-6)
    return s.select(_round(F.col("silhouette"), 6).alias("silhouette"))


def _chain(spark, sf_dir):
    """One year's start points, scaled, and their DBSCAN labels: (x, y raw), (sx, sy scaled), label."""
    raw = load_raw_trips(spark, sf_dir).where(F.col("ptd") == CHAIN_YEAR)
    pts = raw.select(F.col("start_lon").alias("x"), F.col("start_lat").alias("y")).dropna()
    scaled = cluster.standard_scale(pts, ["x", "y"], suffix="_scaled").withColumnsRenamed({"x_scaled": "sx", "y_scaled": "sy"})
    w = cluster.with_point_ids(cluster.weighted_points(scaled, ["sx", "sy", "x", "y"]), ["sx", "sy"])
    lab = cluster.dbscan(w, CHAIN_EPS, CHAIN_MIN_SAMPLES, x="sx", y="sy")
    return w.join(lab.select("id", "label", "is_core"), "id")


def q_dbscan_scaled(spark, sf_dir):
    """DBSCAN of one year's start points on scaled coordinates."""
    return _chain(spark, sf_dir).select("x", "y", "w", "is_core", "label")


def q_davies_bouldin_dbscan(spark, sf_dir):
    """Davies-Bouldin of those labels on the raw coordinates, noise as a cluster of its own."""
    d = cluster.davies_bouldin_df(_chain(spark, sf_dir), ["x", "y"], "label", weight="w", include_noise=True)
    return d.select(_round(F.col("davies_bouldin"), 6).alias("davies_bouldin"))


def q_dbscan_cluster_sizes(spark, sf_dir):
    """Points and trips of every cluster of every sweep setting."""
    lab = cluster.dbscan_sweep(weighted_start_points(spark, sf_dir), DBSCAN_EPS, DBSCAN_SWEEP)
    return cluster.cluster_sizes(lab)


def _kmeans(spark, sf_dir):
    pts = cluster.weighted_points(start_points(spark, sf_dir), ["x", "y"])
    labels, centers = cluster.lloyd(pts, ["x", "y"], KMEANS_START, KMEANS_ROUNDS, weight="w")
    table = spark.createDataFrame([(i, *c) for i, c in enumerate(centers)], "label long, center_x double, center_y double")
    return labels, table.select("label", _round(F.col("center_x"), 9).alias("center_x"), _round(F.col("center_y"), 9).alias("center_y"))


def q_kmeans_sizes(spark, sf_dir):
    """The largest clusters with their centres (k-means rounds from given centres)."""
    labels, centers = _kmeans(spark, sf_dir)
    return cluster.top_clusters(labels, centers, n=len(KMEANS_START), weight="w")


def q_kmeans_centers(spark, sf_dir):
    return _kmeans(spark, sf_dir)[1]


def q_kmeans_labels(spark, sf_dir):
    """Every distinct start point with the number of its nearest centre."""
    return _kmeans(spark, sf_dir)[0].select("x", "y", "w", "label")


def _with_period(spark, sf_dir):
    raw = load_raw_trips(spark, sf_dir)
    st = timefn.parse_trip_time("start_time")
    return raw.withColumn("period", F.concat(F.year(st).cast("string"), F.lit("-q"), F.quarter(st).cast("string")))


def q_csv_roundtrip(spark, sf_dir):
    """Raw trips written as period-named CSV files (one set per quarter) and read back
    through the period CSV source."""
    from tripflow.sources.sinks import scratch_path, write_period_csv
    from tripflow.sources.trips_csv import read_period_csv, trips_with_period
    path = scratch_path(spark, "csv")
    write_period_csv(_with_period(spark, sf_dir).drop("ptd"), path)
    back = trips_with_period(read_period_csv(spark, path))
    return back.drop("_corrupt_record", "source_file")


def q_rejected_rows(spark, sf_dir):
    """The load's report over period files, some of whose rows lack coordinates; rows of odd days
    come in a file without a period."""
    from tripflow.sources.sinks import scratch_path, write_period_csv
    from tripflow.sources.trips_csv import read_period_csv, rejected_rows
    path = scratch_path(spark, "csv")
    raw = _with_period(spark, sf_dir)
    odd = raw.withColumn("period", F.when(F.col("trip_id") % 10 == 0, F.lit("latest")).otherwise(F.col("period")))
    write_period_csv(odd.drop("ptd"), path)
    return rejected_rows(read_period_csv(spark, path)).select("source_file", "reason", "rows")


def q_partition_reload(spark, sf_dir):
    """Enriched trips loaded quarter by quarter into the partitioned table: the odd quarters first,
    then the even ones, then one quarter again after it had been loaded with a part of its rows;
    and read back."""
    from tripflow.plans.batch_job import load_trip_table, load_trips
    from tripflow.plans.sizing import stored
    from tripflow.sources.sinks import remove_path, scratch_path
    path, regions = scratch_path(spark, "dw"), regions_from_rows(spark, TRIP_REGIONS)
    # Filters by quarter on rows as they are made would parse each start time anew, below the spread of the scan.
    raw, copy = stored(_with_period(spark, sf_dir), "trips")
    quarter = F.substring("period", 7, 1).cast("int")
    load_trips(raw.where(quarter.isin(1, 3)), regions, path)
    load_trips(raw.where((quarter == 2) & (F.col("trip_id") % 2 == 0)), regions, path)
    load_trips(raw.where(quarter.isin(2, 4)), regions, path)
    remove_path(spark, copy)
    return load_trip_table(spark, path).drop("period")


def q_trip_job(spark, sf_dir):
    """The whole job over period files: first the odd trips, then a rebuild with all of them; its loaded rows by
    period, hourly usage, distance by bike and rejects as (part, key, value)."""
    from tripflow.plans.batch_job import run_trip_job
    from tripflow.sources.sinks import scratch_path, write_period_csv
    raw, regions, dw = _with_period(spark, sf_dir).drop("ptd"), regions_from_rows(spark, TRIP_REGIONS), scratch_path(spark, "dw")
    for rows in (raw.where(F.col("trip_id") % 2 == 1), raw):
        src = scratch_path(spark, "csv")
        write_period_csv(rows, src)
        out = run_trip_job(spark, src, dw, regions)
    parts = {
        "trips": out["trip_details"].groupBy("period").agg(F.count(F.lit(1)).alias("v")).withColumnRenamed("period", "k"),
        "hour": out["app_trip_cnt_by_hour"].select(F.col("start_hour").alias("k"), F.col("used_count").alias("v")),
        "bike": out["bike_distance"].select(F.col("bike_id").cast("string").alias("k"), F.col("sum_distance").alias("v")),
        "rejected": out["rejected"].select(F.concat_ws(" ", "source_file", "reason").alias("k"), F.col("rows").alias("v")),
    }
    rows = [df.select(F.lit(n).alias("part"), F.col("k").alias("key"), _round(F.col("v").cast("double"), 1).alias("value")) for n, df in parts.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


def q_export_roundtrip(spark, sf_dir):
    """The hourly table written as sorted CSV and as JSON lines, both read back and compared by hour."""
    from tripflow.sources.sinks import export_csv, export_json, scratch_path
    hourly = _hourly(spark, sf_dir).select("start_hour", "used_count", "total_duration")
    csv, json = scratch_path(spark, "export-csv"), scratch_path(spark, "export-json")
    export_csv(hourly, csv, max_rows=1000, sort=["start_hour"])
    export_json(hourly, json)
    ddl = "start_hour string, used_count long, total_duration long"
    a = spark.read.schema(ddl).option("header", True).csv(csv)
    b = spark.read.schema(ddl).json(json)
    return a.join(b.withColumnsRenamed({"used_count": "json_count", "total_duration": "json_duration"}), "start_hour")


def q_region_document(spark, sf_dir):
    """Start points inside (boundary included) the regions of a GeoJSON document that is written and
    read by name."""
    import json

    from tripflow.sources.regions import regions_from_geojson
    from tripflow.sources.sinks import scratch_path
    path = scratch_path(spark, "regions")
    doc = json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name": n}, "geometry": {"type": "MultiPolygon", "coordinates": c}} for n, c in TAG_REGIONS]})
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.text(path)
    pts = weighted_start_points(spark, sf_dir).select("x", "y", "w")
    tags = tag_points(pts, regions_from_geojson(spark, path, names=["PASADENA"]), "x", "y", boundary=True)
    return pts.join(tags, ["x", "y"], "left").groupBy("region").agg(F.count(F.lit(1)).alias("points"), F.sum("w").alias("trips"))


def q_month_spine(spark, sf_dir):
    """Trips per month on a month spine of step 2, and per week on an open spine, zero-filled."""
    t = trips(spark, sf_dir, with_region=False).where(F.col("start_datetime").isNotNull())
    lo, hi = t.agg(F.date_trunc("month", F.min("start_datetime")), F.date_trunc("month", F.max("start_datetime"))).first()
    out = None
    for unit, step, closed, cut in (("M", 2, True, "month"), ("W", 1, False, "week"), ("Y", 1, True, "year")):
        points = timefn.date_spine(spark, str(lo), str(hi), unit, step, closed)
        counted = t.groupBy(F.date_trunc(cut, "start_datetime").cast("timestamp_ntz").alias("at")).agg(F.count(F.lit(1)).alias("trips"))
        keyed = points.withColumn("at", F.date_trunc(cut, "ts").cast("timestamp_ntz"))
        part = keyed.join(counted, "at", "left").select(F.lit(unit).alias("unit"), timefn.date_label("ts").alias("day"), F.coalesce("trips", F.lit(0)).cast("long").alias("trips"))
        out = part if out is None else out.unionByName(part)
    return out


def q_top_od_pairs(spark, sf_dir):
    """The 10 busiest origin-destination pairs (a top-k report: the limit is the feature)."""
    od = stations.od_counts(trips(spark, sf_dir, with_region=False))
    return od.orderBy(F.desc("trips"), F.asc("start_station"), F.asc("end_station")).limit(10)


def q_unmapped_categories(spark, sf_dir):
    """Non-NULL labels per raw category column that do not map to a code."""
    from tripflow.functions.categories import unmapped_report
    from tripflow.schema import TRIP_CATEGORY_ENCODINGS
    return unmapped_report(load_raw_trips(spark, sf_dir), TRIP_CATEGORY_ENCODINGS)


def q_complete_rows(spark, sf_dir):
    """Rows per year, and how many of them have no NULL (one conditional count)."""
    raw = load_raw_trips(spark, sf_dir)
    full = F.lit(True)
    for c in raw.columns:
        full = full & F.col(c).isNotNull()
    return raw.groupBy("ptd").agg(F.count(F.lit(1)).alias("rows"), F.count_if(full).alias("complete_rows"))


def q_k_distance_curve(spark, sf_dir):
    """k-distance curve: total weight per distinct k-th neighbour distance (sorted)."""
    kd = cluster.k_distance(weighted_start_points(spark, sf_dir), K_DISTANCE_K)
    return (kd.groupBy(_round(F.col("kdist"), 9).alias("kdist")).agg(F.sum("w").alias("weight"))
            .orderBy("kdist"))


def q_mean_ci_bootstrap(spark, sf_dir):
    """Poisson-bootstrap CI of hourly usage per working-day flag: every hour drawn in every replicate (from md5)."""
    m = profile.mean_ci_bootstrap(_hourly(spark, sf_dir), "used_count", "workingday", replicates=BOOTSTRAP_REPLICATES, key="start_hour")
    return m.select("level", *[_round(F.col(c)).alias(c) for c in ("mean", "ci_low", "ci_high")])


QUERIES: dict[str, QueryFn] = {
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
    "describe_all": q_describe_all,
    "hourly_describe": q_hourly_describe,
    "year_trips": q_year_trips,
    "null_audit": q_null_audit,
    "category_counts": q_category_counts,
    "category_decode": q_category_decode,
    "corr_matrix": q_corr_matrix,
    "cov_matrix": q_cov_matrix,
    "mean_ci_by_category": q_mean_ci_by_category,
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
    "kmeans_sizes": q_kmeans_sizes,
    "kmeans_centers": q_kmeans_centers,
    "kmeans_labels": q_kmeans_labels,
    "dbscan_scaled": q_dbscan_scaled,
    "davies_bouldin_dbscan": q_davies_bouldin_dbscan,
    "dbscan_cluster_sizes": q_dbscan_cluster_sizes,
    "csv_roundtrip": q_csv_roundtrip,
    "partition_reload": q_partition_reload,
    "trip_job": q_trip_job,
    "rejected_rows": q_rejected_rows,
    "export_roundtrip": q_export_roundtrip,
    "region_document": q_region_document,
    "month_spine": q_month_spine,
    "top_od_pairs": q_top_od_pairs,
    "unmapped_categories": q_unmapped_categories,
    "complete_rows": q_complete_rows,
    "k_distance_curve": q_k_distance_curve,
    "mean_ci_bootstrap": q_mean_ci_bootstrap,
}
