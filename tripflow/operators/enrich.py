"""Clean and enrich raw trips in one projection (calendar, geography, category codes)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions import calendar, geo, timefn
from tripflow.functions.categories import encode
from tripflow.operators.region import region_of
from tripflow.schema import ENRICHED_COLUMNS, TRIP_CATEGORY_ENCODINGS

#: Stands for the day of a row without a start time; nothing of it is shown.
NO_DAY = date(1970, 1, 1)
COORDS = ["start_lat", "start_lon", "end_lat", "end_lon"]


def drop_missing_coordinates(raw: DataFrame, cols=COORDS) -> DataFrame:
    """Rows with a NULL in any of the coordinate columns are dropped."""
    return raw.na.drop(subset=list(cols))


def enrich_trips(raw: DataFrame, regions: DataFrame | None = None, *, region_name_default: str = "UNKNOWN",
                 region_lon: str = "start_lon", region_lat: str = "start_lat", region_band: float = 0.01,
                 strict_time: bool = False, period_col: str = "ptd", distance_mode: str = "pairs",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw trips -> enriched trips (``ENRICHED_COLUMNS`` order).

    * rows with a NULL coordinate are dropped;
    * ``distance`` = WGS-84 geodesic metres, ``distance_cal`` = haversine km (3 dp), both
      0.0 when a coordinate is missing.  ``distance_mode='pairs'`` (the default) runs the
      geodesic once per distinct coordinate pair and joins it back: trips between stations
      repeat their pairs millions of times.  ``'rows'`` runs it per row, for free-floating
      feeds whose pairs hardly repeat;
    * ``city_name`` = containing region of (``region_lon``, ``region_lat``) or the default;
    * ``used_date`` (yyyy-MM-dd), ``used_hour``, ``season``, ``holiday``, ``workingday``,
      ``start_hour`` (yyyy-MM-dd HH:00:00) all derive from one parse of ``start_time``;
    * route / pass / bike labels become integer codes (unlisted label -> NULL);
    * ``ptd`` is kept from the input when present, else the start year; ``keep`` names more input
      columns to carry along.
    """
    df = drop_missing_coordinates(raw)
    # One step builds on the one before, so no expression is generated twice, and the steps stand between the
    # joins, whose shuffles part the generated code: the JVM interprets a method of more than 8000 bytes.
    st = timefn.parse_trip_time("start_time", strict=strict_time)
    et = timefn.parse_trip_time("end_time", strict=False)
    df = df.withColumns({"start_datetime": st, "end_datetime": et})
    if regions is not None:
        df = region_of(df, region_lon, region_lat, regions, "city_name", default=region_name_default,
                       band=region_band)
    else:
        df = df.withColumn("city_name", F.lit(region_name_default))
    # The day without NULLs spares all that follows the checks for them; a row without a start has none of it.
    started = F.col("start_datetime").isNotNull()
    df = df.withColumn("__day", F.coalesce(F.to_date("start_datetime"), F.lit(NO_DAY)))
    # Holiday and label once per row: the working day and the hour's label reuse them.
    df = df.withColumns({"holiday": F.when(started, calendar.holiday_flag("__day")), "used_date": F.when(started, timefn.date_label("__day"))})
    if distance_mode == "pairs":
        df = geo.with_geodesic(df, *COORDS, out="__geodesic_m", unit="m")
        geodesic_m = F.col("__geodesic_m")
    elif distance_mode == "rows":
        geodesic_m = geo.geodesic(*COORDS, unit="m")
    else:
        raise ValueError("distance_mode must be 'rows' or 'pairs'")
    s = F.col("start_datetime")
    coords = [F.col(c) for c in COORDS]
    derived = {
        "distance": geo.null_safe(geodesic_m, *coords).cast("float"),
        "distance_cal": geo.null_safe(geo.haversine_km(*coords), *coords).cast("float"),
        "used_hour": F.hour(s).cast("int"),
        "season": F.when(started, timefn.season("__day")),
        "workingday": F.when(started, ((F.weekday("__day") < 5) & (F.col("holiday") == 0)).cast("int")),
        "start_hour": timefn.hour_label(s, "used_date"),
    }
    for src, (dst, mapping) in TRIP_CATEGORY_ENCODINGS.items():
        derived[dst] = encode(src, mapping)
    if period_col not in raw.columns:
        derived["ptd"] = F.year(s).cast("string")
    else:
        derived["ptd"] = F.col(period_col).cast("string")
    cols = []
    for c in ENRICHED_COLUMNS:
        cols.append(derived[c].alias(c) if c in derived else F.col(c))
    return df.select(*cols, *keep)
