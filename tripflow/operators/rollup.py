"""Keyed rollups with conditional counts (one partial + final aggregation per call)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.timefn import hour_mode_flags
from tripflow.plans.sizing import materialize
from tripflow.schema import PLAN_DAY, PLAN_MONTH, PLAN_YEAR

# --- Fixed values: output column -> (enriched column, code) of the hourly usage rollup. ---
HOURLY_CONDITIONAL_COUNTS = {
    "plan_duration_day_count": ("plan_duration", PLAN_DAY),
    "plan_duration_month_count": ("plan_duration", PLAN_MONTH),
    "plan_duration_year_count": ("plan_duration", PLAN_YEAR),
    "trip_route_type_one_way_count": ("trip_route_type", 1),
    "trip_route_type_round_trip_count": ("trip_route_type", 2),
    "passholder_type_walk_up_count": ("passholder_type", 1),
    "passholder_type_one_day_count": ("passholder_type", 2),
    "passholder_type_monthly_count": ("passholder_type", 3),
    "passholder_type_annual_count": ("passholder_type", 4),
    "bike_type_standard_count": ("bike_type", 1),
    "bike_type_electric_count": ("bike_type", 2),
    "bike_type_smart_count": ("bike_type", 3),
}

# --- end of fixed values ---

HOURLY_COLUMNS = (["start_hour", "used_count", "total_duration"] + list(HOURLY_CONDITIONAL_COUNTS)
                  + ["season", "holiday", "workingday",
                     "hour_is_morning_evening", "hour_is_noon", "hour_is_idle"])


def conditional_counts(df: DataFrame, keys: Sequence[str], *, count_col: str | None = "count",
                       sums: Mapping[str, str] | None = None,
                       counts: Mapping[str, Column] | None = None,
                       maxes: Mapping[str, str] | None = None) -> DataFrame:
    """groupBy(keys) with row count, sums, ``count_if`` conditions and maxima in one pass."""
    aggs = []
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    for out, c in (sums or {}).items():
        aggs.append(F.sum(c).cast("long").alias(out))
    for out, cond in (counts or {}).items():
        aggs.append(F.count_if(cond).alias(out))
    for out, c in (maxes or {}).items():
        aggs.append(F.max(c).alias(out))
    return df.groupBy(*keys).agg(*aggs)


def hourly_usage(trips: DataFrame, region: str | None = "LA", region_col: str = "city_name",
                 hour_col: str = "start_hour") -> DataFrame:
    """Hourly rollup of enriched trips in one region: counts, total duration, twelve
    conditional counts, max season/holiday/workingday, and three hour-mode flags."""
    src = trips.where(F.col(region_col) == region) if region is not None else trips
    counts = {out: F.col(c) == code for out, (c, code) in HOURLY_CONDITIONAL_COUNTS.items()}
    agg = conditional_counts(src, [hour_col], count_col="used_count", sums={"total_duration": "duration"},
                             counts=counts, maxes={"season": "season", "holiday": "holiday",
                                                   "workingday": "workingday"})
    hour = F.substring(F.col(hour_col), 12, 2).cast("int")
    return agg.withColumns(hour_mode_flags(hour)).select(*HOURLY_COLUMNS)


def fill_hour_gaps(rollup: DataFrame, hour_col: str = "start_hour", zero_cols: Sequence[str] | None = None) -> DataFrame:
    """Left-join the rollup onto every clock hour from its first to its last hour, so hours
    without trips appear with zero counts.

    The rollup (one row per hour with trips, bounded by the time span) is stored because it is
    read twice: once for its bounds (two scalars) and once for the join.  The spine is
    generated by ``spark.range`` - split across tasks, never one array in one row.
    """
    from tripflow.functions.timefn import hour_label

    rollup = materialize(rollup, "rollup")
    ts = F.to_timestamp_ntz(F.col(hour_col), F.lit("yyyy-MM-dd HH:mm:ss"))
    lo, hi = rollup.agg(F.min(ts), F.max(ts)).first()
    spark = rollup.sparkSession
    zero_cols = list(zero_cols) if zero_cols is not None else [
        c for c in rollup.columns if c.endswith("_count") or c == "total_duration"]
    if lo is None:
        return rollup
    hours = int((hi - lo).total_seconds() // 3600) + 1
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), hours // 10000 + 1))
    spine = spark.range(0, hours, 1, parts).select(
        hour_label(F.timestamp_add("HOUR", F.col("id"), F.lit(lo).cast("timestamp_ntz"))).alias(hour_col))
    out = spine.join(rollup, hour_col, "left")
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in zero_cols})
    hour = F.substring(F.col(hour_col), 12, 2).cast("int")
    flags = {k: v for k, v in hour_mode_flags(hour).items() if k in rollup.columns}
    return out.withColumns(flags).select(*rollup.columns)


def sum_by(df: DataFrame, key: str, value: str, where: Column | None = None, out: str | None = None) -> DataFrame:
    """sum(value) per key, optionally filtered."""
    src = df.where(where) if where is not None else df
    return src.groupBy(key).agg(F.sum(value).alias(out or f"sum_{value}"))


def count_by_partition(df: DataFrame, part_col: str = "ptd") -> DataFrame:
    """Row count per partition value, all partitions in one aggregation."""
    return df.groupBy(part_col).agg(F.count(F.lit(1)).alias("row_count"))


def fill_gaps(df: DataFrame, key: str, unit: str = "D", step: int = 1,
              zero_cols: Sequence[str] | None = None) -> DataFrame:
    """Left-join ``df`` onto the spine of ``key`` values (a date or timestamp column) from its
    minimum to its maximum every ``step`` ``unit``; missing keys get 0 in ``zero_cols`` and
    NULL elsewhere.  ``df`` (an aggregate, bounded by the calendar span) is stored since it
    is read for its bounds and for the join; the spine is a distributed ``spark.range``."""
    from tripflow.functions.timefn import spine_frame

    key_type = dict(df.dtypes)[key]
    df = materialize(df, "keyed")
    lo, hi = df.agg(F.min(key), F.max(key)).first()
    if lo is None:
        return df
    if lo == hi:
        spine = df.sparkSession.range(1).select(F.lit(lo).cast(key_type).alias(key))
    else:
        spine = spine_frame(df.sparkSession, lo, hi, unit, step).select(F.col("ts").cast(key_type).alias(key))
    out = spine.join(df, key, "left")
    zero_cols = list(zero_cols or [])
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero_cols}).select(*df.columns)
