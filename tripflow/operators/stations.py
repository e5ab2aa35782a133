"""Station operators: dimension, activity span, origin-destination counts, share of
trips touching a station, and set comparison of origin vs destination stations.

All of them run for every station at once (grouped aggregations), never per station in a
driver loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.timefn import datetime_label


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def station_dim(trips: DataFrame, order_col: str = "trip_id") -> DataFrame:
    """(station, side, lat, lon): each station's coordinate from its first trip (smallest
    ``order_col``) on the start side and on the end side."""
    def side(name, st, lat, lon):
        return (trips.where(F.col(st).isNotNull())
                .groupBy(F.col(st).alias("station"))
                .agg(F.min_by(F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon")), F.col(order_col)).alias("p"))
                .select("station", F.lit(name).alias("side"), "p.lat", "p.lon"))
    return side("start", "start_station", "start_lat", "start_lon").unionByName(
        side("end", "end_station", "end_lat", "end_lon"))


def station_activity(trips: DataFrame, ts_col: str = "start_datetime") -> DataFrame:
    """First / last trip time from and to every station (``yyyy-MM-dd HH:mm:ss``)."""
    dep = trips.where(F.col("start_station").isNotNull()).groupBy(F.col("start_station").alias("station")).agg(
        F.min(ts_col).alias("first_departure"), F.max(ts_col).alias("last_departure"),
        F.count(F.lit(1)).alias("departures"))
    arr = trips.where(F.col("end_station").isNotNull()).groupBy(F.col("end_station").alias("station")).agg(
        F.min(ts_col).alias("first_arrival"), F.max(ts_col).alias("last_arrival"),
        F.count(F.lit(1)).alias("arrivals"))
    out = dep.join(arr, "station", "full")
    return out.select(
        "station",
        F.coalesce("departures", F.lit(0)).alias("departures"), F.coalesce("arrivals", F.lit(0)).alias("arrivals"),
        *[datetime_label(c).alias(c) for c in ("first_departure", "last_departure", "first_arrival", "last_arrival")])


def od_counts(trips: DataFrame, origin: str = "start_station", dest: str = "end_station") -> DataFrame:
    """Trips per (origin, destination) pair."""
    return trips.groupBy(origin, dest).agg(F.count(F.lit(1)).alias("trips"))


def station_share(trips: DataFrame, origin: str = "start_station", dest: str = "end_station") -> DataFrame:
    """For every station: trips that start or end there, round trips there, and their share
    of all trips.  Per-side counts are pre-aggregated before the union, so a hot station is
    a handful of partial rows, never a large group."""
    side = (trips.groupBy(F.col(origin).alias("station")).agg(
                F.count(F.lit(1)).alias("starts"), F.lit(0).cast("long").alias("ends"),
                F.count_if(F.col(origin) == F.col(dest)).alias("round_trips"))
            .unionByName(trips.groupBy(F.col(dest).alias("station")).agg(
                F.lit(0).cast("long").alias("starts"), F.count(F.lit(1)).alias("ends"),
                F.lit(0).cast("long").alias("round_trips"))))
    per = side.where(F.col("station").isNotNull()).groupBy("station").agg(
        F.sum("starts").alias("starts"), F.sum("ends").alias("ends"), F.sum("round_trips").alias("round_trips"))
    spark = trips.sparkSession
    return spark.sql(
        "SELECT station, starts, ends, round_trips, starts + ends - round_trips AS touching, "
        "(starts + ends - round_trips) / (SELECT count(*) FROM {trips}) AS share, "
        "round_trips / nullif(starts, 0) AS self_loop_share FROM {per}", trips=trips, per=per)


def set_diff(df: DataFrame, a: str, b: str) -> DataFrame:
    """Values present in column ``a`` but not ``b`` and vice versa: (value, only_in)."""
    va = distinct_values(df, a).withColumnRenamed(a, "value")
    vb = distinct_values(df, b).withColumnRenamed(b, "value")
    return (va.subtract(vb).withColumn("only_in", F.lit(a))
            .unionByName(vb.subtract(va).withColumn("only_in", F.lit(b))))


def sets_equal(df: DataFrame, a: str, b: str) -> bool:
    """True when the distinct sets of ``a`` and ``b`` are equal (one bounded action)."""
    return set_diff(df, a, b).limit(1).count() == 0
