"""The trip batch job: period CSVs -> enriched partitioned table -> app tables -> stats.

The caller owns the session.  Each stage is a DataFrame; the only actions are the table
load (a new version, shown once it is complete and counted) and the optional exports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripflow.operators.enrich import drop_missing_coordinates, enrich_trips
from tripflow.operators.profile import describe_by
from tripflow.operators.rollup import hourly_usage, sum_by
from tripflow.plans import versions
from tripflow.plans.catalog import create_database
from tripflow.plans.sizing import stored
from tripflow.schema import ENRICHED_TRIP_SCHEMA, RAW_TRIP_SCHEMA, STATS_COLUMNS
from tripflow.sources.sinks import export_csv, remove_path
from tripflow.sources.trips_csv import read_period_csv, rejected_rows, trips_with_period

#: The stored table: the enriched columns and the period, which is a partition beside the year.
TABLE_SCHEMA = StructType([*ENRICHED_TRIP_SCHEMA.fields, StructField("period", StringType(), True)])


def load_trip_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The enriched table with its declared schema (``ptd`` and ``period`` stay strings): the latest version or
    a given one; a folder without versions is read as it is."""
    if versions.versions(spark, path):
        return versions.read_version(spark, path, TABLE_SCHEMA, version)
    return spark.read.schema(TABLE_SCHEMA).parquet(path)


def load_trips(trips: DataFrame, regions: DataFrame | None, path: str, table: str | None = None,
               rebuild: bool = False, check: bool = True) -> int:
    """Enrich raw trips (with ``ptd`` and ``period``) and load them as the next version of the table at ``path``,
    which ``table`` (``db.name``, the database is created) then shows; returns the version.

    Partitions are (year, period): loading a period again replaces that period alone.
    ``rebuild=True`` replaces the whole table.  Until the new version is complete, and has the rows of
    every period (``check``: one more read of the source's coordinates), readers see the one before.
    ``trips`` is read several times: rows that are costly to make are better ``stored`` first."""
    enriched = enrich_trips(trips, regions, keep=("period",))
    by = ("ptd", "period")
    expected = drop_missing_coordinates(trips).groupBy(*by).agg(F.count(F.lit(1)).alias("rows")) if check else None
    version = versions.commit_load(enriched, path, by, replace=rebuild, expected=expected)
    if table:
        if "." in table:
            create_database(trips.sparkSession, table.split(".")[0])
        versions.publish(trips.sparkSession, path, table, TABLE_SCHEMA, by)
    return version


def build_trip_table(spark: SparkSession, src_dir: str, dw_path: str, regions: DataFrame | None = None,
                     rebuild: bool = False, table: str | None = None) -> DataFrame:
    """Read every period file once, enrich, and load by year and period (see ``load_trips``)."""
    raw = trips_with_period(read_period_csv(spark, src_dir))
    # A load reads its rows several times (points, pairs, counts, the rows): the text is parsed once.
    rows, copy = stored(raw.select(*[f.name for f in RAW_TRIP_SCHEMA.fields], "ptd", "period"), "period-rows")
    try:
        load_trips(rows, regions, dw_path, table, rebuild)
    finally:
        remove_path(spark, copy)
    return load_trip_table(spark, dw_path)


def build_app_tables(trips: DataFrame, region: str = "LA") -> dict[str, DataFrame]:
    """Hourly usage rollup and one-way distance per bike."""
    return {
        "app_trip_cnt_by_hour": hourly_usage(trips, region).orderBy("start_hour"),
        "bike_distance": sum_by(trips, "bike_id", "distance", F.col("trip_route_type") == 1, "sum_distance"),
    }


def run_trip_job(spark: SparkSession, src_dir: str, dw_path: str, regions: DataFrame | None = None, *,
                 rebuild: bool = True, export_dir: str | None = None, table: str | None = None) -> dict[str, DataFrame]:
    """Whole job: table load, app tables, per-year statistics, the report of rejected rows, and the
    optional CSV exports (the middle table, both app tables)."""
    trips = build_trip_table(spark, src_dir, dw_path, regions, rebuild, table)
    out = {"trip_details": trips, **build_app_tables(trips)}
    out["statistics"] = describe_by(trips, STATS_COLUMNS, by="ptd")
    out["rejected"] = rejected_rows(read_period_csv(spark, src_dir))
    if export_dir:
        export_csv(trips, f"{export_dir}/trip_details")
        export_csv(out["app_trip_cnt_by_hour"], f"{export_dir}/app_trip_cnt_by_hour", sort=["start_hour"])
        export_csv(out["bike_distance"], f"{export_dir}/bike_distance")
    return out

