"""Structured Streaming ingest of period CSV files.

New ``metro-trips-*.csv`` files are picked up by a file stream; each micro-batch is enriched
with the batch operator (``foreachBatch``) and written into its own ``run=<query>/batch=<id>``
folder.  A new checkpoint is a new run and never touches an older run's folders; a batch that is
retried after its commit is not written again, so a reader of the folders sees it once.  What a batch leaves
out, or reads in part, is reported by file under ``<dw_path>_rejects``, in the batch load's form.
A second query rolls the enriched stream up per clock hour with a watermark for late trips.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tripflow.functions.timefn import epoch_seconds, from_epoch_seconds, hour_label
from tripflow.operators.enrich import enrich_trips
from tripflow.operators.rollup import HOURLY_CONDITIONAL_COUNTS
from tripflow.schema import ENRICHED_TRIP_SCHEMA, RAW_TRIP_SCHEMA
from tripflow.sources.trips_csv import CORRUPT_COL, rejected_rows, with_file_period


def trip_file_stream(spark: SparkSession, src_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming raw trips (+ ``period``, ``ptd`` and ``source_file`` from the file name, and a line that does
    not fit the schema as it is)."""
    schema = StructType([*RAW_TRIP_SCHEMA.fields, StructField(CORRUPT_COL, StringType(), True)])
    r = (spark.readStream.schema(schema).option("header", True).option("columnNameOfCorruptRecord", CORRUPT_COL)
         .option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_file_period(r.csv(src_dir))


def rejects_path(dw_path: str) -> str:
    """The folder with the reports of rejects (source_file, reason, rows, sample; run and batch)."""
    return f"{dw_path.rstrip('/')}_rejects"


def start_trip_ingest(spark: SparkSession, src_dir: str, dw_path: str, checkpoint_location: str,
                      regions: DataFrame | None = None, available_now: bool = True,
                      max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the ingest query; ``available_now`` processes what is there and stops."""
    raw_cols = [f.name for f in RAW_TRIP_SCHEMA.fields]

    def load(batch: DataFrame, batch_id: int) -> None:
        # The query's id, as its checkpoint keeps it from the first start on.
        run = json.loads(spark.read.text(f"{checkpoint_location.rstrip('/')}/metadata").first()[0])["id"]
        folder = f"{dw_path.rstrip('/')}/run={run}/batch={batch_id}"
        done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder + "/_SUCCESS")
        if done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
            return
        # Written before the batch itself, whose end marks both as done.
        rejected_rows(batch).write.mode("overwrite").parquet(f"{rejects_path(dw_path)}/run={run}/batch={batch_id}")
        rows = batch.where(F.col("period").isNotNull()).select(*raw_cols, "ptd")
        enrich_trips(rows, regions).write.mode("overwrite").partitionBy("ptd").parquet(folder)

    w = (trip_file_stream(spark, src_dir, max_files_per_trigger).writeStream
         .option("checkpointLocation", checkpoint_location).foreachBatch(load))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def enriched_table_stream(spark: SparkSession, dw_path: str) -> DataFrame:
    """The ingested table as a stream (new batch folders arrive as new files)."""
    schema = StructType(list(ENRICHED_TRIP_SCHEMA.fields) + [StructField("run", StringType(), True), StructField("batch", StringType(), True)])
    return spark.readStream.schema(schema).option("recursiveFileLookup", False).parquet(dw_path)


def hourly_usage_stream(enriched: DataFrame, region: str = "LA", watermark: str = "2 hours") -> DataFrame:
    """Hourly usage counts per clock-hour window; a window is emitted once the watermark
    passes its end, trips later than the watermark are dropped by the engine."""
    # Streaming event time must be TIMESTAMP: read the wall clock as a UTC instant (epoch
    # seconds), so hour windows and labels do not depend on the session zone.
    instant = F.timestamp_seconds(epoch_seconds("start_datetime"))
    src = (enriched.where(F.col("city_name") == region).withColumn("__ts", instant)
           .withWatermark("__ts", watermark))
    aggs = [F.count(F.lit(1)).alias("used_count"), F.sum("duration").cast("long").alias("total_duration")]
    aggs += [F.count_if(F.col(c) == v).alias(n) for n, (c, v) in HOURLY_CONDITIONAL_COUNTS.items()]
    g = src.groupBy(F.window("__ts", "1 hour").alias("w")).agg(*aggs)
    start = from_epoch_seconds(F.unix_seconds(F.col("w.start")))
    return g.select(hour_label(start).alias("start_hour"), *[a for a in g.columns if a != "w"])
