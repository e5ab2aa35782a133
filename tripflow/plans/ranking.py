"""Distributed ranking: order statistics without gathering a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripflow.plans.sizing import materialize


def dense_rank_distributed(df: DataFrame, part_cols: Sequence[str], order_cols: Sequence[str],
                           out: str = "rank", partitions: int | None = None) -> DataFrame:
    """0-based dense rank of the distinct ``order_cols`` values within each ``part_cols``
    group, as (part_cols..., order_cols..., out).

    The distinct keys are range-partitioned and sorted across tasks; a key's rank is its
    position inside its task plus the number of keys of its group in earlier tasks (a table
    of at most tasks x groups rows).  A group with millions of keys is spread over many tasks.
    """
    part, order = list(part_cols), list(order_cols)
    keys = df.select(*part, *order).distinct()
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    o = keys.repartitionByRange(n, *part, *order).sortWithinPartitions(*part, *order)
    o = o.select(*part, *order, F.spark_partition_id().alias("__pid"), F.monotonically_increasing_id().alias("__mid"))
    o = o.select(*part, *order, "__pid",
                 (F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)).alias("__local"))
    o = materialize(o, "rank")  # fixes each key's (task, position) for both uses below
    blocks = o.groupBy(*part, "__pid").agg(F.count(F.lit(1)).alias("__cnt"), F.min("__local").alias("__start"))
    w = Window.partitionBy(*part).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__off", F.coalesce(F.sum("__cnt").over(w), F.lit(0)))
    ranked = o.join(blocks.select(*part, "__pid", "__start", "__off"), part + ["__pid"])
    return ranked.select(*part, *order, (F.col("__off") + F.col("__local") - F.col("__start")).alias(out))
