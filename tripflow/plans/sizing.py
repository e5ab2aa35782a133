"""Intermediate tables in the shared checkpoint folder, and a floor under scan parallelism."""

from __future__ import annotations

from pyspark.sql import DataFrame


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet into the shared checkpoint folder and reading
    it back (columnar and compact; survives executor loss like ``checkpoint()``)."""
    return stored(df, name)[0]


def stored(df: DataFrame, name: str = "stage") -> tuple[DataFrame, str]:
    """``materialize``, and the path of the table, for ``remove_path`` once its last reader is done."""
    from tripflow.sources.sinks import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def ensure_min_partitions(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread an under-partitioned scan (e.g. one large unsplittable file) over at least
    ``min_partitions`` tasks (default: the cluster's default parallelism).  Reads the planned
    partition count only (no job); inputs that already have enough splits pass unchanged."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    n = df.rdd.getNumPartitions()
    return df.repartition(target) if n < target else df
