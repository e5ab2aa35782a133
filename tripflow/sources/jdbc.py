"""JDBC table reads (MySQL-style URL) with partitioned parallel reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(host: str, db: str, table: str, user: str, password: str, port: int = 3306, *,
                 driver: str = "com.mysql.cj.jdbc.Driver", partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int | None = None, fetchsize: int = 10_000) -> dict[str, str]:
    """Reader options for ``spark.read.format('jdbc')``.  With a numeric ``partition_column``
    and bounds, executors read ``num_partitions`` ranges in parallel instead of one task."""
    opts = {"url": f"jdbc:mysql://{host}:{port}/{db}", "dbtable": table, "user": user, "password": password,
            "driver": driver, "fetchsize": str(fetchsize)}
    part = [partition_column, lower_bound, upper_bound, num_partitions]
    if any(p is not None for p in part):
        if any(p is None for p in part):
            raise ValueError("partition_column, lower_bound, upper_bound and num_partitions go together")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                     "upperBound": str(upper_bound), "numPartitions": str(num_partitions)})
    return opts


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    """Read a JDBC table with ``jdbc_options(**kwargs)``."""
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()
