"""Catalog, partition and plan helpers over ``spark.catalog`` and SQL DDL."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def quote(name: str) -> str:
    """Backtick-quote each dotted part of an identifier."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in name.split("."))


def _lit(v) -> str:
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, name: str, use: bool = True) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(name)}")
    if use:
        spark.catalog.setCurrentDatabase(name)


def list_databases(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def list_tables(spark: SparkSession, db: str | None = None) -> list[str]:
    """Tables and views; with ``db`` only its own, without the session's temporary views."""
    return [t.name for t in spark.catalog.listTables(db) if db is None or not t.isTemporary]


def table_info(spark: SparkSession, table: str) -> DataFrame:
    """``DESCRIBE FORMATTED`` rows (col_name, data_type, comment)."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {quote(table)}")


def list_partitions(spark: SparkSession, table: str) -> DataFrame:
    """``SHOW PARTITIONS`` as a DataFrame of ``k=v`` strings."""
    return spark.sql(f"SHOW PARTITIONS {quote(table)}")


def partition_values(spark: SparkSession, table: str, col: str = "ptd") -> DataFrame:
    """Distinct values of a partition column, from the catalog's partition list: no file is opened."""
    value = F.regexp_extract("partition", rf"(?:^|/){re.escape(col)}=([^/]*)", 1)
    plain = F.when(value != "__HIVE_DEFAULT_PARTITION__", F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))))
    return list_partitions(spark, table).select(plain.cast(spark.table(table).schema[col].dataType).alias(col)).distinct()


def recover_partitions(spark: SparkSession, table: str) -> None:
    spark.catalog.recoverPartitions(table)


def drop_partition(spark: SparkSession, table: str, spec: Mapping[str, object]) -> None:
    """``ALTER TABLE ... DROP IF EXISTS PARTITION (k = v, ...)``."""
    body = ", ".join(f"{quote(k)} = {_lit(v)}" for k, v in spec.items())
    spark.sql(f"ALTER TABLE {quote(table)} DROP IF EXISTS PARTITION ({body})")


def drop_partitions_where(spark: SparkSession, table: str, col: str, op: str, value) -> list[str]:
    """Drop every partition whose ``col`` satisfies ``col op value`` (op one of = != < <= >
    >=).  Works from partition metadata; returns the dropped values."""
    if op not in ("=", "!=", "<", "<=", ">", ">="):
        raise ValueError(f"unsupported operator {op!r}")
    parts = list_partitions(spark, table).select(
        F.regexp_extract("partition", rf"(?:^|/){col}=([^/]*)", 1).alias("v"))
    cond = F.expr(f"v {op} {_lit(value)}")
    vals = [r["v"] for r in parts.where(cond).distinct().orderBy("v").collect()]
    for v in vals:
        drop_partition(spark, table, {col: v})
    return vals


def truncate_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {quote(table)}")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quote(table)}")


def drop_database(spark: SparkSession, name: str, cascade: bool = False) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {quote(name)}{' CASCADE' if cascade else ''}")


def run_sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """``spark.sql`` with DataFrames bound to ``{name}`` placeholders."""
    return spark.sql(text, **frames)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan as text (``explain`` output), for logs and plan assertions."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def schema_text(df: DataFrame) -> str:
    return df._jdf.schema().treeString()
