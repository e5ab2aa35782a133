"""Writers: partitioned table loads, CSV / JSON exports, period-named CSV files."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.session import ensure_checkpoint_dir


def write_partitioned(df: DataFrame, path: str, by: Sequence[str] | str = ("ptd", "period"), fmt: str = "parquet",
                      mode: str = "overwrite") -> None:
    """Write ``df`` partitioned by ``by``.  Overwrite is *dynamic*: only partitions present in
    ``df`` are replaced.  With year and period as partitions, a period loaded again replaces
    itself, and other periods of its year stay."""
    cols = [by] if isinstance(by, str) else list(by)
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*cols).format(fmt).save(path))


def write_table(df: DataFrame, table: str, by: Sequence[str] | str = ("ptd", "period")) -> None:
    """Create the partitioned table on first use, else dynamic-overwrite its partitions (columns
    matched by name, not position).  The session's settings stay as they are."""
    spark = df.sparkSession
    cols = [by] if isinstance(by, str) else list(by)
    if not spark.catalog.tableExists(table):
        df.write.partitionBy(*cols).format("parquet").saveAsTable(table)
        return
    # Dynamic overwrite is an option of file writers alone: write the table's files, then tell the catalog.
    where = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
    write_partitioned(df.select(*spark.table(table).columns), where, cols)
    spark.sql(f"MSCK REPAIR TABLE {table}")
    spark.catalog.refreshTable(table)


def export_csv(df: DataFrame, path: str, files: int | None = None, max_rows: int = 200_000,
               sort: Sequence[str] | None = None, mode: str = "overwrite") -> None:
    """CSV with header.  ``sort`` gives range-partitioned, sorted output (file order = sort
    order, the sort happens after any repartition); ``files`` fixes the file count;
    ``max_rows`` caps rows per file.  Errors propagate."""
    out = df
    if sort and files:
        out = out.repartitionByRange(files, *sort).sortWithinPartitions(*sort)
    elif sort:
        out = out.orderBy(*sort)
    elif files:
        out = out.repartition(files)
    (out.write.mode(mode).option("header", True).option("encoding", "UTF-8")
     .option("maxRecordsPerFile", max_rows).csv(path))


def append_csv(df: DataFrame, path: str) -> None:
    """Append rows as more CSV files (each file carries its own header)."""
    df.write.mode("append").option("header", True).csv(path)


def export_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines; timestamps ``yyyy-MM-dd HH:mm:ss``, dates ``yyyy-MM-dd``, text kept as is."""
    (df.write.mode(mode).option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").option("dateFormat", "yyyy-MM-dd")
     .option("ignoreNullFields", False).json(path))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tripflow-{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder once nothing reads it any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_period_csv(df: DataFrame, path: str, period_col: str = "period", prefix: str = "metro-trips-") -> None:
    """CSV files by period: ``{path}/{prefix}{period}.csv/part-*.csv``, one folder per period.

    Every task writes its own files for the periods it holds, so a period with a third of all
    rows is still written by many tasks, and nothing is renamed afterwards; ``read_period_csv``
    takes the period from the folder's name."""
    folder = F.concat(F.lit(prefix), F.col(period_col), F.lit(".csv"))
    cols = [c for c in df.columns if c != period_col]
    (df.select(*cols, folder.alias("file")).write.mode("overwrite").option("header", True).partitionBy("file").csv(path))
