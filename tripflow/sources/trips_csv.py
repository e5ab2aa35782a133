"""Period CSV files (``<prefix>YYYY-qN...csv``: a file, or a folder of part files) as one DataFrame.

One multi-file scan with an explicit schema; the period comes from each row's file path
(``_metadata.file_path``), so files are never listed or opened on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripflow.functions.timefn import parse_trip_time
from tripflow.schema import ENRICHED_TRIP_SCHEMA, RAW_TRIP_SCHEMA

TRIP_FILE_PREFIX = "metro-trips-"
PERIOD_REGEX = r"(\d{4}-q\d)"
CORRUPT_COL = "_corrupt_record"


def read_period_csv(spark: SparkSession, path: str, schema: StructType = RAW_TRIP_SCHEMA,
                    prefix: str = TRIP_FILE_PREFIX, period_regex: str = PERIOD_REGEX,
                    keep_corrupt: bool = True) -> DataFrame:
    """Read every CSV file under ``path`` whose name, or whose folder's name, begins with ``prefix``,
    with a header, ``,`` delimiter and PERMISSIVE parsing (short rows -> NULLs, unparseable values
    -> NULL with the raw line in ``_corrupt_record``).  Adds ``period`` (e.g. ``2021-q1``, NULL when
    the name has no period), ``ptd`` (the year) and ``source_file``.  A UTF-8 BOM is stripped by
    the reader."""
    fields = list(schema.fields)
    if keep_corrupt:
        fields.append(StructField(CORRUPT_COL, StringType(), True))
    reader = (spark.read.schema(StructType(fields)).option("header", True).option("sep", ",")
              .option("mode", "PERMISSIVE").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True))
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    return with_file_period(reader.csv(path), prefix, period_regex)


def with_file_period(df: DataFrame, prefix: str = TRIP_FILE_PREFIX, period_regex: str = PERIOD_REGEX) -> DataFrame:
    """``period``, ``ptd`` and ``source_file`` from the last part of each row's file path that carries
    the prefix: the file itself or the folder it is in.  Rows of other files are left out."""
    name = F.regexp_extract(F.col("_metadata.file_path"), rf"({prefix}[^/]*)(?:/[^/]*)?$", 1)
    period = F.nullif(F.regexp_extract(name, period_regex, 1), F.lit(""))
    df = df.withColumns({"period": period, "ptd": F.split(period, "-").getItem(0), "source_file": name})
    return df.where(F.col("source_file") != "")


def trips_with_period(df: DataFrame) -> DataFrame:
    """Only rows whose file name carries a period."""
    return df.where(F.col("period").isNotNull())


def unmatched_files(df: DataFrame) -> DataFrame:
    """File names with the prefix but no period (rejected and reported, not a crash)."""
    return df.where(F.col("period").isNull()).select("source_file").distinct()


def rejected_rows(df: DataFrame) -> DataFrame:
    """What a load leaves out or reads in part, by file: (source_file, reason, rows, sample).

    ``no period`` counts the rows of files without a period, ``bad row`` the lines that do not fit
    the schema (their readable columns are loaded), ``no start time`` the rows whose start cannot
    be read as a time, ``no coordinates`` the rows without a start or end point (not loaded)."""
    start = parse_trip_time("start_time")
    # A line is judged by the columns that are read, so all of them have to be.
    parsed = [f.name for f in RAW_TRIP_SCHEMA.fields if f.name in df.columns]
    whole = F.length(F.concat_ws("", *parsed)) >= 0
    missing = F.col("start_lat").isNull() | F.col("start_lon").isNull() | F.col("end_lat").isNull() | F.col("end_lon").isNull()
    # Tests come as columns of their own: inside the generator they would be interpreted.
    tested = df.select(
        "source_file", F.coalesce(CORRUPT_COL, F.col("trip_id").cast("string")).alias("sample"), F.col("period").isNull().alias("no_period"),
        (F.col(CORRUPT_COL).isNotNull() & whole).alias("bad_row"), start.isNull().alias("no_start"), missing.alias("no_coordinates"))
    reasons = F.array_compact(F.array(
        F.when(F.col("no_period"), F.lit("no period")), F.when(F.col("bad_row"), F.lit("bad row")),
        F.when(F.col("no_start"), F.lit("no start time")), F.when(F.col("no_coordinates"), F.lit("no coordinates"))))
    bad = tested.select("source_file", F.explode(reasons).alias("reason"), "sample")
    return bad.groupBy("source_file", "reason").agg(F.count(F.lit(1)).alias("rows"), F.min("sample").alias("sample"))


def read_csv_rows(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Plain CSV read, all columns as strings (header row used for names)."""
    return spark.read.option("header", header).csv(path)


def empty_enriched(spark: SparkSession) -> DataFrame:
    """Typed empty enriched-trip frame (the result when no input files exist)."""
    return spark.createDataFrame([], ENRICHED_TRIP_SCHEMA)
