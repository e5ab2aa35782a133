"""Versioned tables of files: a load is written beside what readers see, checked, and shown by one metadata step.

``{path}/load=<id>/<partition>/`` holds what one load wrote and never changes.  ``{path}/_versions/<n>.json``
names, for every partition of version n, the load that has it: one entry a partition, whatever the rows.  A
version is written under a hidden name and renamed, which fails if the number is taken, so a reader sees
a version whole or not at all, and of two loads at once the later one starts from the other's version.  A load
that fails, or whose counts are wrong, leaves no version and no files.  ``publish`` shows a version by name.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tripflow.plans.catalog import quote
from tripflow.sources.sinks import remove_path

VERSIONS = "_versions"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class LoadMismatch(ValueError):
    """A load wrote other row counts than it was to write."""


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def _children(spark: SparkSession, path: str) -> list:
    """File statuses in a folder, without hidden names; none if the folder is missing."""
    fs, p = _fs(spark, path)
    return [s for s in fs.listStatus(p) if s.getPath().getName()[0] not in "._"] if fs.exists(p) else []


def _leaf_folders(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """The partition folders of one load, relative to it."""
    found = [""]
    for _ in range(depth):
        found = [f"{f}/{s.getPath().getName()}".lstrip("/") for f in found for s in _children(spark, f"{folder}/{f}" if f else folder) if s.isDirectory()]
    return found


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the versions there are, ascending."""
    names = [s.getPath().getName() for s in _children(spark, f"{path.rstrip('/')}/{VERSIONS}")]
    return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json"))


def _version_file(path: str, n: int) -> str:
    return f"{path.rstrip('/')}/{VERSIONS}/{n:012d}.json"


def partitions_at(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, dict[str, str]]:
    """(version, partition folder -> load) of a version, by default the latest; (0, {}) where there is none."""
    if version is None:
        version = max(versions(spark, path), default=0)
    if version == 0:
        return 0, {}
    fs, p = _fs(spark, _version_file(path, version))
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return version, json.loads(text)["partitions"]


def _claim(spark: SparkSession, path: str, n: int, partitions: dict[str, str]) -> bool:
    """Write version n; False if another load was first."""
    fs, target = _fs(spark, _version_file(path, n))
    _, hidden = _fs(spark, f"{path.rstrip('/')}/{VERSIONS}/.{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    out.write(bytearray(json.dumps({"version": n, "partitions": partitions}, sort_keys=True).encode()))
    out.close()
    sc = spark.sparkContext
    none = sc._gateway.new_array(sc._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), sc._jsc.hadoopConfiguration())
    try:
        context.rename(hidden, target, none)
    except Py4JJavaError as e:
        fs.delete(hidden, False)
        if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()):
            return False
        raise
    return True


def _check(written: DataFrame, expected: DataFrame, by: Sequence[str]) -> None:
    """Every partition has the expected rows; only a partition that differs, if any, comes to the driver."""
    def key(c: str, df: DataFrame):  # An empty string is no partition value: it is stored as NULL.
        return (F.nullif(F.col(c), F.lit("")) if isinstance(df.schema[c].dataType, StringType) else F.col(c)).alias(c)

    want = expected.groupBy(*[key(c, expected) for c in by]).agg(F.sum("rows").alias("want"), F.lit(0).cast("long").alias("got"))
    got = written.groupBy(*by).agg(F.lit(0).cast("long").alias("want"), F.count(F.lit(1)).alias("got"))
    both = want.unionByName(got).groupBy(*by).agg(F.sum("want").alias("want"), F.sum("got").alias("got"))
    wrong = both.where("want <> got").limit(1).collect()
    if wrong:
        raise LoadMismatch(f"a partition has other rows than it was to have: {wrong[0].asDict()}")


def commit_load(df: DataFrame, path: str, by: Sequence[str] = ("ptd", "period"), replace: bool = False,
                expected: DataFrame | None = None) -> int:
    """Write ``df`` as a load of its own and make it visible as the next version; returns its number.

    Its partitions replace those of the version before and the others stay, or go if ``replace``.
    ``expected`` has the rows that each partition is to get (``by`` and ``rows``): the stored files are counted
    (from their footers), and on a difference the load is taken back with ``LoadMismatch``."""
    spark, load = df.sparkSession, uuid.uuid4().hex
    folder = f"{path.rstrip('/')}/load={load}"
    try:
        # One shuffle gives a partition few files; adaptive execution cuts a large one over several tasks.
        df.hint("rebalance", *by).write.partitionBy(*by).parquet(folder)
        if expected is not None:
            _check(spark.read.schema(df.schema).parquet(folder), expected, by)
    except BaseException:
        remove_path(spark, folder)
        raise
    mine = {p: load for p in _leaf_folders(spark, folder, len(by))}
    while True:
        n, have = partitions_at(spark, path)
        if _claim(spark, path, n + 1, mine if replace else {**have, **mine}):
            return n + 1


def read_version(spark: SparkSession, path: str, schema: StructType, version: int | None = None) -> DataFrame:
    """One version's rows as one scan (partition filters prune); later loads don't change what it reads."""
    _, parts = partitions_at(spark, path, version)
    if not parts:
        return spark.createDataFrame([], schema)
    base = path.rstrip("/")
    folders = [f"{base}/load={load}/{part}" for part, load in sorted(parts.items())]
    return spark.read.schema(schema).option("basePath", base).parquet(*folders).select(*schema.names)


def publish(spark: SparkSession, path: str, table: str, schema: StructType, by: Sequence[str] = ("ptd", "period")) -> int:
    """Show the latest version as ``table``: a view over a table of that version's partitions.

    The table behind (``<table>__v<n>``, for partition lists) is complete before the view is replaced, which
    is one step; the one of the version before stays for queries that are under way, older ones go.
    The files belong to ``path`` and are never dropped with a name."""
    n, parts = partitions_at(spark, path)
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        raise ValueError(f"{table} is a table of its own; a versioned table needs a free name or a view's")
    behind = f"{table}__v{n}"
    _, root = _fs(spark, path)
    text = str(root.toString()).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {quote(behind)}")
    keys = ", ".join(quote(c) for c in by)
    spark.sql(f"CREATE TABLE {quote(behind)} ({schema.toDDL()}) USING parquet PARTITIONED BY ({keys}) LOCATION '{text}'")
    items = sorted(parts.items())
    for at in range(0, len(items), 500):
        specs = [f"PARTITION ({_spec(part)}) LOCATION '{text}/load={load}/{part}'" for part, load in items[at:at + 500]]
        spark.sql(f"ALTER TABLE {quote(behind)} ADD " + " ".join(specs))
    spark.sql(f"CREATE OR REPLACE VIEW {quote(table)} AS SELECT {', '.join(quote(c) for c in schema.names)} FROM {quote(behind)}")
    db, _, name = table.rpartition(".")
    for t in spark.catalog.listTables(db or None):
        number = t.name[len(name) + 3:]
        if t.name.startswith(f"{name}__v") and number.isdigit() and int(number) < n - 1:
            spark.sql(f"DROP TABLE IF EXISTS {quote(f'{db}.{t.name}' if db else t.name)}")
    return n


def _spec(part: str) -> str:
    out = []
    for piece in part.split("/"):
        k, _, v = piece.partition("=")
        value = "null" if v == NULL_PARTITION else "'" + unquote(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
        out.append(f"{quote(unquote(k))} = {value}")
    return ", ".join(out)


def expire(spark: SparkSession, path: str, keep: int = 2, grace_hours: float = 24.0) -> list[str]:
    """Remove all versions but the latest ``keep`` and every load that none of these names; returns those loads.
    A load's folder younger than ``grace_hours`` stays: its version may be yet to come."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    there = versions(spark, path)
    for n in there[:-keep]:
        remove_path(spark, _version_file(path, n))
    used = {load for n in there[-keep:] for load in partitions_at(spark, path, n)[1].values()}
    before, gone = (time.time() - 3600 * grace_hours) * 1000, []
    for s in _children(spark, path):
        name = s.getPath().getName()
        if name.startswith("load=") and name[5:] not in used and s.getModificationTime() <= before:
            remove_path(spark, s.getPath().toString())
            gone.append(name[5:])
    return gone
