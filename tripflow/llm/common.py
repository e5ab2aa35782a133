"""Small helpers that the operators of this subpackage share.

Intermediate tables go to the shared folder that ``spark.checkpoint.dir`` names, as Parquet, so
a lost executor costs a reread and no lineage.  Whole input rows travel as one struct column
(``ROW``), so a caller's extra columns cannot clash with the operators' own.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from tripflow.sources.sinks import scratch_path

#: The words of a text: runs of anything but space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
ROW = "row"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column = "text") -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, whatever their names hold."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])


def packed(df: DataFrame, *more: Column) -> DataFrame:
    """``ROW`` holds the whole input row; ``more`` are the operator's own columns."""
    return df.select(whole_row(df).alias(ROW), *more)


def unpacked(df: DataFrame, columns: Sequence[str], **replaced: Column) -> DataFrame:
    """The input's columns again, some of them with new values."""
    return df.select(*[replaced.get(c, F.col(ROW)[c]).alias(c) for c in columns])


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to and reread from the shared folder, and where it is."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def forget(spark: SparkSession, *paths: str) -> None:
    """Remove intermediate tables that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


#: Texts that are Python strings at a time; the rest of a batch stays in Arrow's memory.
TEXTS = 128


def map_texts(df: DataFrame, keep: Sequence[str], make: Callable[[], Callable[[str], tuple[Any, ...]]], ddl: str, text: str = "text") -> DataFrame:
    """The ``keep`` columns, as they are, and what the function that ``make`` gives in a task says of
    every whole text, as the columns of ``ddl``."""
    new = T.StructType.fromDDL(ddl)
    schema = T.StructType([*(df.schema[k] for k in keep), *new.fields])
    kinds, names = [to_arrow_type(f.dataType) for f in new.fields], schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = make()
        for b in batches:
            for lo in range(0, b.num_rows, TEXTS):
                part = b.slice(lo, TEXTS)
                rows = [of(t) for t in part.column(text).to_pylist()]
                made = [pa.array([r[i] for r in rows], type=k) for i, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), *made], names)

    return df.select(*keep, text).mapInArrow(run, schema)


def map_runs(of: Callable[[pa.Table], Iterator[pa.RecordBatch]], keys: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: ``of`` applied to each run of rows that are equal in their first ``keys``
    columns (numbers, not null).  The rows come sorted by these; a task holds a run at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if rest is None else pa.concat_tables([rest, t])
            cols = [t.column(i).to_numpy() for i in range(keys)]
            at = 0
            for cut in (np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1).tolist():
                yield from of(t.slice(at, cut - at))
                at = cut
            rest = t.slice(at)
        if rest is not None and rest.num_rows:
            yield from of(rest)

    return run


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def global_rank(df: DataFrame, order: Sequence[str | Column], out: str, name: str) -> tuple[DataFrame, int]:
    """Rows with their 0-based place in the order of the ``order`` columns, and how many they are.

    A range shuffle sorts the rows over all tasks; a row's place is its place in its task plus the
    rows of earlier tasks (one number per task, joined back).  No task sees more than its range.
    """
    spark = df.sparkSession
    n = shuffle_partitions(spark)
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    kept, _ = stored(ranged.withColumn("rank_task", F.spark_partition_id())
                     .withColumn("rank_at", F.monotonically_increasing_id() - F.shiftleft(F.col("rank_task").cast("long"), 33)), name)
    # At most one row per shuffle partition: bounded by a setting, not by the data.
    per_task = sorted((r[0], r[1]) for r in kept.groupBy("rank_task").agg(F.count(F.lit(1))).collect())
    starts, total = [], 0
    for task, rows in per_task:
        starts.append((task, total))
        total += rows
    before = spark.createDataFrame(starts or [(0, 0)], T.StructType([T.StructField("rank_task", T.IntegerType()), T.StructField("rank_start", T.LongType())]))
    ranked = kept.join(F.broadcast(before), "rank_task")
    return ranked.select(*df.columns, (F.col("rank_start") + F.col("rank_at")).alias(out)), total


def running_sums(df: DataFrame, order: Sequence[str | Column], name: str, **sums: str) -> DataFrame:
    """Rows with, for each of ``sums`` (out=column), the column's sum over the rows before them in the
    order of the ``order`` columns.  As in ``global_rank``, no task sees more than its range: sums
    inside the ranges, and one sum per range joined back."""
    spark = df.sparkSession
    ranged = df.repartitionByRange(shuffle_partitions(spark), *order).withColumn("sum_task", F.spark_partition_id())
    kept, _ = stored(ranged, name)
    inside = Window.partitionBy("sum_task").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    names = list(sums)
    # At most one row per shuffle partition: bounded by a setting, not by the data.
    per_task = sorted(tuple(r) for r in kept.groupBy("sum_task").agg(*[F.sum(sums[k]).alias(k) for k in names]).collect())
    starts, total = [], [0] * len(names)
    for task, *part in per_task:
        starts.append((task, *total))
        total = [t + p for t, p in zip(total, part)]
    kinds = [kept.select(F.sum(sums[k])).schema[0].dataType for k in names]
    schema = T.StructType([T.StructField("sum_at", T.IntegerType()), *(T.StructField(f"{k}_start", kind) for k, kind in zip(names, kinds))])
    rows = [(task, *(float(v) if isinstance(kind, T.DoubleType) else v for v, kind in zip(part, kinds))) for task, *part in starts]
    before = spark.createDataFrame(rows, schema)
    d = kept.select("*", *[F.sum(sums[k]).over(inside).alias(f"{k}_inside") for k in names])
    d = d.join(F.broadcast(before), F.col("sum_task") == F.col("sum_at"))
    return d.select(*df.columns, *[(F.col(f"{k}_start") + F.coalesce(F.col(f"{k}_inside"), F.lit(0))).alias(k) for k in names])


#: A key is hot if its rows are more than one in so many of all rows.
HOT_KEYS = 1000


def join_hot(rows: DataFrame, table: DataFrame, keys: Sequence[str], n: str) -> DataFrame:
    """``rows`` joined (inner) with ``table`` on ``keys``; ``table`` has one row per key, and in
    column ``n`` how many of ``rows`` have it.  Keys that hold more than one in ``HOT_KEYS`` of them
    are at most ``HOT_KEYS`` rows, whatever the data: those are broadcast, so the rows of a hot key stay
    where they are.  All other rows meet in a shuffle.  Both inputs should be stored: they are read twice."""
    total = table.agg(F.sum(n)).first()[0] or 0
    hot = F.col(n) > max(64, total // HOT_KEYS)
    top = F.broadcast(table.filter(hot))
    return rows.join(top, list(keys)).unionByName(
        rows.join(F.broadcast(table.filter(hot).select(*keys)), list(keys), "left_anti").join(table.filter(~hot), list(keys)))


def bucket_of(col: Column, bounds: Sequence[int]) -> Column:
    """How many of the sorted ``bounds`` lie below ``col`` (two short searches instead of one long)."""
    if not bounds:
        return F.lit(0)
    bounds = sorted(bounds)
    step = max(1, int(len(bounds) ** 0.5))
    chunks = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    chunks[-1] = chunks[-1] + [2**63 - 1] * (step - len(chunks[-1]))
    heads = F.array(*[F.lit(c[-1]).cast("long") for c in chunks])
    parts = F.array(*[F.array(*[F.lit(b).cast("long") for b in c]) for c in chunks])
    coarse = F.size(F.filter(heads, lambda b: b < col))
    fine = F.size(F.filter(F.get(parts, coarse), lambda b: b < col))
    return F.when(coarse >= len(chunks), F.lit(len(bounds))).otherwise(coarse * step + fine)


def bucket_number(value: int | None, bounds: Sequence[int]) -> int:
    """``bucket_of`` for one value on the driver."""
    return -1 if value is None else bisect.bisect_left(sorted(bounds), value)


def _grid(n: Column) -> tuple[Column, Column]:
    a = F.greatest(F.lit(1).cast("long"), F.ceil(F.sqrt(n)).cast("long"))
    return a, F.greatest(F.lit(1).cast("long"), F.floor((n + a - F.lit(1)) / a).cast("long"))


def _walk(x: Column, n: Column, key: tuple[Column, ...], rounds: Iterable[int], sign: int) -> Column:
    a, b = _grid(n)

    def left(r: int) -> Callable[[Column], Column]:
        return lambda t: F.struct(F.pmod(t["l"] + sign * F.pmod(F.xxhash64(t["r"], F.lit(r), *key), a), a).alias("l"), t["r"].alias("r"))

    def right(r: int) -> Callable[[Column], Column]:
        return lambda t: F.struct(t["l"].alias("l"), F.pmod(t["r"] + sign * F.pmod(F.xxhash64(t["l"], F.lit(r), *key), b), b).alias("r"))

    def once(v: Column) -> Column:
        s = F.array(F.struct(F.floor(v / b).cast("long").alias("l"), F.pmod(v, b).alias("r")))
        for r in rounds:
            s = F.transform(s, (right if r % 2 else left)(r))
        return F.transform(s, lambda t: t["l"] * b + t["r"])[0]

    def home(v: Column) -> Column:
        steps = F.sequence(F.lit(1).cast("long"), a)
        return F.when(v < n, v).otherwise(F.aggregate(steps, v, lambda acc, _: F.when(acc < n, acc).otherwise(once(acc))))

    return F.transform(F.array(once(x)), home)[0]


def permuted(x: Column, n: Column, *key: Column, rounds: int = 6) -> Column:
    """Feistel permutation of [0, n) with cycle walking, as one native expression.

    The domain is the grid ``a x b`` with a = ceil(sqrt(n)) and b = ceil(n / a), so fewer than ``a``
    values lie outside [0, n).  A value that lands outside walks on.  A walk meets each outside
    value at most once, so ``a`` steps always end it; the few walkers (about one in sqrt(n)) pay
    them, the others none.  ``key`` columns choose the permutation.  For n up to 2**50.
    """
    return _walk(x, n, key, range(rounds), 1)


def permuted_back(y: Column, n: Column, *key: Column, rounds: int = 6) -> Column:
    """The inverse of ``permuted``: which x the permutation sends to ``y``."""
    return _walk(y, n, key, range(rounds - 1, -1, -1), -1)
