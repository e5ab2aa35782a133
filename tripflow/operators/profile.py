"""Table profiling: descriptive statistics, exact quartiles, null and category audits,
correlation / covariance matrices, means with confidence intervals, JSON conformance.

Every statistic over many columns is computed in one aggregation pass (one partial +
final aggregate), then reshaped to long form.  Exact quantiles use a range-partitioned
distributed sort, in which a hot group spans many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tripflow.plans.sizing import materialize

BASIC_STATS = ["count", "mean", "stddev", "min", "max"]


def _stack(wide: DataFrame, keys: Sequence[str], cols: Sequence[str], stats: Sequence[str],
           name_col: str = "column") -> DataFrame:
    """Wide ``{col}__{stat}`` aggregates -> one row per (keys, column)."""
    structs = []
    for c in cols:
        fields = [F.lit(c).alias(name_col)]
        for s in stats:
            v = F.col(f"`{c}__{s}`")
            fields.append((v.cast("long") if s == "count" else v.cast("double")).alias(s))
        structs.append(F.struct(*fields))
    return wide.select(*keys, F.explode(F.array(*structs)).alias("__s")).select(*keys, "__s.*")


def describe_by(df: DataFrame, cols: Sequence[str], by: Sequence[str] | str | None = None) -> DataFrame:
    """count / mean / sample stddev / min / max of each column, per group, in one pass.

    Long output: (by..., column, count, mean, stddev, min, max); ``count`` counts non-NULLs.
    """
    keys = [by] if isinstance(by, str) else list(by or [])
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    return _stack(wide, keys, cols, BASIC_STATS)


def _sorted_values(df: DataFrame, cols: Sequence[str], keys: Sequence[str], partitions: int | None) -> DataFrame:
    """Distinct values per (keys..., column) with their counts, range-partitioned and sorted over
    the tasks and stored: (keys..., column, v, c, pid).

    Values are collapsed before the shuffle (partial aggregation), so a value repeated in a
    third of all rows is one row; distinct values range-split evenly, so a hot group spans many
    tasks.  Storing cuts the lineage, so all later reads agree on which task holds what.
    """
    long = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("__x"))
    long = long.select(*keys, "__x.column", "__x.v").where(F.col("v").isNotNull() & ~F.isnan("v"))
    gkeys = list(keys) + ["column"]
    counts = long.groupBy(*gkeys, "v").agg(F.count(F.lit(1)).alias("c"))
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (counts.repartitionByRange(n_parts, *gkeys, "v").sortWithinPartitions(*gkeys, "v")
               .withColumn("pid", F.spark_partition_id()))
    return materialize(ordered, "sorted")


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; the keys come from the left."""
    right = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = None
    for k in keys:
        e = left[k].eqNullSafe(right[f"__r_{k}"])
        cond = e if cond is None else cond & e
    return left.join(right, cond, how).drop(*[f"__r_{k}" for k in keys])


def _quantiles(ordered: DataFrame, gkeys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Quantiles from ``_sorted_values``: the block table (one row per task and group) tells which
    block holds each target rank; only those blocks are read again and counted through."""
    gkeys = list(gkeys)
    blocks = ordered.groupBy(*gkeys, "pid").agg(F.sum("c").alias("cnt"))
    before = Window.partitionBy(*gkeys).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("offset", F.coalesce(F.sum("cnt").over(before), F.lit(0)))
    blocks = materialize(blocks, "blocks")
    targets = blocks.groupBy(*gkeys).agg(F.sum("cnt").alias("n"))
    targets = targets.select(*gkeys, F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("q"), "n")
    targets = targets.withColumn("pos", F.col("q") * (F.col("n") - 1))
    targets = targets.withColumn("lo", F.floor("pos").cast("long")).withColumn("hi", F.ceil("pos").cast("long"))
    ranks = targets.select(*gkeys, F.explode(F.array_distinct(F.array("lo", "hi"))).alias("rank")).distinct()
    found = _same(blocks, ranks, gkeys).where((F.col("rank") >= F.col("offset")) & (F.col("rank") < F.col("offset") + F.col("cnt")))
    # At most two ranks per group and probability: a small table, keyed by the task as well, so the
    # values are never shuffled by their group alone.
    found = found.groupBy(*gkeys, "pid", "offset").agg(F.collect_set("rank").alias("ranks"))
    hit = _same(ordered, found, [*gkeys, "pid"])
    inner = Window.partitionBy(*gkeys, "pid").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    hit = hit.withColumn("first", F.col("offset") + F.coalesce(F.sum("c").over(inner), F.lit(0)))
    hit = hit.select(*gkeys, "v", "first", "c", F.explode("ranks").alias("rank")).where(
        (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("c"))).select(*gkeys, "rank", "v")
    out = _same(targets, hit.withColumnsRenamed({"rank": "lo", "v": "v_lo"}), [*gkeys, "lo"])
    out = _same(out, hit.withColumnsRenamed({"rank": "hi", "v": "v_hi"}), [*gkeys, "hi"])
    value = F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * (F.col("pos") - F.col("lo"))
    return out.select(*gkeys, "q", value.alias("value"))


def exact_quantiles(df: DataFrame, cols: Sequence[str], by: Sequence[str] | str | None = None,
                    probs: Sequence[float] = (0.25, 0.5, 0.75), partitions: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation between order statistics (the common
    ``describe`` definition: position p * (n - 1)).

    Values of every (group, column) are first collapsed to (value, count) - a hot value is
    one row - then range-partitioned and sorted across the cluster.  Per-task block counts tell
    which block holds a target rank, and only those blocks are counted through.  A hot group
    spreads over many tasks instead of landing in one.

    Output: (by..., column, q, value) with q in ``probs``; a (group, column) without values has
    no row.
    """
    keys = [by] if isinstance(by, str) else list(by or [])
    return _quantiles(_sorted_values(df, cols, keys, partitions), keys + ["column"], probs)


def describe_quartiles(df: DataFrame, cols: Sequence[str], by: Sequence[str] | str | None = None,
                       partitions: int | None = None) -> DataFrame:
    """The 8 ``describe`` statistics: count, mean, std, min, 25%, 50%, 75%, max.

    Count, mean, sd, min and max come from one aggregation (``describe_by``), the quartiles from
    ``exact_quantiles``.  NULL and NaN values are skipped, as in a pandas ``describe``; a (group,
    column) without values keeps its row, with count 0."""
    keys = [by] if isinstance(by, str) else list(by or [])
    gkeys = keys + ["column"]
    numbers = df.select(*keys, *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    basic = describe_by(numbers, cols, keys)
    q = exact_quantiles(df, cols, keys, (0.25, 0.5, 0.75), partitions)
    wide_q = q.groupBy(*gkeys).agg(
        F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("p25"),
        F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("p50"),
        F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("p75"))
    out = _same(basic, wide_q, gkeys, "left")
    return out.select(*keys, "column", "count", "mean", "stddev", "min", "p25", "p50", "p75", "max")


def null_audit(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls, rows) for every column, one pass.  NaN counts as missing for floats."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in cols:
        miss = F.col(c).isNull()
        if types.get(c) in ("double", "float"):
            miss = miss | F.isnan(c)
        aggs.append(F.count_if(miss).alias(c))
    wide = df.agg(*aggs)
    return wide.unpivot(["__rows"], cols, "column", "nulls").select(
        "column", F.col("nulls").cast("long").alias("nulls"), F.col("__rows").alias("rows"))


def category_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, count) for several categorical columns in one shuffle: rows are
    unpivoted to (column, value) and counted with map-side partial aggregation."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("__x"))
    return long.groupBy("__x.column", "__x.value").agg(F.count(F.lit(1)).alias("count"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts per value, descending, ties by value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc(col))


#: Buffers that one task merges; where more tasks may send one, they are merged in a tree.
FAN = 64


class _Moments:
    """Co-moments of every pair of columns over the rows that have both: count ``n``, the mean of each
    column ``m`` (row i, column j: of i where j is there too), the sums of squares ``q`` and of products
    ``c`` of deviations from these.  A buffer of arrays, updated by blocks of rows and mergeable."""

    def __init__(self, n: np.ndarray, m: np.ndarray, q: np.ndarray, c: np.ndarray) -> None:
        self.n, self.m, self.q, self.c = n, m, q, c

    @classmethod
    def of(cls, values: np.ndarray, there: np.ndarray) -> _Moments:
        mask = there.astype(np.float64)
        n = mask.T @ mask
        # About the columns' own means first: what is left to subtract is small.
        own = np.where(there, values, 0.0).sum(axis=0) / np.maximum(mask.sum(axis=0), 1)
        x = np.where(there, values - own, 0.0)
        lost = ~np.isfinite(x)
        bad = lost.astype(np.float64).T @ mask > 0
        x = np.where(lost, 0.0, x)
        m = (x.T @ mask) / np.maximum(n, 1)
        q = (x * x).T @ mask - n * m * m
        c = x.T @ x - n * m * m.T
        q[bad], c[bad | bad.T] = np.nan, np.nan
        return cls(n, m + own[:, None], q, c)

    def add(self, o: _Moments) -> _Moments:
        n = self.n + o.n
        step, part = o.m - self.m, o.n / np.maximum(n, 1)
        both = self.n * part
        return _Moments(n, self.m + step * part, self.q + o.q + step * step * both, self.c + o.c + step * step.T * both)

    @classmethod
    def read(cls, row: bytes, k: int) -> _Moments:
        return cls(*np.frombuffer(row, dtype=np.float64).reshape(4, k, k))

    def written(self) -> bytes:
        return np.stack([self.n, self.m, self.q, self.c]).tobytes()


def _merged(parts: Iterator[_Moments]) -> Iterator[pa.RecordBatch]:
    total = None
    for m in parts:
        total = m if total is None else total.add(m)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.written()], pa.binary())], ["m"])


def co_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row (m) with the ``_Moments`` of the columns, or none for no rows: a task sends one buffer."""
    k = len(cols)

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[_Moments]:
            for b in batches:
                if b.num_rows:
                    there = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in b.columns], axis=1)
                    yield _Moments.of(np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in b.columns], axis=1), there)

        return _merged(parts())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _merged(_Moments.read(row, k) for b in batches for row in b.column(0).to_pylist())

    spark = df.sparkSession
    made = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).mapInArrow(update, "m binary")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    if tasks > FAN:
        made = made.repartition(math.isqrt(tasks)).mapInArrow(merge, "m binary")
    return made.repartition(1).mapInArrow(merge, "m binary")


def corr_long(df: DataFrame, cols: Sequence[str], lower: bool = False, method: str = "corr") -> DataFrame:
    """Pearson correlation (pairwise-complete rows) of every column pair i < j; long output
    (col_a, col_b, value).  One mergeable buffer of arrays for all pairs: rows are read once, each task
    sends one row of partial moments, and the last one is turned to long form.  NULL where fewer than
    two rows have both columns or one of them does not vary.  ``lower=True`` adds the mirrored half."""
    if method not in ("corr", "covar_samp", "covar_pop"):
        raise ValueError("method must be 'corr', 'covar_samp' or 'covar_pop'")
    names, k = list(cols), len(cols)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for b in batches for row in b.column(0).to_pylist()]
        m = _Moments.read(rows[0], k) if rows else _Moments.of(np.zeros((1, k)), np.zeros((1, k), dtype=bool))
        if method == "corr":
            under, few = np.sqrt(m.q * m.q.T), m.n < 2
        else:
            less = 1 if method == "covar_samp" else 0
            under, few = np.maximum(m.n - less, 1), m.n <= less
        none = few | (under == 0)
        value = np.where(none, 0.0, m.c / np.where(none, 1.0, under))
        a, b = np.triu_indices(k, 1)
        if lower:
            a, b = np.concatenate([a, b]), np.concatenate([b, a])
        yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in a], pa.string()), pa.array([names[i] for i in b], pa.string()),
                                          pa.array(value[a, b], pa.float64(), mask=none[a, b])], ["col_a", "col_b", "value"])

    return co_moments(df, cols).coalesce(1).mapInArrow(out, "col_a string, col_b string, value double")


def cov_long(df: DataFrame, cols: Sequence[str], lower: bool = False) -> DataFrame:
    """Sample covariance of every column pair, same shape as ``corr_long``."""
    return corr_long(df, cols, lower, method="covar_samp")


def mean_ci(df: DataFrame, value: str, by: Sequence[str] | str, z: float = 1.959963984540054) -> DataFrame:
    """Mean of ``value`` per category with a normal-approximation CI, for one or several
    category columns in one pass.  Output: (category, level, n, mean, stddev, ci_low, ci_high)."""
    cats = [by] if isinstance(by, str) else list(by)
    long = df.select(F.col(value).cast("double").alias("__v"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("category"), F.col(c).cast("string").alias("level")) for c in cats])).alias("__c"))
    g = long.groupBy("__c.category", "__c.level").agg(
        F.count("__v").alias("n"), F.avg("__v").alias("mean"), F.stddev_samp("__v").alias("stddev"))
    half = F.lit(z) * F.col("stddev") / F.sqrt(F.col("n").cast("double"))
    return g.withColumns({"ci_low": F.col("mean") - half, "ci_high": F.col("mean") + half})


#: Rows that are equal are numbered in blocks of this many.
BLOCK = 4096
#: The normal quantile by rational functions (Acklam), centre and tails.
NORMAL_A = (-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.357751867269, -30.66479806614716, 2.506628277459239)
NORMAL_B = (-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572, 1.0)
NORMAL_C = (-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783)
NORMAL_D = (0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0)
NORMAL_TAIL = 0.02425


def poisson_cuts(c: int) -> list[int]:
    """The Poisson(c) distribution function as thresholds of a 32-bit draw, as far as these tell apart."""
    out, p, total, k = [], math.exp(-c), 0.0, 0
    while not out or out[-1] < 2**32 - 1:
        total += p
        out.append(min(int(2**32 * total), 2**32 - 1))
        k += 1
        p *= c / k
        if k > 4 * c + 40:
            break
    return out


def horner(x: Column, coefficients: Sequence[float]) -> Column:
    out = F.lit(coefficients[0])
    for v in coefficients[1:]:
        out = out * x + F.lit(v)
    return out


def normal_quantile(u: Column) -> Column:
    """The standard normal quantile of 0 < u < 1, to 1e-8."""
    q = u - 0.5
    r = q * q
    tail = F.sqrt(-2 * F.ln(F.least(u, 1 - u)))
    outer = horner(tail, NORMAL_C) / horner(tail, NORMAL_D)
    return (F.when(F.least(u, 1 - u) >= NORMAL_TAIL, q * horner(r, NORMAL_A) / horner(r, NORMAL_B))
            .when(q < 0, outer).otherwise(-outer))


def mean_ci_bootstrap(df: DataFrame, value: str, by: str, replicates: int = 200, alpha: float = 0.05, seed: int = 7,
                      key: Sequence[str] | str = ()) -> DataFrame:
    """Poisson-bootstrap percentile CI of the mean per category.

    Every row gets a Poisson(1) weight of its own in every replicate, by inversion of the first 32 bits of an
    md5 over (row's name, seed, replicate): all rows are resampled.  ``key`` names the rows; without it they are
    named by level and value.  Rows that agree in name, level and value are numbered, so each has its own draws
    and the result depends on the rows alone, not on their partitions.  NULL values have no weight; a value of
    -0.0 is 0.0.  Output: (level, mean, ci_low, ci_high)."""
    keys = [key] if isinstance(key, str) else list(key)
    names = [f"k{i}" for i in range(len(keys))]
    base = df.select(F.col(by).cast("string").alias("l"), (F.col(value).cast("double") + F.lit(0.0)).alias("v"),
                     *[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(n) for k, n in zip(keys, names)])
    # Without a key by millionths, so that no engine's way to print a double matters.
    own = names or [F.coalesce(F.col("l"), F.lit("")), F.round(F.col("v") * 1e6).cast("long").cast("string")]
    alike = base.where("v IS NOT NULL").groupBy("l", "v", *names).agg(F.count(F.lit(1)).alias("c"))
    blocks = alike.select("l", "v", "c", F.nullif(F.concat_ws("|", *own), F.lit("")).alias("name"), F.explode(F.sequence(F.lit(0), F.floor((F.col("c") - 1) / BLOCK))).alias("b"))
    # Every row counts `replicates` times from here on: they are dealt out to all tasks first.
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism)
    blocks = blocks.repartition(tasks, "name", "b")
    first = F.col("b") * BLOCK + 1
    rows = blocks.select("l", "v", "name", F.explode(F.sequence(first, F.least("c", first + (BLOCK - 1)))).alias("i"))
    named = rows.select("l", "v", F.concat_ws("|", "name", F.when(F.col("i") > 1, F.col("i").cast("string")), F.lit(str(seed))).alias("name"),
                        F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("rep"))
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", "name", F.col("rep").cast("string")).cast("binary")), 1, 8), 16, 10).cast("long")
    drawn = named.select("l", "v", "rep", draw.alias("draw"))
    weight = F.lit(0)
    for cut in poisson_cuts(1):
        weight = weight + (F.col("draw") >= cut).cast("int")
    per_rep = drawn.withColumn("w", weight.cast("double")).groupBy("l", "rep").agg(
        (F.sum(F.col("v") * F.col("w")) / F.nullif(F.sum("w"), F.lit(0.0))).alias("m"))
    ci = per_rep.groupBy("l").agg(F.percentile("m", alpha / 2).alias("ci_low"), F.percentile("m", 1 - alpha / 2).alias("ci_high"))
    mean = base.groupBy(F.col("l").alias("level")).agg(F.avg("v").alias("mean"))
    return _same(mean, ci.withColumnRenamed("l", "level"), ["level"], "left")


def preview(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """First ``n`` rows in an explicit order (a deterministic ``head``; the limit is the
    feature: a top-n sort keeps n rows per task, never the whole input)."""
    return df.orderBy(*order_by).limit(n)


def shape(df: DataFrame) -> tuple[int, int]:
    """(rows, columns) with one job."""
    return df.count(), len(df.columns)


def observe_counts(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row-count observation: the count arrives with the next action on the
    returned frame, without a separate job."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def json_conformance(df: DataFrame, col: str, ddl: str, required: Sequence[str] = ()) -> DataFrame:
    """Validate a JSON text column against a schema in one pass.

    A valid document is a JSON object whose fields have the schema's types and whose ``required``
    fields are there and not NULL.  Output one row: rows, nulls (no document), invalid (not JSON, no
    object, or a field of another type), missing_required, valid.
    """
    bad = "__corrupt"
    schema = T.StructType([*T.StructType.fromDDL(ddl).fields, T.StructField(bad, T.StringType())])
    parsed = F.from_json(F.col(col), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    d = df.select(F.col(col).alias("doc"), parsed.alias("p"))
    doc = F.col("doc").isNotNull()
    # One value and nothing after it: it also has to be the one element of an array and of an object.
    alone = [F.try_parse_json(F.concat(F.lit(a), F.col("doc"), F.lit(b))).isNotNull() for a, b in (("[", "]"), ('{"a":', "}"))]
    is_object = alone[0] & alone[1] & F.ltrim("doc").startswith("{")
    good = is_object & F.col("p").isNotNull() & F.col(f"p.{bad}").isNull()
    has_all = F.lit(True)
    for r in required:
        has_all = has_all & F.col("p")[r].isNotNull()
    return d.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~doc).alias("nulls"),
        F.count_if(doc & ~good).alias("invalid"),
        F.count_if(doc & good & ~has_all).alias("missing_required"),
        F.count_if(doc & good & has_all).alias("valid"))
