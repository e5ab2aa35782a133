"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A text's shingles are its ``n``-word sequences (a shorter text is one shingle, a text without words
has none).  Its sketch holds the ``k`` smallest of their distinct 64-bit hashes, in order.  Sketches
of parts merge into the sketch of the whole, and of any two come

* resemblance: of the k smallest hashes of both, the share that both have;
* containment: the resemblance, scaled by the sizes that the sketches tell;
* the number of distinct shingles: exact below k, else from how far up the k-th hash lies.

Two empty sketches are alike (1); an empty and another one are not (0).  Null texts count as empty;
every row gives one row, repeated rows repeated ones; an empty table gives none.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripflow.llm.common import bucket_number, bucket_of, shuffle_partitions, text_of, words

K, SHINGLE = 256, 5


def with_sketch(df: DataFrame, text: Column, out: str, k: int = K, n: int = SHINGLE) -> DataFrame:
    """``df`` with the sketch of ``text`` as a column of longs."""
    h = f"{out}_h"
    d = df.withColumn(h, F.transform(words(text), lambda w: F.xxhash64(w)))
    size, first = F.size(h), F.lit(0)
    at = F.sequence(first, F.greatest(size - n, first))
    grams = F.transform(at, lambda i: F.xxhash64(*[F.get(F.col(h), i + j) for j in range(n)]))
    grams = F.when(size == 0, F.array().cast("array<bigint>")).when(size < n, F.array(F.xxhash64(h))).otherwise(grams)
    return d.withColumn(out, smallest(F.array_distinct(grams), k)).drop(h)


def smallest(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(hashes), 1, k)


def merged(df: DataFrame, keys: Sequence[str], sketch: str, k: int = K) -> DataFrame:
    """One sketch per key from its parts' sketches.  Hashes are made distinct, and all but each task's
    smallest k of a key are left behind, before the shuffle; a group of any size gives k hashes a task."""
    keys = list(keys)
    d = df.select(*keys, F.explode_outer(sketch).alias("hash")).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("hash").asc_nulls_last()))
    d = d.withColumn("place", rank).filter(F.col("place") <= k)
    return d.groupBy(*keys).agg(F.sort_array(F.collect_list("hash")).alias(sketch))


def _union(a: Column, b: Column, k: int) -> Column:
    return smallest(F.array_union(a, b), k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of common shingles among those of either."""
    both = _union(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(a, b), both))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(common / F.size(both))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """The estimated number of distinct shingles."""
    top = (F.element_at(a, k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / F.when(top > 0, top).otherwise(2.0**-64))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of a's shingles that b has too."""
    share = resemblance(a, b, k) * distinct_shingles(_union(a, b, k), k) / F.greatest(distinct_shingles(a, k), F.lit(1.0))
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(share, F.lit(1.0)))


def as_text(a: Column) -> Column:
    """A sketch as text: 16 hex digits a hash; the empty sketch is the empty text."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def text_cuts(d: DataFrame, hot: dict[int | None, int], chars: int = 200) -> dict[int | None, list[str]]:
    """For each id of ``hot`` up to so many texts that cut its rows into about equal parts.  They come from a
    random sample, four texts' beginnings for each cut asked for: bounded by a setting, not by the data."""
    if not hot:
        return {}
    ids = [i for i in hot if i is not None]
    wanted = F.col("id").isin(ids) | F.col("id").isNull() if None in hot else F.col("id").isin(ids)
    sample = d.filter(wanted).select("id", F.substring("text", 1, chars).alias("text")).orderBy(F.rand(7)).limit(4 * sum(hot.values()))
    texts: dict[int | None, list[str]] = {i: [] for i in hot}
    for r in sample.collect():
        texts[r.id].append(r.text)
    out = {}
    for i, k in hot.items():
        t = sorted(texts[i], key=str.encode)
        cut = sorted({t[j * len(t) // (k + 1)] for j in range(1, k + 1)} if t else (), key=str.encode)
        if cut:
            out[i] = cut
    return out


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Window]:
    """Rows (id, text, guard, bucket) whose next row by descending id is their next row in the
    window that is returned, in every bucket.

    Buckets are id ranges, cut at sampled quantiles; an id of many rows (or none, of many rows) is cut
    by its texts as well, at the quantiles of a sample of their beginnings.  Each bucket ends with a guard
    row, a copy of the row that follows its last (of the first row of all, for the last bucket), so ``lead``
    needs one shuffle of the texts and no task sees more than its buckets.  Equal ids follow by text, rows equal
    in both lie together; null ids come last, null texts are empty.
    """
    spark = df.sparkSession
    d = df.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    n = 4 * shuffle_partitions(spark)
    cuts, nulls, total = d.select(F.percentile_approx("id", [i / n for i in range(1, n)], 10 * n), F.count_if(F.col("id").isNull()), F.count(F.lit(1))).first()
    bounds = sorted(set(cuts or []))
    # An id that several quantiles name is the last of its bucket; rows without an id have a bucket of their own.
    hot = {i: k for i, k in Counter(cuts or []).items() if k > 1}
    if nulls * n > 2 * total:
        hot[None] = nulls * n // total
    inner = text_cuts(d, hot)
    base = F.when(F.col("id").isNull(), -1).otherwise(bucket_of(F.col("id"), bounds)).cast("int")
    most = 1 + max(map(len, inner.values()), default=0)
    part = F.lit(0)
    for i, texts in inner.items():
        below = F.size(F.filter(F.array(*map(F.lit, texts)), lambda c: c < F.col("text")))
        same = F.col("id").isNull() if i is None else F.col("base") == bucket_number(i, bounds)
        part = F.when(same, F.when(F.col("id").eqNullSafe(F.lit(i).cast("long")), below).otherwise(len(texts))).otherwise(part)
    d = d.withColumn("base", base).select("id", "text", (F.col("base") * most - part).cast("int").alias("bucket"))
    # One row per bucket: bounded by a setting, not by the data.
    tops = [(r.bucket, r.top) for r in d.groupBy("bucket").agg(F.max("id").alias("top")).collect()]
    tops.sort(reverse=True)
    heads = [(*tops[(i + 1) % len(tops)], b) for i, (b, _) in enumerate(tops)]
    assert all(bucket_number(t, bounds) == -(-b // most) for b, t in tops)
    heads = spark.createDataFrame(heads, "head int, top long, before int")
    guard = d.join(F.broadcast(heads), (F.col("bucket") == F.col("head")) & F.col("id").eqNullSafe(F.col("top")))
    guard = guard.groupBy(F.col("before").alias("bucket")).agg(F.min("text").alias("text"))
    rows = d.select("id", "text", F.lit(False).alias("guard"), "bucket")
    rows = rows.unionByName(guard.select(F.lit(None).cast("long").alias("id"), "text", F.lit(True).alias("guard"), "bucket"))
    return rows, Window.partitionBy("bucket").orderBy("guard", F.col("id").desc_nulls_last(), "text")
