"""SimHash near-dedup with deletion-variant signatures.

**Fingerprint.** A text's A-Z are lower-cased, its words form ``shingle``-word shingles, repeats
included, joined by spaces (a shorter text is one shingle; a text without words has fingerprint 0).
A bit is 1 if it is set in over half of the shingles' XXH64 (seed 42).

**Links.** Equal fingerprints are one row from here on.  Fingerprints that differ in at most 3 of
64 bits differ in at most one bit in one of their two halves.  So each half is indexed under its 32
one-wildcard variants (the half without one bit), and fingerprints that share a variant are
compared in full.  A variant that more than ``bucket`` fingerprints share is cut again in the same
way: of the other half's two 16-bit parts one differs in at most one bit, and then of that part's
sibling's two 8-bit parts.  A third-level variant leaves 11 bits free, so its bucket never holds
more than 2,048 fingerprints: every bucket is bounded, and no link is lost.

Buckets are compared in vectors inside tasks that see them as runs of sorted rows.  Of a bucket's
links only those that connect something new leave the task, at most one fewer than its
fingerprints, never all pairs.  Components follow from these.

Null texts count as empty, null ids are ignored as component ids unless a component has no other,
repeated rows are documents of their own, an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import WORD, map_texts, packed, shuffle_partitions, stored, text_of, unpacked
from tripflow.operators.components import components

SHINGLE, MAX_BITS, BUCKET = 3, 3, 4096
_WORDS = re.compile(WORD)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text, unsigned."""
    words = _WORDS.findall((text or "").translate(_LOWER))
    if not words:
        return 0
    starts = range(max(1, len(words) - shingle + 1))
    xxh, join = xxhash.xxh64_intdigest, " ".join
    total = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(starts), 1 << 14):  # bounds the bit matrix of a very long text
        part = starts[lo:lo + (1 << 14)]
        h = np.fromiter((xxh(join(words[i:i + shingle]), 42) for i in part), dtype=np.uint64, count=len(part))
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (total * 2 > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, keep: list[str], text: str, shingle: int = SHINGLE) -> DataFrame:
    """The ``keep`` columns and the fingerprint ``fp`` (as a signed long) of every row's whole text."""

    def of(t: str) -> tuple[int]:
        fp = fingerprint_of(t, shingle)
        return (fp - (1 << 64) if fp >> 63 else fp,)

    return map_texts(df, keep, lambda: of, "fp long", text)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _variants(fp: Column, shift: int, width: int) -> list[Column]:
    """The ``width``-bit part of ``fp`` at ``shift``, once for each of its bits, with that bit off
    and its number above: equal for parts that differ in that bit alone, or not at all."""
    part = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
    return [part.bitwiseAND(F.lit(((1 << width) - 1) ^ (1 << i)).cast("long")).bitwiseOR(F.lit((shift + i) << 32).cast("long")) for i in range(width)]


def _keys(level: int) -> Column:
    """The variants at a level, given the part chosen at the level above (``at``, ``width``)."""
    fp = F.col("fp")
    if level == 0:
        return F.array(*[F.struct(F.lit(s).alias("at"), v.alias("v")) for s in (0, 32) for v in _variants(fp, s, 32)])

    def of(shift: int, width: int) -> Column:
        return F.array(*[F.struct(F.lit(s).alias("at"), v.alias("v")) for s in (shift, shift + width) for v in _variants(fp, s, width)])

    if level == 1:  # the other half's two parts
        return F.when(F.col("at") == 0, of(32, 16)).otherwise(of(0, 16))
    cases = None  # the sibling of the 16-bit part
    for s in (0, 16, 32, 48):
        cases = (F.when if cases is None else cases.when)(F.col("at") == s, of(s ^ 16, 8))
    return cases


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links within a bucket that connect it as all its links of at most ``max_bits`` would."""
    edges, left = [], fps
    while len(left):  # breadth first: each fingerprint joins the tree of the first one that reaches it
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            reached, step = np.zeros(len(left), dtype=bool), []
            for at in front:
                near = ~reached & (np.bitwise_count(left ^ at) <= max_bits)
                if near.any():
                    reached |= near
                    step.append(left[near])
                    edges += [(int(at), int(x)) for x in left[near]]
            front = np.concatenate(step) if step else left[:0]
            left = left[~reached]
    return edges


def _bucket_links(max_bits: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: np.ndarray | None = None
        columns: list[str] = []

        def links(rows: np.ndarray, closed: bool) -> tuple[pd.DataFrame, np.ndarray]:
            """The links of all whole buckets, and the rows of the last one if it may go on."""
            key, fps = rows[:, :-1], rows[:, -1].view(np.uint64)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            bounds = [0, *cuts.tolist(), *([len(rows)] if closed and len(rows) else [])]
            sizes = np.diff(bounds)
            twos = np.asarray(bounds[:-1], dtype=np.int64)[sizes == 2]
            twos = twos[np.bitwise_count(fps[twos] ^ fps[twos + 1]) <= max_bits]
            more = [e for i in np.flatnonzero(sizes > 2) for e in _forest(fps[bounds[i]:bounds[i + 1]], max_bits)]
            got = np.concatenate([np.stack([fps[twos], fps[twos + 1]], axis=1), np.array(more, dtype=np.uint64).reshape(-1, 2)]).view(np.int64)
            return pd.DataFrame({"a": got[:, 0], "b": got[:, 1]}), rows[bounds[-1]:]

        for f in frames:
            columns = columns or list(f.columns)
            rows = f[columns].to_numpy(dtype=np.int64)
            rows = rows if rest is None else np.concatenate([rest, rows])
            if len(rows):
                found, rest = links(rows, closed=False)
                if len(found):
                    yield found
        if rest is not None and len(rest):
            yield links(rest, closed=True)[0]

    return run


def links(distinct: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints ``fp`` as all links would."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves with one wildcard find distances up to 3")
    if bucket < 2048:
        raise ValueError("a third-level bucket may hold 2,048 fingerprints")
    spark = distinct.sparkSession
    rows, keys, out = distinct.select("fp"), [], None
    for level in range(3):
        rows = rows.withColumn("k", F.explode(_keys(level)))
        keys = [*keys, f"v{level}"]
        rows = rows.select("fp", F.col("k.at").alias("at"), *keys[:-1], F.col("k.v").alias(keys[-1]))
        shared = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        shared, _ = stored(shared, f"variants{level}")  # grows with the corpus: never broadcast
        small = rows.join(shared.filter(F.col("n") <= bucket).drop("n").hint("merge"), keys, "left_semi").select(*keys, "fp")
        found = (small.repartition(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
                 .mapInPandas(_bucket_links(max_bits), "a long, b long").distinct())
        found, _ = stored(found, f"links{level}")
        out = found if out is None else out.unionByName(found)
        hot = shared.filter(F.col("n") > bucket).drop("n")
        if hot.limit(1).count() == 0:
            break
        rows, _ = stored(rows.join(hot, keys, "left_semi"), f"hot{level}")
    else:
        raise AssertionError("a third-level bucket holds at most 2,048 fingerprints")
    return out


def near_groups(df: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(id, fp) of every row, and (fp, component_id) of every distinct fingerprint."""
    docs, _ = stored(fingerprints(df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")), ["id"], "text", shingle), "fingerprints")
    distinct, _ = stored(docs.groupBy("fp").agg(F.min("id").alias("low")), "fingerprints-distinct")
    linked, _ = stored(components(links(distinct, max_bits)), "fingerprint-components")
    both = distinct.join(linked, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = both.filter("root IS NOT NULL").groupBy("root").agg(F.min("low").alias("component_id"))
    ids, _ = stored(both.join(lows, "root").select("fp", "component_id"), "component-ids")
    return docs, ids


def with_component(df: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    docs, ids = near_groups(df, shingle, max_bits, id_col, text_col)
    return docs.join(ids, "fp").select(F.col("id").alias(id_col), as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` with one of each group: the one with the smallest id (nulls last), of equal
    ids the one with the smallest text hash, of rows equal in both one."""
    spark = df.sparkSession
    text = text_of(text_col)
    slim = df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    docs, _ = stored(fingerprints(slim, ["id", "text_hash"], "text", shingle), "fingerprints")
    distinct, _ = stored(docs.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")).alias("low")), "fingerprints-distinct")
    linked, _ = stored(components(links(distinct, max_bits)), "fingerprint-components")
    both = distinct.join(linked, F.col("fp") == F.col("node"), "left").select("low", F.coalesce("root", "fp").alias("root"))
    stay, _ = stored(both.groupBy("root").agg(F.min("low").alias("low")).select(F.col("low.id").alias("s_id"), F.col("low.text_hash").alias("s_hash")), "stay")
    d = packed(df, F.col(id_col).alias("k_id"), F.xxhash64(text).alias("k_hash"))
    d = d.join(stay, F.col("k_id").eqNullSafe(F.col("s_id")) & (F.col("k_hash") == F.col("s_hash")), "left_semi")
    # Rows equal in id and text: one stays.
    same = docs.join(stay, F.col("id").eqNullSafe(F.col("s_id")) & (F.col("text_hash") == F.col("s_hash")), "left_semi")
    if same.groupBy("id", "text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count():
        d = d.groupBy("k_id", "k_hash").agg(F.first("row").alias("row"))
    return unpacked(d, df.columns)
