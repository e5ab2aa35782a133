"""MinHash near-dedup with sequential Bayesian verification.

**Sets.** A text's A-Z are lower-cased; its set is its distinct ``shingle``-word shingles, joined by
spaces (a text of fewer words: the whole sequence; of none: the empty set, which links with nothing).
Two texts link if ``100 * |A & B| >= percent * |A | B|``.  Shingles are held as their 64-bit XXH64,
all of them, never a prefix; two shingles of two compared texts that share a hash would count as one
(about n * n / 2**64 for texts of n shingles).  Texts with equal sets are one row from here on.

**Candidates.** 128 min-hashes make 32 bands of four; texts are compared if they share a band.  At
85 % a pair shares none with probability (1 - 0.85**4)**32 = 6e-11.  In a bucket, signatures are
compared batch by batch (16 hashes each): with a uniform prior, m matches of k hashes leave a pair
the posterior probability P(Binomial(k + 1, percent) <= m) of being a link, and a pair is given up
once that is below ``MISS``.  A bucket yields a spanning forest of what survives, never its pairs; a
bucket of more than ``BUCKET`` texts is linked as a whole, uncompared, which is coarser and safe.

**Verification.** The components of that forest are families: no link leads out of one.  Only their
texts are read again, and their full sets go, once each, to the tasks that verify: by the same
sequential test first, then by exact intersection.  What leaves a task is a forest of true links.
A family beyond ``CELL`` texts is cut into cells of bounded size: two rounds of cells (by size of
set, and by hash) merge most of it; then every text outside the family's largest component is
compared with all others of its family, cell against cell.  So no task holds a family, and no link
between components stays untested.

Null texts count as empty; null ids are ignored as component ids unless a component has no other;
repeated rows are rows of their own; texts may be of any length; an empty table gives no rows; other
columns are not read.  Equal rows, ties: the result depends on sets and ids alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import WORD, forget, join_hot, map_runs, map_texts, shuffle_partitions, stored, text_of
from tripflow.operators.components import components

SHINGLE, PERCENT = 3, 85
BANDS, ROWS, BATCH = 32, 4, 16
HASHES = BANDS * ROWS
MISS = 1e-6
BUCKET, CELL, CELL_HASHES = 4096, 2048, 1 << 21

_WORDS = re.compile(WORD)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_RNG = np.random.default_rng(11)
_MUL, _ADD = _RNG.integers(0, 2**64, HASHES, dtype=np.uint64) | np.uint64(1), _RNG.integers(0, 2**64, HASHES, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    words = _WORDS.findall(text.translate(_LOWER))
    if not words:
        return np.empty(0, dtype=np.uint64)
    xxh, join, n = xxhash.xxh64_intdigest, " ".join, max(1, len(words) - shingle + 1)
    return np.unique(np.fromiter((xxh(join(words[i:i + shingle])) for i in range(n)), dtype=np.uint64, count=n))


def signature(hashes: np.ndarray) -> np.ndarray:
    """16 bits of each of the 128 min-hashes."""
    low = np.full(HASHES, 2**64 - 1, dtype=np.uint64)
    for lo in range(0, len(hashes), 1024):  # bounds the memory of a very long text
        low = np.minimum(low, (hashes[lo:lo + 1024, None] * _MUL + _ADD).min(axis=0))
    return ((low * _MIX) >> np.uint64(48)).astype(np.uint16)


@cache
def fewest_matches(percent: int = PERCENT, miss: float = MISS) -> tuple[int, ...]:
    """For each batch, the fewest matches so far with which a pair is still a link with probability ``miss``."""
    t, out = percent / 100, []
    for k in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += comb(k + 1, m) * t**m * (1 - t) ** (k + 1 - m)
        out.append(m)
    return tuple(out)


def survivors(sigs: np.ndarray, sig: np.ndarray, rows: np.ndarray, percent: int) -> np.ndarray:
    """Those of ``rows`` whose signatures may belong to links of ``sig``'s text."""
    seen = np.zeros(len(rows), dtype=np.int64)
    for i, least in enumerate(fewest_matches(percent)):
        part = slice(i * BATCH, (i + 1) * BATCH)
        seen += (sigs[rows, part] == sig[part]).sum(axis=1)
        keep = seen >= least
        if not keep.all():
            rows, seen = rows[keep], seen[keep]
        if not len(rows):
            break
    return rows


def _sized(sizes: np.ndarray, n: int, rows: np.ndarray, percent: int) -> np.ndarray:
    """Those of ``rows`` whose sets are neither too small nor too large for a link with one of ``n``."""
    s = sizes[rows]
    return rows[100 * np.minimum(s, n) >= percent * np.maximum(s, n)]


def bucket_forest(sizes: np.ndarray, sigs: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of a bucket's rows that connect it as all its surviving pairs would."""
    out, left = [], np.arange(len(sizes))
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            got = survivors(sigs, sigs[at], _sized(sizes, sizes[at], left, percent), percent)
            if len(got):
                out += [(int(at), int(x)) for x in got]
                front += got.tolist()
                left = left[~np.isin(left, got)]
    return out


def cell_links(sets: list[np.ndarray], sigs: np.ndarray, comp: np.ndarray, ask: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """True links that join the components ``comp`` of a cell's rows as all links would that have
    an end among the rows ``ask``; no more than components less one."""
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mark = np.zeros(codes.max(initial=0) + 1, dtype=bool)
    comp, out = comp.copy(), []
    front: list[int] = []
    order = iter(np.flatnonzero(ask).tolist())
    asked = np.zeros(len(sets), dtype=bool)
    while True:
        # Neighbours first: what a link has just reached is likely to reach the rest.
        at = front.pop() if front else next(order, None)
        if at is None:
            return out
        if asked[at] or not ask[at]:
            continue
        asked[at] = True
        other = np.flatnonzero(comp != comp[at])
        rows = survivors(sigs, sigs[at], _sized(sizes, sizes[at], other, percent), percent)
        if not len(rows):
            continue
        own = codes[ends[at] - sizes[at]:ends[at]]
        mark[own] = True
        both = np.array([np.count_nonzero(mark[codes[ends[r] - sizes[r]:ends[r]]]) for r in rows.tolist()])
        mark[own] = False
        for r in rows[100 * both >= percent * (sizes[at] + sizes[rows] - both)].tolist():
            if comp[r] != comp[at]:
                comp[comp == comp[r]] = comp[at]
                out.append((int(at), r))
                front.append(r)


def _sigs(t: pa.Table) -> np.ndarray:
    return np.stack([np.frombuffer(x, dtype=np.uint16) for x in t.column("sig").to_pylist()])


def _edges(ids: np.ndarray, pairs: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    if pairs:
        at = np.array(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(ids[at[:, side]]) for side in (0, 1)], ["a", "b"])


def _bucket(percent: int) -> Callable[[pa.Table], Iterator[pa.RecordBatch]]:
    def of(t: pa.Table) -> Iterator[pa.RecordBatch]:
        if t.num_rows > 1:
            yield from _edges(t.column("sid").to_numpy(), bucket_forest(t.column("n").to_numpy(), _sigs(t), percent))

    return of


def _cell(percent: int, whole: bool = False) -> Callable[[pa.Table], Iterator[pa.RecordBatch]]:
    """Links of a cell; if it holds a ``whole`` family, each row linked to the smallest of its component."""

    def of(t: pa.Table) -> Iterator[pa.RecordBatch]:
        if t.num_rows < 2:
            return
        sets = [np.frombuffer(x, dtype=np.uint64) for x in t.column("shingles").to_pylist()]
        comp = t.column("comp").to_numpy()
        pairs = cell_links(sets, _sigs(t), comp, t.column("ask").to_numpy(zero_copy_only=False), percent)
        ids = t.column("sid").to_numpy()
        if whole and pairs:
            up = {i: i for p in pairs for i in p}

            def find(i: int) -> int:
                while up[i] != i:
                    up[i] = up[up[i]]
                    i = up[i]
                return i

            for a, b in pairs:
                x, y = sorted((find(a), find(b)), key=lambda i: ids[i])
                up[y] = x
            pairs = [(i, find(i)) for i in up]
        yield from _edges(ids, pairs)

    return of


def _grouped(rows: DataFrame, keys: list[str], of: Callable[[pa.Table], Iterator[pa.RecordBatch]]) -> DataFrame:
    first = [*keys, *[c for c in rows.columns if c not in keys]]
    dealt = rows.select(*first).repartition(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(map_runs(of, len(keys)), "a long, b long")


def sketches(df: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(id, k1, k2, n, digest, sig) of every row: k1 and k2 name its text, digest its set."""

    def of(text: str) -> tuple[int, bytes | None, bytes | None]:
        hashes = shingle_set(text, shingle)
        if not len(hashes):
            return 0, None, None
        return len(hashes), xxhash.xxh128_digest(hashes.tobytes()), signature(hashes).tobytes()

    text = text_of(text_col)
    d = df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("k1"), F.crc32(text.cast("binary")).alias("k2"), text.alias("text"))
    return map_texts(d, ["id", "k1", "k2"], lambda: of, "n long, digest binary, sig binary")


def candidate_edges(sets: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that connect the distinct ``sets`` (sid, n, sig) as all their candidate pairs
    would that the sequential test lets pass."""
    width = 2 * ROWS
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring(F.col("sig"), i * width + 1, F.lit(width))))
    rows = sets.select("sid", F.explode(bands).alias("band"))
    shared, path = stored(rows.groupBy("band").agg(F.count(F.lit(1)).alias("m"), F.min("sid").alias("first")).filter("m > 1"), "bands")
    big = F.col("m") > BUCKET  # at most one in BUCKET of all band rows
    # Signatures travel only with what shares a band.
    some, some_path = stored(rows.join(shared.filter(~big).select("band").hint("merge"), "band", "left_semi"), "shared")
    out = _grouped(some.join(sets.hint("merge"), "sid").select("band", "sid", "n", "sig"), ["band"], _bucket(percent)).distinct()
    large = join_hot(rows, shared.filter(big).select("band", "first", "m"), ["band"], "m")
    out, _ = stored(out.unionByName(large.filter("sid <> first").select(F.col("first").alias("a"), F.col("sid").alias("b")).distinct()), "candidates")
    forget(sets.sparkSession, path, some_path)
    return out


def family_components(rows: DataFrame, percent: int) -> DataFrame:
    """(sid, root) of the rows (family, sid, n, sig, shingles) that have links; root is the smallest sid
    that a row reaches over them."""
    spark = rows.sparkSession
    size = rows.groupBy("family").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("hashes"), F.max("n").alias("most"))
    # A cell holds CELL rows or CELL_HASHES hashes on average, whichever is less.
    pieces = F.ceil(F.greatest(F.col("m") / F.lit(CELL), F.col("hashes") / F.lit(CELL_HASHES))).cast("int")
    large, path = stored(size.withColumn("pieces", pieces).filter("pieces > 1"), "families")
    cell = F.xxhash64("family", F.lit(0))
    alone = rows.join(large.select("family").hint("merge"), "family", "left_anti")
    alone = alone.select(cell.alias("cell"), "sid", "sig", "shingles", F.col("sid").alias("comp"), F.lit(True).alias("ask"))
    found, _ = stored(_grouped(alone, ["cell"], _cell(percent, whole=True)), "links")
    found = found.select(F.col("a").alias("sid"), F.col("b").alias("root"))
    if large.limit(1).count() == 0:
        return found
    hot, _ = stored(join_hot(rows, large.select("family", "m", "hashes", "pieces"), ["family"], "m").drop("m", "hashes"), "family-rows")
    links = None
    # By size (texts of like sizes link) in steps of a tenth, then by hash alone.
    by_size = F.struct(F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.1))).alias("step"), F.pmod(F.xxhash64("sid", F.lit(1)), F.col("pieces")).alias("piece"))
    by_hash = F.struct(F.lit(-1).cast("long").alias("step"), F.pmod(F.xxhash64("sid", F.lit(2)), F.col("pieces")).alias("piece"))
    for way in (by_size, by_hash):
        d = _with_comp(hot, links).select(F.xxhash64("family", way).alias("cell"), "sid", "sig", "shingles", "comp", F.lit(True).alias("ask"))
        new, _ = stored(_grouped(d, ["cell"], _cell(percent)), "links")
        links = new if links is None else links.unionByName(new)
    # The closing: whatever is not in its family's largest component, against all of the family.
    d, d_path = stored(_with_comp(hot, links), "family-components")
    per = d.groupBy("family", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("h"))
    main = per.groupBy("family").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.sum("c").alias("all_c"), F.sum("h").alias("all_h"),
                                     F.max(F.struct("c", "comp", "h")).alias("top"))
    few = main.select("family", "main", (F.col("all_c") - F.col("top.c")).alias("q_c"), (F.col("all_h") - F.col("top.h")).alias("q_h"), F.col("all_c").alias("m"),
                      F.ceil(F.greatest(F.col("all_c") / F.lit(CELL), F.col("all_h") / F.lit(CELL_HASHES))).cast("int").alias("d_pieces"))
    few = few.filter("q_c > 0").withColumn("q_pieces", F.greatest(F.lit(1), F.ceil(F.greatest(F.col("q_c") / F.lit(CELL), F.col("q_h") / F.lit(CELL_HASHES)))).cast("int"))
    few, few_path = stored(few, "family-rest")
    last = join_hot(d, few.select("family", "main", "m", "d_pieces", "q_pieces"), ["family"], "m")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    mine = lambda c, k: F.pmod(F.xxhash64("sid", F.lit(k)), F.col(c)).cast("int")
    asking = last.filter("comp <> main").withColumn("q", mine("q_pieces", 3)).withColumn("d", every("d_pieces")).withColumn("ask", F.lit(True))
    asked = last.withColumn("d", mine("d_pieces", 4)).withColumn("q", every("q_pieces")).withColumn("ask", F.lit(False))
    both = asking.unionByName(asked).select(F.xxhash64("family", "d", "q").alias("cell"), "sid", "sig", "shingles", "comp", "ask")
    closing, _ = stored(_grouped(both, ["cell"], _cell(percent)), "links")
    forget(spark, path, d_path, few_path)
    return found.unionByName(components(links.unionByName(closing)).select(F.col("node").alias("sid"), "root"))


def _with_comp(rows: DataFrame, links: DataFrame | None) -> DataFrame:
    if links is None:
        return rows.withColumn("comp", F.col("sid"))
    linked = components(links).select(F.col("node").alias("sid"), F.col("root").alias("comp"))
    return rows.join(linked.hint("merge"), "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))


def near_duplicates(df: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row: component_id is the smallest id that
    the row reaches over links (null if no row it reaches has one), kept whether that is its own id."""
    if not 75 <= percent <= 100:
        raise ValueError("the bands are made for similarities of 75 % and more")
    spark = df.sparkSession
    docs, _ = stored(sketches(df, shingle, id_col, text_col), "sketches")
    sets = docs.filter("n > 0").groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("low"), F.min(F.struct("k1", "k2")).alias("k"), F.min("n").alias("n"), F.min("sig").alias("sig"))
    sets, sets_path = stored(sets.withColumn("sid", F.monotonically_increasing_id()), "sets")
    candidates = candidate_edges(sets.select("sid", "n", "sig"), percent)
    families, families_path = stored(components(candidates).select(F.col("node").alias("sid"), F.col("root").alias("family")), "families")
    members, members_path = stored(sets.join(families.hint("merge"), "sid").select("family", "sid", "n", "sig", "k.k1", "k.k2"), "members")
    # Texts again, of families only and one of each set; copies of a text are one row before they are shuffled.
    text = text_of(text_col)
    texts = df.select(F.xxhash64(text).alias("k1"), F.crc32(text.cast("binary")).alias("k2"), text.alias("text")).groupBy("k1", "k2").agg(F.min("text").alias("text"))

    def of(t: str) -> tuple[bytes]:
        return (shingle_set(t, shingle).tobytes(),)

    again = texts.join(members.hint("merge"), ["k1", "k2"])
    rows, rows_path = stored(map_texts(again, ["family", "sid", "n", "sig"], lambda: of, "shingles binary"), "full-sets")
    linked = family_components(rows, percent)
    both = sets.join(linked, "sid", "left").select("digest", "copies", "low", F.coalesce("root", "sid").alias("root"))
    lows = both.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("m"))
    ids, _ = stored(join_hot(both, lows, ["root"], "m").select("digest", "copies", "component_id"), "component-ids")
    forget(spark, sets_path, families_path, members_path, rows_path)
    some = join_hot(docs.filter("n > 0").select("id", "n", "digest"), ids, ["digest"], "copies").select("id", "n", "component_id")
    none = docs.filter("n = 0").select("id", "n", F.col("id").alias("component_id"))
    out = some.unionByName(none)
    same: Column = F.col("id").eqNullSafe(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", same.alias("kept"))
