"""Spelling variant grouping with a frequency-vector trie.

**Words.** A text's maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased.  A run whose crc32 of
``<doc_id>:<run>`` is divisible by 97 loses the code point at crc32 % length (this is the corpus's own
noise, the same for all of a run's places in a document).  Words are the results of at least
``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences overall.

**Trie.** Letters are put into ``GROUPS`` groups: the most frequent ones alone, the rest dealt out to
the last ``SHARED``.  A word is arranged by how often each group occurs in it, group after group.  One
inserted, deleted or replaced letter changes these counts by a surplus of at most one and a deficit
of at most one in all; so a depth-first walk down two tries that spends such a budget meets the words
of every pair in reach, and only at leaves are words compared, letter by letter.

**Cells.** The counts of the first groups name a subtree.  How many groups that takes is found from
the words: as few as leave no subtree above ``CELL`` words (``PREFIX`` groups at most; beyond that
subtrees are cut by hash).  A word is sent to its own subtree and, as a query, to every one that its
budget reaches, with what is left of it.  A task walks a subtree for all its queries at once, in
blocks; it returns one row per query, not its pairs.

The form of a word, its near word of largest count (ties: the smallest by code points), has at least
twice the word's count; so forms lead upwards, and pointer doubling finds roots.

Null texts have no words; a null id counts as the empty text in the hash; runs and texts may be of
any length (counts above 255 are held as 255, which only widens the search); repeated rows count as
often as they occur; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import TEXTS, forget, map_runs, shuffle_partitions, stored

MIN_LENGTH, MIN_COUNT, RATIO, NOISE = 5, 3, 2, 97
GROUPS, SHARED = 20, 4
CELL, PREFIX = 1 << 14, 8
#: Distinct words that a task counts before it hands them on; node pairs of a block; letters of a row.
WORDS, BLOCK, WIDTH = 1 << 18, 1 << 16, 48
RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(doc_id: str | None, text: str | None) -> Iterator[tuple[str, int]]:
    """A document's words with their counts, noise applied."""
    runs = Counter(RUN.findall((text or "").translate(_LOWER)))
    start, crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), zlib.crc32
    for run, n in runs.items():
        h = crc(run.encode(), start)
        if h % NOISE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= MIN_LENGTH:
            yield run, n


def word_counts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word, n) of all words; a word costs a task one row, however often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return made

        for b in batches:
            for lo in range(0, b.num_rows, TEXTS):
                part = b.slice(lo, TEXTS)
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for word, n in words_of(i, text):
                        counts[word] += n
                    if len(counts) >= WORDS:
                        yield out()
        yield out()

    texts = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def letter_groups(words: DataFrame) -> dict[str, int]:
    """The group of each letter: by falling frequency (ties by code point), the last groups shared."""
    letters = words.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    # One row per letter of the class RUN: at most 90, whatever the data.
    order = [r["c"] for r in sorted(letters.collect(), key=lambda r: (-r["n"], r["c"]))]
    alone = GROUPS - SHARED
    return {c: i if i < alone else alone + (i - alone) % SHARED for i, c in enumerate(order)}


def vectors(words: list[str], groups: dict[str, int]) -> np.ndarray:
    """Group counts [words, GROUPS], held at 255."""
    table = np.zeros(256, dtype=np.int64)
    for c, g in groups.items():
        table[ord(c)] = g
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    letters = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    return np.minimum(np.bincount(owner * GROUPS + table[letters], minlength=len(words) * GROUPS).reshape(-1, GROUPS), 255).astype(np.uint8)


def _key(vecs: np.ndarray, prefix: int) -> np.ndarray:
    """The first ``prefix`` counts as one number."""
    out = np.zeros((len(vecs), 8), dtype=np.uint8)
    out[:, :prefix] = vecs[:, :prefix]
    return out.view(np.int64)[:, 0]


def _reaches(prefix: int) -> list[tuple[int, int]]:
    """Where a query's budget may go within the prefix: (group of surplus or -1, group of deficit or -1)."""
    return [(i, j) for i in range(-1, prefix) for j in range(-1, prefix) if i < 0 or i != j]


def rows_of_cells(words: DataFrame, groups: dict[str, int], prefix: int, pieces: int) -> DataFrame:
    """(cell, piece, query, s, d, word, n): every word in its subtree, and as a query in those it
    reaches, with the surplus s and deficit d spent on the way."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["cell", "piece", "query", "s", "d", "word", "n"]
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK):
                part = b.slice(lo, BLOCK)
                words_in = part.column(0).to_pylist()
                vecs = vectors(words_in, groups)
                own = np.array([zlib.crc32(w.encode("latin-1")) % pieces for w in words_in], dtype=np.int32)

                def made(rows: np.ndarray, cells: np.ndarray, piece: np.ndarray, query: bool, s: int, d: int) -> pa.RecordBatch:
                    t = part.take(pa.array(rows))
                    flat = [pa.array(np.full(len(rows), v), k) for v, k in ((query, pa.bool_()), (s, pa.int32()), (d, pa.int32()))]
                    return pa.RecordBatch.from_arrays([pa.array(cells), pa.array(piece.astype(np.int32)), *flat, t.column(0), t.column(1)], names)

                yield made(np.arange(len(vecs)), _key(vecs, prefix), own, False, 0, 0)
                for i, j in _reaches(prefix):
                    near = vecs.astype(np.int16)
                    if i >= 0:
                        near[:, i] -= 1
                    if j >= 0:
                        near[:, j] += 1
                    rows = np.flatnonzero(((near >= 0) & (near <= 255)).all(axis=1))
                    cells = _key(near[rows].astype(np.uint8), prefix)
                    for p in range(pieces):
                        yield made(rows, cells, np.full(len(rows), p), True, int(i >= 0), int(j >= 0))

    return words.select("word", "n").mapInArrow(run, "cell long, piece int, query boolean, s int, d int, word string, n long")


class Trie:
    """Rows sorted by their counts; a level's nodes are runs of rows, held as (parent, count) in order."""

    def __init__(self, vecs: np.ndarray) -> None:
        self.order = np.lexsort(vecs.T[::-1])
        rows = vecs[self.order]
        new = np.zeros(len(rows), dtype=bool)
        new[:1] = True
        node = np.zeros(len(rows), dtype=np.int64)
        self.keys: list[np.ndarray] = []
        self.first: list[np.ndarray] = []  # of a node of the level above: its first child
        for level in range(rows.shape[1]):
            new[1:] |= rows[1:, level] != rows[:-1, level]
            at = np.flatnonzero(new)
            parents = node[at]
            self.keys.append(parents << 8 | rows[at, level])
            self.first.append(np.searchsorted(parents, np.arange((node[-1] if len(node) else -1) + 2)))
            node = np.cumsum(new) - 1
        self.rows = np.append(np.flatnonzero(new), len(rows))  # of a leaf: its first row


def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [first, last), and of which range each is."""
    sizes = last - first
    owner = np.repeat(np.arange(len(first)), sizes)
    return np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[owner], owner


def walk(queries: np.ndarray, spent: np.ndarray, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query row, word row) whose counts differ by a surplus and a deficit of at most one
    each, less what is ``spent`` [queries, 2]; depth first, in blocks."""
    if not len(queries) or not len(words):
        return
    a, b, levels = Trie(np.concatenate([spent.astype(np.uint8), queries], axis=1)), Trie(words), words.shape[1]
    # The first two levels of the queries' trie are what they have spent.
    deep = np.arange(len(a.keys[1]))
    stack = [(0, deep, np.zeros(len(deep), dtype=np.int64), a.keys[0][a.keys[1] >> 8] & 255, a.keys[1] & 255)]
    while stack:
        level, x, y, s, d = stack.pop()
        if level == levels:
            for lo in range(0, len(x), BLOCK):
                left, owner = _ranges(a.rows[x[lo:lo + BLOCK]], a.rows[x[lo:lo + BLOCK] + 1])
                ys = y[lo:lo + BLOCK][owner]
                for at in range(0, len(left), BLOCK):
                    right, own = _ranges(b.rows[ys[at:at + BLOCK]], b.rows[ys[at:at + BLOCK] + 1])
                    yield a.order[left[at:at + BLOCK][own]], b.order[right]
            continue
        child, owner = _ranges(a.first[level + 2][x], a.first[level + 2][x + 1])
        count, y, s, d = a.keys[level + 2][child] & 255, y[owner], s[owner], d[owner]
        found = []
        for step in (0, -1, 1):  # the word has as many, one fewer (a surplus of the query), one more
            ok = (count + step >= 0) & (count + step <= 255) & ((s == 0) if step < 0 else (d == 0) if step > 0 else True)
            key = y[ok] << 8 | (count[ok] + step)
            at = np.minimum(np.searchsorted(b.keys[level], key), len(b.keys[level]) - 1)
            hit = b.keys[level][at] == key
            found.append((child[ok][hit], at[hit], s[ok][hit] + (step < 0), d[ok][hit] + (step > 0)))
        nxt = [np.concatenate(c) for c in zip(*found)]
        for lo in range(0, len(nxt[0]), BLOCK):
            stack.append((level + 1, *(c[lo:lo + BLOCK] for c in nxt)))


def differ_by_one(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point leads from a to b."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[at + 1:] == (b[at + 1:] if len(a) == len(b) else b[at:])


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters [words, WIDTH], 0 beyond a word's end (longer words cut), and lengths."""
    text = np.array([w.encode("latin-1") for w in words], dtype=f"S{WIDTH}")
    return text.view(np.uint8).reshape(len(words), WIDTH), np.array([len(w) for w in words])


def _verified(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], x: np.ndarray, y: np.ndarray, names: tuple[list[str], list[str]]) -> np.ndarray:
    """``differ_by_one`` of the pairs of rows (x, y)."""
    (la, na), (lb, nb) = a, b
    more = na[x] - nb[y]
    out = np.zeros(len(x), dtype=bool)
    wide = (na[x] >= WIDTH) | (nb[y] >= WIDTH)
    for i in np.flatnonzero(wide):
        out[i] = differ_by_one(names[0][x[i]], names[1][y[i]])
    same = np.flatnonzero((more == 0) & ~wide)
    out[same] = (la[x[same]] != lb[y[same]]).sum(axis=1) == 1
    for step, (lp, p), (lq, q) in ((1, (la, x), (lb, y)), (-1, (lb, y), (la, x))):
        rows = np.flatnonzero((more == step) & ~wide)
        p_letters, q_letters = lp[p[rows]], lq[q[rows]]
        at = (p_letters != q_letters).argmax(axis=1)
        late = p_letters[:, 1:] != q_letters[:, :-1]
        last = np.where(late.any(axis=1), WIDTH - 2 - late[:, ::-1].argmax(axis=1), -1)
        out[rows] = last < at
    return out


def _cell(groups: dict[str, int], prefix: int) -> Callable[[pa.Table], Iterator[pa.RecordBatch]]:
    def of(t: pa.Table) -> Iterator[pa.RecordBatch]:
        ask = t.column("query").to_numpy(zero_copy_only=False)
        words, queries = t.filter(pa.array(~ask)), t.filter(pa.array(ask))
        if not words.num_rows or not queries.num_rows:
            return
        names = queries.column("word").to_pylist(), words.column("word").to_pylist()
        vecs = [vectors(w, groups)[:, prefix:] for w in names]
        letters = [_letters(w) for w in names]
        n = words.column("n").to_numpy()
        rank = np.empty(len(n), dtype=np.int64)  # 0: the best form
        rank[np.lexsort((np.array(names[1]), -n))] = np.arange(len(n))
        by_rank = np.argsort(rank)
        near, best = np.zeros(len(names[0]), dtype=np.int64), np.full(len(names[0]), len(n))
        spent = np.stack([queries.column(c).to_numpy() for c in ("s", "d")], axis=1)
        for x, y in walk(vecs[0], spent, vecs[1]):
            ok = _verified(letters[0], letters[1], x, y, names)
            np.add.at(near, x[ok], 1)
            np.minimum.at(best, x[ok], rank[y[ok]])
        got = np.flatnonzero(near)
        top = by_rank[best[got]]
        yield pa.RecordBatch.from_arrays([
            pa.array([names[0][i] for i in got], pa.string()), pa.array(near[got]), pa.array(n[top]), pa.array([names[1][i] for i in top], pa.string())],
            ["word", "n_near", "best_n", "best"])

    return of


def subtrees(words: DataFrame, groups: dict[str, int], cell: int = CELL) -> tuple[int, int]:
    """How many groups name a subtree so that none has more than ``cell`` words, and into how many
    pieces each is cut where even ``PREFIX`` groups don't suffice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_key(vectors(b.column(0).to_pylist(), groups), PREFIX))], ["key"])

    keys, path = stored(words.select("word").mapInArrow(run, "key long"), "subtrees")
    most, prefix = 0, 1
    for prefix in range(2, PREFIX + 1):
        own = F.col("key").bitwiseAND(F.lit((1 << 8 * prefix) - 1 if prefix < 8 else -1).cast("long"))
        most = keys.groupBy(own.alias("k")).agg(F.count(F.lit(1)).alias("m")).agg(F.max("m")).first()[0] or 0
        if most <= cell:
            break
    forget(words.sparkSession, path)
    return prefix, max(1, -(-most // cell))


def near_words(words: DataFrame, cell: int = CELL) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) that have near words."""
    groups = letter_groups(words)
    prefix, pieces = subtrees(words, groups, cell)
    rows = rows_of_cells(words, groups, prefix, pieces)
    dealt = rows.repartition(shuffle_partitions(words.sparkSession), "cell", "piece").sortWithinPartitions("cell", "piece")
    found = dealt.mapInArrow(map_runs(_cell(groups, prefix), 2), "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words (word, form) that have a form: where the forms lead."""
    at, path = stored(forms.select("word", F.col("form").alias("root")), "roots")
    spark = forms.sparkSession
    while True:  # a form's count is RATIO times its word's, so chains are short and end
        up = at.select(F.col("word").alias("root"), F.col("root").alias("up"))
        step, step_path = stored(at.join(up, "root", "left").select("word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")), "roots")
        forget(spark, path)
        at, path = step.select("word", "root"), step_path
        if step.filter("moved").limit(1).count() == 0:
            return at


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", cell: int = CELL) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the corpus."""
    words, _ = stored(word_counts(df, id_col, text_col), "words")
    near = near_words(words, cell)
    good = F.col("best_n") >= RATIO * F.col("n")
    full = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                                   F.when(good, F.col("best")).alias("form"), F.when(good, F.col("best_n")).alias("form_n"))
    full, _ = stored(full, "forms")
    up = roots(full.filter("form IS NOT NULL").select("word", "form"))
    return full.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
