"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

**Features** of a text, each present or not: its words, pairs of neighbouring words, pairs with one
word between, and the words' first ``STEM`` letters (so an inflected word meets its relatives),
hashed to 2**bits places.  Case is folded; words are runs of letters and digits.

**Training** reads a bounded sample: the ``train_rows`` labelled rows of smallest id hash, of those
that ``eligible`` admits; the bound is on this sample alone.  Features are made in parallel; the
updates, which are sequential, run in one task over the sample.  Every coordinate has a learning
rate of its own, and L1 leaves few weights that are not zero: those go to all scoring tasks (at
most 2**bits, whatever the corpus).  The order of the updates is that of the id hashes, so reruns
give the same weights.

**Scoring** reads every whole text.  Ids, labels, sources and languages are no features.

Null texts count as empty (no features: the score is the bias alone).  Labels that are null, or
whose id is null, are not used; an id labelled twice takes the larger label; of rows repeated under
one id, training uses the smallest text.  Without labels all scores are 0; with one class only,
that class.  Repeated rows give repeated rows; an empty table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import TEXTS, forget, map_texts, stored, text_of

BITS, STEM, TRAIN_ROWS, EPOCHS = 20, 4, 16_000, 8
ALPHA, BETA, L1, L2 = 0.5, 1.0, 6.0, 0.1
CACHE = 100_000
_WORDS = re.compile(r"[^\W_]+")
_M1, _M2, _M3, _M4 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


class _Hashes(dict):
    """Words' hashes, kept up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _Hashes()


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """The places of a text's features, sorted, each once."""
    words = _WORDS.findall((text or "").lower())
    if not words:
        return np.zeros(0, dtype=np.int64)
    n, get = len(words), _HASHES.__getitem__
    h = np.fromiter(map(get, words), dtype=np.uint64, count=n)
    stems = np.fromiter((get(w[:STEM]) for w in words), dtype=np.uint64, count=n)
    pairs = (h[:-1] * _M2) ^ (h[1:] * _M3)
    skips = (h[:-2] * _M3) ^ (h[2:] * _M4)
    every = np.concatenate([h * _M1, pairs * _M1, skips * _M2, (stems ^ _M4) * _M3])
    return np.unique((every >> np.uint64(64 - bits)).astype(np.int64))


@dataclass(frozen=True)
class Weights:
    bias: float
    places: np.ndarray
    values: np.ndarray
    bits: int

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << self.bits)
        w[self.places] = self.values
        return w


def ftrl(rows: list[tuple[np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> Weights:
    """FTRL-proximal over (features, label) rows in their order; the bias is not penalised."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    zb = nb = 0.0
    for _ in range(epochs):
        for at, y in rows:
            zi, ni = z[at], n[at]
            w = np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))
            wb = -zb * alpha / (beta + np.sqrt(nb))
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + wb, -35, 35))) - y
            s = np.sqrt(ni + g * g) - np.sqrt(ni)
            z[at] = zi + g - s / alpha * w
            n[at] = ni + g * g
            sb = (np.sqrt(nb + g * g) - np.sqrt(nb)) / alpha
            zb, nb = zb + g - sb * wb, nb + g * g
    on = np.flatnonzero(np.abs(z) > l1)
    values = -(z[on] - np.sign(z[on]) * l1) / ((beta + np.sqrt(n[on])) / alpha + l2)
    return Weights(float(-zb * alpha / (beta + np.sqrt(nb))), on, values, bits)


def _constant(label: int | None, bits: int) -> Weights:
    return Weights(0.0 if label is None else (-35.0, 35.0)[label], np.zeros(0, dtype=np.int64), np.zeros(0), bits)


def train(df: DataFrame, labels: DataFrame, eligible: Column | None = None, train_rows: int = TRAIN_ROWS, bits: int = BITS,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Weights | None:
    """Weights from at most ``train_rows`` labelled rows; None without any."""
    named = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("id IS NOT NULL AND label IS NOT NULL")
    if eligible is not None:
        named = named.filter(eligible)
    named = named.groupBy("id").agg(F.max("label").alias("label"))
    present = df.select(F.col(id_col).alias("id")).filter("id IS NOT NULL").distinct()
    order = F.xxhash64(F.col("id").cast("string"))
    sample = named.join(present, "id").orderBy(order, "id").limit(train_rows)
    sample, sample_path = stored(sample, "toxicity-sample")  # at most train_rows ids

    texts = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(F.broadcast(sample), "id")
    texts = texts.groupBy("id", "label").agg(F.min("text").alias("text"))
    made, made_path = stored(map_texts(texts, ["id", "label"], lambda: lambda t: (features(t, bits).astype(np.int32),), "at array<int>"), "toxicity-features")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            at = b.column("at")
            places, ends = at.values.to_numpy(), at.offsets.to_numpy()
            rows += [(places[lo:hi].copy(), y) for lo, hi, y in zip(ends, ends[1:], b.column("label").to_pylist())]
        classes = {y for _, y in rows}
        w = ftrl(rows, bits) if len(classes) == 2 else _constant(classes.pop() if classes else None, bits)
        if rows:
            yield pa.RecordBatch.from_pydict({"place": [-1, *w.places.tolist()], "value": [w.bias, *w.values.tolist()]})

    # One task, over the bounded sample alone: the updates depend on one another.
    ordered = made.repartition(1).sortWithinPartitions(F.xxhash64(F.col("id").cast("string")), "id").select("label", "at")
    got = ordered.mapInArrow(fit, "place long, value double").collect()  # at most 2**bits + 1 rows
    forget(df.sparkSession, sample_path, made_path)
    if not got:
        return None
    got.sort(key=lambda r: r.place)
    return Weights(got[0].value, np.array([r.place for r in got[1:]], dtype=np.int64), np.array([r.value for r in got[1:]]), bits)


def score(text: Column, spark, weights: Weights | None) -> Column:
    """The toxicity of a text, 0 to 1."""
    if weights is None:
        return F.lit(0.0)
    shared = spark.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        w = shared.value.dense()
        bias, bits = shared.value.bias, shared.value.bits
        for texts in parts:
            logits = np.zeros(len(texts))
            for lo in range(0, len(texts), TEXTS):
                logits[lo:lo + TEXTS] = [bias + w[features(t, bits)].sum() for t in texts.slice(lo, TEXTS).to_pylist()]
            yield pa.array(1.0 / (1.0 + np.exp(-np.clip(logits, -35, 35))))

    return run(text)


def held_out(id_col: str = "doc_id") -> Column:
    """The rows that no label is learnt from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
