"""Embedding whitening from bit-sliced, exact cross-products.

**Integers.** An entry c becomes x = floor(64 * c) + 1000000.  A row whose vector is null, holds a
null or non-finite entry, or one beyond 2**61 in size, is left out; so is one whose length is not the
most frequent length (of equally frequent ones the largest).  The rest is the fit list.

**Scatter.** A task takes its rows in batches.  In a batch each dimension is shifted by its own
minimum, and bit i of all rows' shifted values is packed into 64-bit words: one bit plane per
dimension and bit.  The cross-product of two dimensions is the sum over bits i and j of
2**(i + j) times the number of ones in plane i of the one AND plane j of the other.  The shifts are
taken out again in exact integers.  A task returns one row per pair of dimensions; Spark adds those
as decimals.  So what reaches the driver has dimensions squared, whatever the rows.

**Centring.** With sums S and cross-products P, n * P - S S' is formed in Python's integers, so
nothing cancels; divided by n * n it is the covariance, whose eigenvectors numpy's ``eigh`` gives.  A
component's sign is fixed by its largest entry being positive.  Components without spread (an
eigenvalue below 1e-12 of their sum) have no whitened values and are left out.

Rows are whitened by all tasks, from integers centred before anything is multiplied.  The whitened
rows' covariance is summed up in a pass of its own.  Null ids stay; repeated rows count
as often as they occur; an empty table, or one without spread, gives no rows; other columns are
not read.  A deviation that does not fit a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE, OFFSET, COMPONENTS, LIMIT = 64, 1_000_000, 32, 2.0**61
#: Rows of a batch whose bit planes are in memory at a time.
BATCH = 4096
#: The covariance is one table on the driver and in each task.
MAX_DIMENSIONS = 4096


class Fit(NamedTuple):
    """What is learnt from the fit list: its rows, the sums of x, and the components (rows of unit
    vectors) with their eigenvalues and the covariance's trace."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def _matrix(column: pa.Array, dims: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are in the fit list, and their entries without the offset, floor(64 * c)."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ok = column.is_valid().to_numpy(zero_copy_only=False) & (lengths == dims)
    flat = column.filter(pa.array(ok)).flatten()
    values = np.floor(flat.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64) * SCALE).reshape(-1, dims)
    good = (np.isfinite(values) & (np.abs(values) < LIMIT)).all(axis=1)
    ok[np.flatnonzero(ok)[~good]] = False
    return ok, values[good].astype(np.int64)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, BATCH):
            yield b.slice(lo, BATCH)


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Words [bits, dimensions, words] of non-negative ``values`` [rows, dimensions]: bit r of word w of
    plane i is bit i of the value in row 64 * w + r."""
    rows, dims = values.shape
    bits = int(values.max(initial=0)).bit_length()
    words = -(-rows // 64)
    out = np.zeros((bits, dims, words), dtype=np.uint64)
    for i in range(bits):
        plane = np.zeros((dims, words * 64), dtype=np.uint8)
        plane[:, :rows] = (values >> i & 1).T
        out[i] = np.packbits(plane, axis=1, bitorder="little").view(np.uint64)
    return out


def cross_products(values: np.ndarray) -> np.ndarray:
    """Exact sums over rows of the products of any two columns (Python integers in an object array)."""
    rows, dims = values.shape
    low = values.min(axis=0) if rows else np.zeros(dims, dtype=np.int64)
    shifted = values - low
    planes = bit_planes(shifted)
    out = np.zeros((dims, dims), dtype=object)
    for i in range(len(planes)):
        for j in range(i, len(planes)):
            ones = np.stack([np.bitwise_count(row & planes[j]).sum(axis=1, dtype=np.int64) for row in planes[i]])
            both = ones if i == j else ones + ones.T
            out += both.astype(object) << (i + j)
    sums, low = shifted.sum(axis=0, dtype=object) if rows else low.astype(object), low.astype(object)
    return out + np.outer(low, sums) + np.outer(sums, low) + rows * np.outer(low, low)


def dimensions(df: DataFrame, column: str) -> int:
    """The most frequent length of the vectors without null or non-finite entries."""
    c = F.col(column)
    good = F.forall(c, lambda v: F.coalesce(v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) * SCALE < LIMIT), F.lit(False)))
    sizes = df.filter(c.isNotNull() & good).groupBy(F.size(c).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    best = sizes.agg(F.max_by("d", F.struct("n", "d")).alias("d")).first()["d"]
    if best and best > MAX_DIMENSIONS:
        raise ValueError(f"vectors of {best} entries: the covariance is made for {MAX_DIMENSIONS} at most")
    return best or 0


def scatter(df: DataFrame, column: str, dims: int) -> tuple[int, list[int], np.ndarray]:
    """Rows, sums and cross-products of the entries without the offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dims, dtype=object), np.zeros((dims, dims), dtype=object)
        for b in _batches(batches):
            _, values = _matrix(b.column(0), dims)
            n += len(values)
            sums += values.astype(object).sum(axis=0) if len(values) else 0
            products += cross_products(values)
        if n:
            a, b = np.triu_indices(dims)
            cells = [(-1, -1, n), *((-1, i, s) for i, s in enumerate(sums)), *zip(a.tolist(), b.tolist(), products[a, b])]
            yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in cells], pa.int32()), pa.array([c[1] for c in cells], pa.int32()), pa.array([str(c[2]) for c in cells])], ["a", "b", "v"])

    parts = df.select(column).mapInArrow(run, "a int, b int, v string")
    # One row per pair of dimensions: bounded by MAX_DIMENSIONS, not by the data.
    cells = parts.groupBy("a", "b").agg(F.sum(F.col("v").cast("decimal(38,0)")).cast("string").alias("v")).collect()
    n, sums, products = 0, [0] * dims, np.zeros((dims, dims), dtype=object)
    for a, b, v in cells:
        if b < 0:
            n = int(v)
        elif a < 0:
            sums[b] = int(v)
        else:
            products[a, b] = products[b, a] = int(v)
    return n, sums, products


def fit(df: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Fit:
    dims = dimensions(df, column)
    n, sums, products = scatter(df, column, dims) if dims else (0, [], np.zeros((0, 0), dtype=object))
    if not n:
        return Fit(0, [], np.zeros((0, dims)), np.zeros(0), 0.0)
    centred = n * products - np.outer(np.array(sums, dtype=object), np.array(sums, dtype=object))
    trace = int(sum(centred[i, i] for i in range(dims))) / (n * n)
    if trace == 0:
        return Fit(n, [s + n * OFFSET for s in sums], np.zeros((0, dims)), np.zeros(0), 0.0)
    covariance = np.array([[int(v) / (n * n) for v in row] for row in centred])
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > 1e-12 * trace]
    values, vectors = values[order], vectors[:, order].T
    sign = np.sign(vectors[np.arange(len(order)), np.abs(vectors).argmax(axis=1)])
    return Fit(n, [s + n * OFFSET for s in sums], vectors * sign[:, None], values, trace)


def _whiten(values: np.ndarray, f: Fit) -> np.ndarray:
    """Whitened rows: (x - S / n) on the components, over the roots of the eigenvalues."""
    low = [s - f.n * OFFSET for s in f.sums]
    whole = np.array([s // f.n for s in low], dtype=np.int64)
    part = np.array([(s % f.n) / f.n for s in low])
    return ((values - whole).astype(np.float64) - part) @ f.vectors.T / np.sqrt(f.values)


def _deviations(values: np.ndarray, f: Fit) -> list[int | None]:
    low = [s - f.n * OFFSET for s in f.sums]
    reach = max((abs(f.n * int(v) - s) for ends in (values.min(axis=0), values.max(axis=0)) for v, s in zip(ends, low)), default=0) if len(values) else 0
    if reach * reach * max(1, len(low)) < 2**63:
        off = f.n * values - np.array(low, dtype=np.int64)
        return (off * off).sum(axis=1).tolist()
    off = f.n * values.astype(object) - np.array(low, dtype=object)
    return [v if v < 2**63 else None for v in (off * off).sum(axis=1).tolist()]


def identity_error(df: DataFrame, f: Fit, column: str = "embedding") -> float:
    """The largest absolute entry of the whitened rows' covariance (divisor n) minus the identity."""
    k, dims = len(f.values), f.vectors.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(k), np.zeros((k, k))
        for b in _batches(batches):
            w = _whiten(_matrix(b.column(0), dims)[1], f)
            sums += w.sum(axis=0)
            products += w.T @ w
        a, b = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.full(k, -1), a]), pa.int32()), pa.array(np.concatenate([np.arange(k), b]), pa.int32()),
                                          pa.array(np.concatenate([sums, products[a, b]]))], ["a", "b", "v"])

    cells = df.select(column).mapInArrow(run, "a int, b int, v double").groupBy("a", "b").agg(F.sum("v").alias("v")).collect()
    means = {b: v / f.n for a, b, v in cells if a < 0}
    return max((abs(v / f.n - means[a] * means[b] - (a == b)) for a, b, v in cells if a >= 0), default=0.0)


def whitened(df: DataFrame, column: str = "embedding", id_col: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), one row for each row of
    the fit list and component."""
    f = fit(df, column, components)
    schema = T.StructType([df.schema[id_col], *T.StructType.fromDDL(
        "component int, n long, deviation long, whitened double, explained double, identity_error double").fields])
    k, dims = len(f.values), f.vectors.shape[1]
    if not k:
        return df.sparkSession.createDataFrame([], schema)
    error, share, names = identity_error(df, f, column), f.values / f.trace, schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(batches):
            ok, values = _matrix(b.column(1), dims)
            rows = len(values)
            ids = b.column(0).filter(pa.array(ok)).take(pa.array(np.repeat(np.arange(rows), k)))
            deviation = pa.array(_deviations(values, f), type=pa.int64()).take(pa.array(np.repeat(np.arange(rows), k)))
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()), pa.array(np.full(rows * k, f.n), pa.int64()), deviation,
                pa.array(_whiten(values, f).ravel()), pa.array(np.tile(share, rows)), pa.array(np.full(rows * k, error))], names)

    return df.select(id_col, column).mapInArrow(run, schema)
