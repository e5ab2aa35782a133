"""Walks over quadtrees: neighbour counts and distance sums, their error and their work."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.operators import cluster, quadtree
from tripflow.operators import silhouette as S


def frame(spark, x, y, **more):
    rows = list(zip(range(len(x)), x.tolist(), y.tolist(), *[v.tolist() for v in more.values()]))
    return spark.createDataFrame(rows, ["id", "x", "y", *more])


def disc(rng, n, radius):
    r, t = radius * np.sqrt(rng.random(n)), rng.random(n) * 2 * np.pi
    return r * np.cos(t), r * np.sin(t)


def test_tree_holds_every_point_in_one_leaf(spark):
    rng = np.random.default_rng(1)
    x, y = np.concatenate([rng.random(400), 0.5 + rng.random(300) * 1e-3]), np.concatenate([rng.random(400), np.full(300, 0.25)])
    tree = quadtree.build(frame(spark, x, y).select("id", "x", "y"), leaf=8)
    leaves = tree.places.filter("leaf").groupBy("cell").count()
    assert tree.places.filter("leaf").select("id").distinct().count() == leaves.agg(F.sum("count")).first()[0] == 700
    assert leaves.agg(F.max("count")).first()[0] <= 8
    assert tree.cells.filter("leaf").count() == leaves.count()


@pytest.mark.parametrize("n, radius, share", [(100_000, 0.5, 0.002), (20_000, 1.0, 0.25)])
def test_dense_circle_is_counted_without_its_pairs(spark, n, radius, share):
    """100,000 points in one circle of diameter eps, and 20,000 in one of radius eps: the pairs that are
    compared are counted, and bounded by a small share of all pairs."""
    x, y = disc(np.random.default_rng(2), n, radius)
    near = cluster._Neighbours(frame(spark, x, y, w=np.ones(n, dtype=np.int64)), 1.0)
    met = {}
    walk = quadtree.walk

    def counted(tree, *a, **b):
        out = walk(tree, *a, **b)
        size = tree.cells.select("cell", "n")
        pairs = out[1].join(size.withColumnsRenamed({"cell": "a", "n": "na"}), "a").join(size.withColumnsRenamed({"cell": "b", "n": "nb"}), "b")
        met["pairs"] = pairs.agg(F.sum(F.col("na") * F.col("nb"))).first()[0] or 0
        return out

    quadtree.walk = counted
    try:
        degrees = near.degrees()
        some = {r["id"]: r["degree"] for r in degrees.filter("id % 997 = 0").collect()}
    finally:
        quadtree.walk = walk
    assert met["pairs"] <= share * n * n
    for i, d in some.items():
        assert d == int((np.sqrt((x - x[i]) ** 2 + (y - y[i]) ** 2) <= 1.0).sum())


def sums(x, y, label, w):
    out = np.zeros((len(x), label.max() + 1))
    for i in range(0, len(x), 500):
        d = np.sqrt((x[i:i + 500, None] - x) ** 2 + (y[i:i + 500, None] - y) ** 2) * w
        for c in range(out.shape[1]):
            out[i:i + 500, c] = d[:, label == c].sum(axis=1)
    return out


def points_of(rng, n):
    label = rng.integers(0, 3, n)
    return rng.normal(label * 2.0, 1.0), rng.normal(0, 1.0, n), label, rng.integers(1, 4, n).astype(float)


def test_distance_sums_keep_their_bound_and_work_grows_with_points(spark):
    rng, work = np.random.default_rng(3), {}
    for n in (5_000, 20_000):
        x, y, label, w = points_of(rng, n)
        d = frame(spark, x, y, l=label, w=w)
        made, met = S.distance_sums(d, 1e-2)
        got = made.toPandas().pivot(index="id", columns="l", values="s").to_numpy()
        assert np.abs(got / sums(x, y, label, w) - 1).max() <= 1e-2
        row = met.first()
        work[n] = row["points"] + row["cells"]
    assert work[20_000] <= 6 * work[5_000] and work[20_000] < 0.05 * 20_000**2


def test_silhouette_is_the_mean_euclidean_one(spark):
    x, y, label, w = points_of(np.random.default_rng(4), 300)
    label[0], w[0] = 3, 1.0  # a cluster of weight 1 scores 0
    exact = sums(x, y, label, w)
    total = np.array([w[label == c].sum() for c in range(4)])
    own = np.arange(300), label
    a = exact[own] / np.maximum(total[label] - 1, 1)
    other = exact / total
    other[own] = np.inf
    b = other.min(axis=1)
    score = np.where(total[label] <= 1, 0.0, (b - a) / np.maximum(a, b))
    d = frame(spark, x, y, l=label, w=w)
    got = S.silhouette_euclidean_df(d, "x", "y", "l", "w", tolerance=1e-9).first()[0]
    assert abs(got - (score * w).sum() / w.sum()) < 1e-9
    one = S.silhouette_euclidean_df(d.filter("l = 1"), "x", "y", "l").first()[0]
    assert one is None and S.silhouette_euclidean_df(d.limit(0), "x", "y", "l").first()[0] is None
