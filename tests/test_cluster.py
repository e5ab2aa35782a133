import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.operators import cluster


def brute_dbscan(pts, w, eps, ms):
    n = len(pts)
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    nb = d <= eps
    deg = (nb * w[None, :]).sum(1)
    core = deg >= ms
    comp = -np.ones(n, dtype=int)
    for i in range(n):
        if core[i] and comp[i] < 0:
            stack, comp[i] = [i], i
            while stack:
                j = stack.pop()
                for k in np.nonzero(nb[j] & core)[0]:
                    if comp[k] < 0:
                        comp[k] = i
                        stack.append(k)
    lab = comp.copy()
    for i in range(n):
        if not core[i]:
            c = [comp[k] for k in np.nonzero(nb[i] & core)[0]]
            lab[i] = min(c) if c else -1
    return deg, core, lab


def canon(labels):
    groups = {}
    for i, l in enumerate(labels):
        if l != -1:
            groups.setdefault(l, []).append(i)
    return sorted(tuple(g) for g in groups.values()), [i for i, l in enumerate(labels) if l == -1]


def run_dbscan(spark, pts, w, eps, ms):
    rows = [(float(x), float(y), int(ww)) for (x, y), ww in zip(pts, w)]
    df = spark.createDataFrame(rows, "x double, y double, w long")
    p = cluster.with_point_ids(df, ["x", "y"])
    out = {(r["x"], r["y"]): r for r in cluster.dbscan(p, eps, ms).collect()}
    return [out[(float(x), float(y))] for x, y in pts]


def test_dbscan_matches_bruteforce(spark):
    rng = np.random.default_rng(3)
    pts = np.round(np.concatenate([rng.normal(0, 0.3, (30, 2)), rng.normal(3, 0.3, (30, 2)),
                                   rng.uniform(-2, 5, (15, 2))]), 3)
    pts = np.unique(pts, axis=0)
    w = rng.integers(1, 4, len(pts))
    deg, core, lab = brute_dbscan(pts, w, 0.5, 6)
    got = run_dbscan(spark, pts, w, 0.5, 6)
    assert [r["degree"] for r in got] == list(deg)
    assert [r["is_core"] for r in got] == list(core)
    assert canon([r["label"] for r in got]) == canon(lab)


def test_dbscan_distance_exactly_eps_and_weights(spark):
    pts = np.array([[0.0, 0.0], [0.5, 0.0], [5.0, 5.0]])
    got = run_dbscan(spark, pts, np.array([1, 1, 3]), 0.5, 2)
    assert [r["is_core"] for r in got] == [True, True, True]
    assert got[0]["label"] == got[1]["label"] != got[2]["label"]


def test_weighted_equals_expanded(spark):
    rows = [(0.0, 0.0)] * 3 + [(0.1, 0.0)] + [(2.0, 2.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    wp = cluster.with_point_ids(cluster.weighted_points(df, ["x", "y"]), ["x", "y"])
    got = {(r["x"], r["y"]): (r["degree"], r["is_core"]) for r in cluster.dbscan(wp, 0.2, 4).collect()}
    assert got == {(0.0, 0.0): (4, True), (0.1, 0.0): (4, True), (2.0, 2.0): (1, False)}


def test_fixture_sweep(spark):
    from tripflow.queries import DBSCAN_EPS, weighted_start_points
    pts = weighted_start_points(spark, "/root/testdata/sf0.01")
    summary = cluster.dbscan_summary(cluster.dbscan_sweep(pts, DBSCAN_EPS, [900, 1100, 1150, 1200]))
    got = {r["min_samples"]: (r["clusters"], r["noise_points"], r["core_points"], r["border_points"])
           for r in summary.collect()}
    assert got == {900: (5, 0, 30, 10), 1100: (6, 8, 20, 12), 1150: (2, 34, 2, 4), 1200: (0, 40, 0, 0)}


def test_partition_count_independent(spark):
    rng = np.random.default_rng(5)
    pts = np.unique(np.round(rng.normal(0, 1, (60, 2)), 2), axis=0)
    w = np.ones(len(pts), dtype=int)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    a = canon([r["label"] for r in run_dbscan(spark, pts, w, 0.4, 3)])
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    b = canon([r["label"] for r in run_dbscan(spark, pts, w, 0.4, 3)])
    assert a == b


def test_k_distance_bruteforce(spark):
    rng = np.random.default_rng(7)
    pts = np.unique(np.round(rng.uniform(0, 10, (80, 2)), 2), axis=0)
    w = rng.integers(1, 5, len(pts))
    df = spark.createDataFrame([(float(x), float(y), int(ww)) for (x, y), ww in zip(pts, w)], "x double, y double, w long")
    k = 12
    got = {(r["x"], r["y"]): r["kdist"] for r in cluster.k_distance(cluster.with_point_ids(df, ["x", "y"]), k).collect()}
    for (x, y), _ww in zip(pts, w):
        d = np.sqrt(((pts - [x, y]) ** 2).sum(1))
        order = np.argsort(d, kind="stable")
        cum = np.cumsum(w[order])
        assert abs(got[(float(x), float(y))] - d[order][np.argmax(cum >= k)]) < 1e-12


def test_silhouette_and_dbi_bruteforce(spark):
    rng = np.random.default_rng(11)
    pts = np.concatenate([rng.normal(0, 1, (20, 2)), rng.normal(5, 1, (20, 2)), rng.normal([0, 6], 1, (20, 2))])
    lab = np.repeat([0, 1, 2], 20)
    df = spark.createDataFrame([(float(x), float(y), int(l)) for (x, y), l in zip(pts, lab)], "x double, y double, l long")
    d2 = ((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1)
    s = []
    for i in range(len(pts)):
        same = lab == lab[i]
        a = d2[i, same].sum() / (same.sum() - 1)
        b = min(d2[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    assert abs(cluster.silhouette(df, ["x", "y"], "l") - np.mean(s)) < 1e-9
    cents = np.array([pts[lab == c].mean(0) for c in range(3)])
    sc = np.array([np.sqrt(((pts[lab == c] - cents[c]) ** 2).sum(1)).mean() for c in range(3)])
    r = [max((sc[i] + sc[j]) / np.linalg.norm(cents[i] - cents[j]) for j in range(3) if j != i) for i in range(3)]
    assert abs(cluster.davies_bouldin(df, ["x", "y"], "l") - np.mean(r)) < 1e-9
    # Noise is excluded unless asked for.
    noisy = df.withColumn("l", F.when(F.col("x") > 5.5, F.lit(-1)).otherwise(F.col("l")))
    assert cluster.davies_bouldin(noisy, ["x", "y"], "l") != cluster.davies_bouldin(noisy, ["x", "y"], "l", include_noise=True)


def test_standard_scale(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    got = [r[0] for r in cluster.standard_scale(df, ["x"]).orderBy("x").collect()]
    v = np.array([1.0, 2.0, 3.0, 4.0])
    assert np.allclose(got, (v - v.mean()) / v.std())


def test_kmeans_and_top_clusters(spark):
    rng = np.random.default_rng(2)
    pts = np.concatenate([rng.normal(0, 0.1, (20, 2)), rng.normal(5, 0.1, (10, 2))])
    df = spark.createDataFrame([(float(x), float(y), 1.0) for x, y in pts], "x double, y double, w double")
    labels, centers = cluster.kmeans(df, ["x", "y"], k=2, seed=1, weight="w")
    top = cluster.top_clusters(labels, centers, n=2, weight="w").collect()
    assert [r["size"] for r in top] == [20.0, 10.0]
    assert abs(top[0]["center_x"]) < 0.2 and abs(top[1]["center_x"] - 5) < 0.2


def test_components_long_chain(spark):
    n = 40
    nodes = spark.range(n)
    edges = spark.createDataFrame([(i, i + 1) for i in range(n - 1)] + [(i + 1, i) for i in range(n - 1)], "src long, dst long")
    comps = cluster.connected_components(nodes, edges)
    assert {r["comp"] for r in comps.collect()} == {0}


def test_dense_rank_distributed(spark):
    from tripflow.plans.ranking import dense_rank_distributed
    rng = np.random.default_rng(8)
    g = rng.choice([1, 2], 500, p=[0.9, 0.1])
    v = rng.integers(0, 300, 500)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(g, v)], "g long, v long")
    got = {(r["g"], r["v"]): r["rank"] for r in dense_rank_distributed(df, ["g"], ["v"], partitions=7).collect()}
    for grp in (1, 2):
        vals = sorted(set(int(b) for a, b in zip(g, v) if a == grp))
        assert [got[(grp, x)] for x in vals] == list(range(len(vals)))


def test_sweep_settings_and_sizes(spark):
    pts = cluster.with_point_ids(spark.createDataFrame([(0.0, 0.0, 3), (0.1, 0.0, 1), (5.0, 5.0, 2), (9.0, 9.0, 1)], "x double, y double, w long"), ["x", "y"])
    lab = cluster.dbscan_sweep(pts, 0.5, [2, 4])
    summary = cluster.dbscan_summary(lab)
    assert [r["min_samples"] for r in cluster.settings_with_clusters(summary, 2).collect()] == [2]
    sizes = {(r["min_samples"], r["label"]): (r["points"], r["size"]) for r in cluster.cluster_sizes(lab).collect()}
    assert sizes == {(2, 0): (2, 4), (2, 1): (1, 2), (2, -1): (1, 1), (4, 0): (2, 4), (4, -1): (2, 3)}


def test_k_distance_with_a_stray_point(spark):
    """One point far away does not set the search radius: it stays near the others' spacing."""
    rng = np.random.default_rng(0)
    pts = np.concatenate([np.round(rng.uniform(0, 1, (400, 2)), 4), [[1000.0, 1000.0]]])
    df = spark.createDataFrame([(float(x), float(y), 1) for x, y in pts], "x double, y double, w long")
    p = cluster.with_point_ids(cluster.weighted_points(df, ["x", "y"], weight="w"), ["x", "y"])
    assert cluster.grid_radius(p, ["x", "y"]) < 1
    got = {(r["x"], r["y"]): r["kdist"] for r in cluster.k_distance(p, 5).collect()}
    for x, y in (pts[0], pts[17], pts[-1]):
        d = np.sort(np.sqrt(((np.unique(pts, axis=0) - [x, y]) ** 2).sum(1)))
        assert abs(got[(float(x), float(y))] - d[4]) < 1e-12


def test_quality_of_awkward_clusters(spark):
    def frame(rows):
        return spark.createDataFrame([(float(x), float(y), int(c)) for x, y, c in rows], "x double, y double, l long")

    same = frame([(0, 0, 0), (2, 0, 0), (1, 1, 1), (1, -1, 1)])  # one centre
    assert cluster.davies_bouldin(same, ["x", "y"], "l") == 0.0
    assert cluster.davies_bouldin(frame([(0, 0, 0), (2, 0, 0), (1, 1, 1), (1, -1, 1), (9, 0, 2)]), ["x", "y"], "l") > 0
    piled = frame([(1, 1, 0)] * 3 + [(1, 1, 1)] * 2)  # all points in one place
    assert cluster.silhouette(piled, ["x", "y"], "l") == 0.0
    assert cluster.silhouette(frame([(0, 0, 0), (1, 0, 0)]), ["x", "y"], "l") is None
    assert cluster.davies_bouldin(frame([(0, 0, 0), (1, 0, 0)]), ["x", "y"], "l") is None
    assert cluster.silhouette(frame([]), ["x", "y"], "l") is None and cluster.davies_bouldin(frame([]), ["x", "y"], "l") is None


@pytest.mark.parametrize("seed", [1, 2])
def test_quality_bruteforce_many_clusters(spark, seed):
    """Clusters of very different spreads and weights, some on one spot, against all pairs."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(40):
        at = rng.uniform(0, 10, 2) if c % 5 else np.array([3.0, 3.0])
        rows += [(*np.round(at + rng.normal(0, 10.0 ** rng.integers(-3, 1), 2), 6), c, int(rng.integers(1, 4))) for _ in range(int(rng.integers(1, 8)))]
    rows.append((500.0, 500.0, 99, 1))
    df = spark.createDataFrame([(float(x), float(y), int(c), int(w)) for x, y, c, w in rows], "x double, y double, l long, w long")
    xy, lab, w = np.array([r[:2] for r in rows], dtype=float), np.array([r[2] for r in rows]), np.array([r[3] for r in rows], dtype=float)
    d2 = ((xy[:, None] - xy[None]) ** 2).sum(-1)
    total = {c: w[lab == c].sum() for c in set(lab)}
    s = []
    for i in range(len(rows)):
        if total[lab[i]] <= 1:
            s.append(0.0)
            continue
        a = (d2[i] * w)[lab == lab[i]].sum() / (total[lab[i]] - 1)
        b = min((d2[i] * w)[lab == c].sum() / total[c] for c in total if c != lab[i])
        s.append(0.0 if max(a, b) == 0 else (b - a) / max(a, b))
    assert abs(cluster.silhouette(df, ["x", "y"], "l", weight="w") - np.average(s, weights=w)) < 1e-6
    cent = {c: np.average(xy[lab == c], axis=0, weights=w[lab == c]) for c in total}
    sc = {c: np.average(np.sqrt(((xy[lab == c] - cent[c]) ** 2).sum(1)), weights=w[lab == c]) for c in total}
    r = [max((sc[i] + sc[j]) / np.linalg.norm(cent[i] - cent[j]) if np.linalg.norm(cent[i] - cent[j]) else 0.0 for j in total if j != i) for i in total]
    assert abs(cluster.davies_bouldin(df, ["x", "y"], "l", weight="w") - np.mean(r)) < 1e-9


def test_quality_of_very_many_clusters(spark):
    """200,000 clusters of two points each: no cap, no table of clusters on the driver."""
    n = 200_000
    ids = spark.range(2 * n).selectExpr("CAST(id DIV 2 AS LONG) AS l", "id % 2 AS side")
    pts = ids.selectExpr("l", "CAST(l % 500 AS DOUBLE) AS x", "CAST(l DIV 500 AS DOUBLE) + 0.1 * side AS y")
    assert abs(cluster.davies_bouldin(pts, ["x", "y"], "l") - 0.1) < 1e-9
    assert 0.98 < cluster.silhouette(pts, ["x", "y"], "l") < 1


def test_lloyd_and_assign(spark):
    rng = np.random.default_rng(2)
    pts = np.concatenate([rng.normal(0, 0.1, (20, 2)), rng.normal(5, 0.1, (10, 2))])
    df = spark.createDataFrame([(float(x), float(y), 2) for x, y in pts], "x double, y double, w long")
    labels, centers = cluster.lloyd(df, ["x", "y"], [(1, 1), (4, 4), (100, 100)], rounds=3, weight="w")
    assert np.allclose(centers[0], pts[:20].mean(0)) and np.allclose(centers[1], pts[20:].mean(0)) and centers[2] == [100.0, 100.0]
    assert sorted(r["label"] for r in labels.collect()) == [0] * 20 + [1] * 10
    tie = spark.createDataFrame([(1.0, 0.0)], "x double, y double")
    assert cluster.assign(tie, ["x", "y"], [(0, 0), (2, 0)]).first()["label"] == 0
