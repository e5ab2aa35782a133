import numpy as np
import pandas as pd

from tripflow.operators import profile, stations


def test_exact_quantiles_linear(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)], "v double")
    got = {r["q"]: r["value"] for r in profile.exact_quantiles(df, ["v"]).collect()}
    assert got == {0.25: 3.25, 0.5: 5.5, 0.75: 7.75}


def test_exact_quantiles_grouped_with_hot_group(spark):
    rng = np.random.default_rng(1)
    g = np.where(rng.uniform(size=3000) < 0.6, "hot", rng.choice(["a", "b", "c"], 3000))
    v = np.round(rng.normal(0, 10, 3000), 1)
    pdf = pd.DataFrame({"g": g, "v": v, "u": np.round(rng.uniform(0, 5, 3000), 0)})
    df = spark.createDataFrame(pdf)
    got = {(r["g"], r["column"], r["q"]): r["value"]
           for r in profile.exact_quantiles(df, ["v", "u"], by="g", probs=(0.1, 0.5, 0.9), partitions=5).collect()}
    for (grp, col, q), val in got.items():
        assert abs(val - np.percentile(pdf.loc[pdf.g == grp, col], q * 100)) < 1e-9
    assert len(got) == 4 * 2 * 3


def test_describe_quartiles_matches_pandas(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"p": rng.choice(["2020", "2021"], 500), "x": rng.normal(0, 1, 500), "y": rng.integers(0, 9, 500)})
    out = profile.describe_quartiles(spark.createDataFrame(pdf), ["x", "y"], by="p").collect()
    for r in out:
        s = pdf.loc[pdf.p == r["p"], r["column"]].astype(float).describe()
        assert r["count"] == s["count"]
        for mine, theirs in (("mean", "mean"), ("stddev", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"),
                             ("p75", "75%"), ("max", "max")):
            assert abs(r[mine] - s[theirs]) < 1e-9


def test_null_audit_and_counts(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (None, "a", 1.0), (3, "a", None)], "a int, b string, c double")
    got = {r["column"]: (r["nulls"], r["rows"]) for r in profile.null_audit(df).collect()}
    assert got == {"a": (1, 3), "b": (1, 3), "c": (2, 3)}
    cc = {(r["column"], r["value"]): r["count"] for r in profile.category_counts(df, ["a", "b"]).collect()}
    assert cc[("b", "a")] == 2 and cc[("a", None)] == 1
    vc = [tuple(r) for r in profile.value_counts(df, "b").collect()]
    assert vc[0] == ("a", 2)


def test_corr_cov(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"x": rng.normal(size=200), "y": rng.normal(size=200), "z": rng.normal(size=200)})
    pdf.loc[5, "y"] = None
    df = spark.createDataFrame(pdf)
    got = {(r["col_a"], r["col_b"]): r["value"] for r in profile.corr_long(df, ["x", "y", "z"], lower=True).collect()}
    exp = pdf.corr()
    for (a, b), v in got.items():
        assert abs(v - exp.loc[a, b]) < 1e-9
    cov = {(r["col_a"], r["col_b"]): r["value"] for r in profile.cov_long(df, ["x", "z"]).collect()}
    assert abs(cov[("x", "z")] - pdf.cov().loc["x", "z"]) < 1e-9


def test_mean_ci(spark):
    pdf = pd.DataFrame({"k": ["a"] * 4 + ["b"] * 2, "v": [1.0, 2.0, 3.0, 4.0, 10.0, 20.0]})
    got = {(r["category"], r["level"]): r for r in profile.mean_ci(spark.createDataFrame(pdf), "v", ["k"]).collect()}
    a = got[("k", "a")]
    half = 1.959963984540054 * np.std([1, 2, 3, 4], ddof=1) / 2
    assert a["mean"] == 2.5 and abs(a["ci_low"] - (2.5 - half)) < 1e-12
    boot = {r["level"]: r for r in profile.mean_ci_bootstrap(spark.createDataFrame(pdf), "v", "k", replicates=50).collect()}
    assert boot["a"]["ci_low"] <= 2.5 <= boot["a"]["ci_high"]


def test_bootstrap_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(3)
    rows = [(i, str(i % 3), float(v)) for i, v in enumerate(rng.normal(10, 3, 300))] + [(300, None, 5.0), (301, "0", None)]
    df = spark.createDataFrame(rows, "id int, k string, v double")
    one, two = ({r["level"]: tuple(r) for r in profile.mean_ci_bootstrap(df.repartition(n), "v", "k", replicates=40).collect()} for n in (2, 7))
    assert one.keys() == two.keys() == {"0", "1", "2", None}
    for k in one:
        assert np.allclose(one[k][1:], two[k][1:]) and one[k][2] <= one[k][1] <= one[k][3]


def test_json_conformance(spark):
    docs = ['{"k": 1}', '{"k": "x"}', "{bad", '{"ref": "r"}', None, "[1,2]", "7", '{"k": null}', '[{"k": 1}]', '{"k": 2} tail']
    df = spark.createDataFrame([(d,) for d in docs], "p string")
    r = profile.json_conformance(df, "p", "k INT, ref STRING", required=["k"]).first()
    assert tuple(r[c] for c in ("rows", "nulls", "invalid", "missing_required", "valid")) == (10, 1, 6, 2, 1)
    r = profile.json_conformance(df, "p", "k INT, ref STRING").first()
    assert (r["invalid"], r["missing_required"], r["valid"]) == (6, 0, 3)


def test_preview_and_shape(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "i int, s string")
    assert [r["s"] for r in profile.preview(df, 2, ["i"]).collect()] == ["a", "b"]
    assert profile.shape(df) == (3, 2)


def test_observe_counts(spark):
    df, obs = profile.observe_counts(spark.range(7))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 7


def test_station_operators(spark):
    import datetime as dt
    rows = [(1, 10, 20, 1.0, 2.0, 3.0, 4.0, dt.datetime(2021, 1, 1, 8)),
            (2, 10, 10, 1.5, 2.5, 1.0, 2.0, dt.datetime(2021, 1, 2, 9)),
            (3, 20, 30, 3.0, 4.0, 5.0, 6.0, dt.datetime(2021, 1, 3, 10))]
    t = spark.createDataFrame(rows, "trip_id int, start_station int, end_station int, start_lat double, "
                                    "start_lon double, end_lat double, end_lon double, start_datetime timestamp_ntz")
    dim = {(r["station"], r["side"]): (r["lat"], r["lon"]) for r in stations.station_dim(t).collect()}
    assert dim[(10, "start")] == (1.0, 2.0)
    share = {r["station"]: r for r in stations.station_share(t).collect()}
    assert (share[10]["starts"], share[10]["ends"], share[10]["round_trips"], share[10]["touching"]) == (2, 1, 1, 2)
    assert abs(share[10]["share"] - 2 / 3) < 1e-12
    act = {r["station"]: r for r in stations.station_activity(t).collect()}
    assert act[10]["first_departure"] == "2021-01-01 08:00:00" and act[30]["last_arrival"] == "2021-01-03 10:00:00"
    diff = sorted(tuple(r) for r in stations.set_diff(t, "start_station", "end_station").collect())
    assert diff == [(30, "end_station")]
    assert not stations.sets_equal(t, "start_station", "end_station")


def test_quantiles_hot_value_collapses_and_a_hot_group_spreads(spark):
    import pyspark.sql.functions as F
    from tripflow.operators.profile import _sorted_values
    # 90% of rows share one value: it becomes one (value, count) row before the sort.
    df = spark.range(20000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.lit(5)).cast("double").alias("v"))
    ordered = _sorted_values(df, ["v"], [], 8)
    assert ordered.count() == 2001 and ordered.where("v = 5").first()["c"] == 18000
    # The one group's values lie in several tasks, none of which holds most of them.
    held = [r["count"] for r in ordered.groupBy("pid").count().collect()]
    assert len(held) >= 6 and max(held) < 0.4 * 2001
    got = {r["q"]: r["value"] for r in profile.exact_quantiles(df, ["v"], partitions=8).collect()}
    vals = np.array([i if i % 10 == 0 else 5 for i in range(20000)], dtype=float)
    for q, v in got.items():
        assert abs(v - np.percentile(vals, q * 100)) < 1e-9


def test_describe_keeps_groups_without_values(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 2.0, None), ("b", None, 3.0), (None, 4.0, float("nan"))], "g string, x double, y double")
    got = {(r["g"], r["column"]): r for r in profile.describe_quartiles(df, ["x", "y"], by="g").collect()}
    assert set(got) == {(g, c) for g in ("a", "b", None) for c in ("x", "y")}
    assert got[("a", "y")]["count"] == 0 and got[("a", "y")]["p50"] is None and got[("a", "x")]["p50"] == 1.5
    assert got[(None, "x")]["p50"] == 4.0 and got[(None, "y")]["count"] == 0 and got[("b", "y")]["max"] == 3.0


def test_quantile_values_are_never_shuffled_by_their_group(spark):
    from tripflow.plans.catalog import plan_text
    df = spark.createDataFrame([("a", float(i)) for i in range(50)], "g string, v double")
    text = plan_text(profile.exact_quantiles(df, ["v"], by="g", partitions=4))
    import re
    for m in re.finditer(r"Exchange\s+Input[^\n]*\n?[^\n]*hashpartitioning\(([^)]*)\)", text):
        if re.search(r"\bv#", m[0]):
            assert "pid" in m[1]


def test_corr_plan_has_no_expansion(spark):
    from tripflow.plans.catalog import plan_text
    df = spark.range(9).selectExpr("id AS a", "id * 2 AS b", "id % 3 AS c")
    text = plan_text(profile.corr_long(df, ["a", "b", "c"]))
    assert "RoundRobin" not in text and "hashpartitioning" not in text and text.count("Exchange SinglePartition") <= 2


def test_corr_of_a_hundred_columns(spark):
    """Pairwise-complete over columns with gaps, far from zero, in many tasks; NaN spoils its own pairs only."""
    rng = np.random.default_rng(6)
    data = rng.normal(1e6, 1.0, (700, 100)) + rng.normal(size=(700, 1))
    data[rng.random(data.shape) < 0.2] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in data]
    cols = [f"c{i}" for i in range(100)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(9)
    for method, want in (("corr", pd.DataFrame(data).corr()), ("covar_samp", pd.DataFrame(data).cov())):
        got = profile.corr_long(df, cols, method=method).toPandas()
        assert len(got) == 4950
        assert np.allclose(got.value, [want.iloc[int(a[1:]), int(b[1:])] for a, b in zip(got.col_a, got.col_b)], rtol=1e-6, atol=1e-9)
    odd = spark.createDataFrame([(1.0, 5.0, None, 2.0), (2.0, 5.0, 1.0, float("nan")), (3.0, 5.0, None, 4.0), (4.0, None, 2.0, 6.0)], "a double, b double, c double, d double")
    got = {(r.col_a, r.col_b): r.value for r in profile.corr_long(odd, ["a", "b", "c", "d"]).collect()}
    assert got[("a", "b")] is None and got[("b", "c")] is None and abs(got[("a", "c")] - 1) < 1e-12 and np.isnan(got[("a", "d")])
    assert {r.value for r in profile.corr_long(odd.limit(0), ["a", "b"]).collect()} == {None}


def test_moments_merge_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(profile, "FAN", 2)
    df = spark.range(1000, numPartitions=13).selectExpr("id AS a", "id * id AS b", "IF(id % 3 = 0, NULL, id % 7) AS c")
    pdf = df.toPandas().astype(float)
    for r in profile.corr_long(df, ["a", "b", "c"]).collect():
        assert abs(r.value - pdf.corr().loc[r.col_a, r.col_b]) < 1e-9


def test_bootstrap_weights_are_poisson(spark):
    """Counts in the table and beyond it: weights of the stated mean and variance, and quantiles that rise."""
    from statistics import NormalDist
    import pyspark.sql.functions as F
    us = [1e-9, 1e-4, 0.02, 0.03, 0.3, 0.5, 0.77, 0.98, 1 - 1e-6]
    got = spark.createDataFrame([(u,) for u in us], "u double").select(profile.normal_quantile(F.col("u"))).collect()
    assert all(abs(r[0] - NormalDist().inv_cdf(u)) < 1e-7 for r, u in zip(got, us))
    for c in (1, 7, 63):
        cuts = np.array(profile.poisson_cuts(c)) / 2**32
        tail = 1 - np.concatenate([[0.0], cuts])[1:]
        assert abs(tail.sum() - c) < 1e-5 * c and (np.diff(cuts) >= 0).all()
    # One value seen 10,000 times and one seen once: the mean's spread is that of the rows' bootstrap.
    df = spark.createDataFrame([("a", 0.0)] * 10_000 + [("a", 1.0)] * 10_000, "k string, v double")
    r = profile.mean_ci_bootstrap(df, "v", "k", replicates=400).first()
    half = 1.96 * 0.5 / np.sqrt(20_000)
    assert r["mean"] == 0.5 and abs((r["ci_high"] - r["ci_low"]) / (2 * half) - 1) < 0.15


def test_bootstrap_draws_every_row(spark, monkeypatch):
    """Each row has Poisson(1) weights of its own: by its key, or by its number among equal rows."""
    import hashlib
    monkeypatch.setattr(profile, "BLOCK", 4)
    rows = [(f"h{i}", "a" if i % 3 else "b", float(i % 4)) for i in range(120)] + [("h7", "a", 3.0)] * 10 + [(None, "c", 5.0), ("n", "a", None)]
    cuts, reps = profile.poisson_cuts(1), 60

    def want(name_of):
        seen, total, weight = {}, {}, {}
        for r in rows:
            if r[2] is None:
                continue
            i = seen[r] = seen.get(r, 0) + 1
            parts = [p for p in (name_of(r), str(i) if i > 1 else None, "7") if p is not None]
            for rep in range(1, reps + 1):
                draw = int(hashlib.md5("|".join([*parts, str(rep)]).encode()).hexdigest()[:8], 16)
                w = sum(draw >= c for c in cuts)
                total[r[1], rep] = total.get((r[1], rep), 0.0) + w * r[2]
                weight[r[1], rep] = weight.get((r[1], rep), 0) + w
        means = {k: [total[k, rep] / weight[k, rep] for rep in range(1, reps + 1) if weight[k, rep]] for k in "abc"}
        return {k: (np.quantile(m, 0.025), np.quantile(m, 0.975)) for k, m in means.items()}

    df = spark.createDataFrame(rows, "id string, k string, v double").repartition(5)
    got = {r["level"]: (r["ci_low"], r["ci_high"]) for r in profile.mean_ci_bootstrap(df, "v", "k", replicates=reps, key="id").collect()}
    expected = want(lambda r: r[0])
    assert got.keys() == expected.keys() and all(np.allclose(got[k], expected[k]) for k in got)
    plain = df.drop("id")
    rows = [(None, r[1], r[2]) for r in rows]
    got = {r["level"]: (r["ci_low"], r["ci_high"]) for r in profile.mean_ci_bootstrap(plain, "v", "k", replicates=reps).collect()}
    expected = want(lambda r: f"{r[1]}|{int(r[2] * 1e6)}")
    assert got.keys() == expected.keys() and all(np.allclose(got[k], expected[k]) for k in got)
