"""Components: against union-find, long chains, and hot vertices whose edges stay spread."""

import random

import pytest
from pyspark.sql import functions as F

from tripflow.operators import components as C


def roots(edges):
    up = {n: n for e in edges for n in e}

    def find(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in up}


def got(frame):
    return {r.node: r.root for r in frame.collect()}


def test_against_union_find(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)]
    edges += [(rnd.randint(2000, 2600), rnd.randint(2000, 2600)) for _ in range(300)]
    frame = spark.createDataFrame([*edges, (5, 5), (None, 3), (9000, 9000)], "a long, b long").repartition(5)
    assert got(C.components(frame)) == roots([e for e in edges if e[0] != e[1]])
    assert got(C.components(spark.createDataFrame([], "a long, b long"))) == {}


def test_keys_part_the_graphs(spark):
    frame = spark.createDataFrame([(1, 10, 11), (1, 11, 12), (2, 11, 12)], "k int, a long, b long")
    rows = {(r.k, r.node): r.root for r in C.components(frame, keys=["k"]).collect()}
    assert rows == {(1, 10): 10, (1, 11): 10, (1, 12): 10, (2, 11): 11, (2, 12): 11}


@pytest.mark.parametrize("hub", [0, 10**7])
def test_star_stays_spread(spark, hub):
    """500,000 leaves at one vertex: the rows that get its minimum are in all tasks, a tenth at most in one."""
    leaves = 500_000
    edges = spark.range(1, leaves + 1, numPartitions=16).select(F.greatest("id", F.lit(hub)).alias("a"), F.least("id", F.lit(hub)).alias("b"))
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"), F.count(F.lit(1)).alias("n"))
    rows = C.with_low(both, low, [], 2 * leaves)
    tasks = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    # Leaves of the hub are single ends of the shuffle; the hub's own half million never meet in it.
    assert sum(tasks) == 2 * leaves and max(tasks) <= 0.1 * sum(tasks)
    out = C.components(edges)
    assert out.groupBy("root").count().collect()[0]["count"] == leaves + 1


def test_chain_takes_logarithmic_rounds(spark, monkeypatch):
    n, rounds = 100_000, []
    star = C._star
    monkeypatch.setattr(C, "_star", lambda *a: rounds.append(a[2]) or star(*a))
    order = F.xxhash64("id") % 7  # the chain's rows in no order
    edges = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).repartition(8, order)
    out = C.components(edges)
    assert out.filter("root <> 0").count() == 0 and out.count() == n + 1
    assert len(rounds) // 2 <= 2 * 17
