"""Connected components of an edge table, by alternating large-star and small-star rounds.

Every round is a few shuffles with map-side minima, ends in a table in the shared folder, and
replaces the one before it, which is removed.  Rounds go on until one changes nothing; their number
grows with the logarithm of the longest chain.

Hot vertices are split: a vertex on more than one in ``HOT`` of all edge ends (so at most ``HOT``
vertices, whatever the data) gets its minimum by a broadcast of that bounded table, so its edges
stay spread over the tasks that hold them; only the edges of all other vertices meet in a shuffle.
Minima themselves are formed map-side first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.plans.sizing import stored
from tripflow.sources.sinks import remove_path

#: A vertex is hot beyond one in so many edge ends; no fewer than ``COLD`` of them.
HOT, COLD = 500, 64
#: Edges that one file of a round's table holds, so that a small graph does not cost a file per task.
FILE_ROWS = 50_000


def with_low(rows: DataFrame, low: DataFrame, keys: Sequence[str], ends: int) -> DataFrame:
    """``rows`` (keys..., a, b) with the ``low`` of their vertex a; ``low`` has (keys..., a, low, n),
    n being how many of all ``ends`` the vertex has."""
    by = [*keys, "a"]
    hot = F.col("n") > max(COLD, ends // HOT)
    marked = rows.join(F.broadcast(low.filter(hot).select(*by, F.col("low").alias("hot_low"))), by, "left")
    cold = marked.filter("hot_low IS NULL").select(*by, "b").join(low.filter(~hot).select(*by, "low"), by)
    return marked.filter("hot_low IS NOT NULL").select(*by, "b", F.col("hot_low").alias("low")).unionByName(cold)


def _star(edges: DataFrame, keys: Sequence[str], large: bool, n: int) -> DataFrame:
    """Link each vertex's larger neighbours (or, small star, its smaller ones and itself) to the smallest."""
    k = list(keys)
    near = edges.unionByName(edges.select(*k, F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    low = near.groupBy(*k, "a").agg(F.least(F.min("b"), F.col("a")).alias("low"), F.count(F.lit(1)).alias("n"))
    if large:
        return with_low(near.filter("b > a"), low, k, 2 * n).select(*k, F.col("b").alias("a"), F.col("low").alias("b"))
    linked = with_low(edges, low, k, n).filter("b <> low").select(*k, F.col("b").alias("a"), F.col("low").alias("b"))
    return linked.unionByName(low.select(*k, "a", F.col("low").alias("b")))


def components(edges: DataFrame, a: str = "a", b: str = "b", keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., node, root) of every node with an edge to another one; root is the smallest node
    that it reaches under the same ``keys``.  An edge with a null end links nothing."""
    k, spark = list(keys), edges.sparkSession
    e = edges.select(*k, F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    e, path = stored(e, "edges")

    def state(t: DataFrame):
        return t.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*k, "a", "b").cast("decimal(38,0)")).alias("s")).first()

    old = state(e)
    # Done when every vertex points at one root that points nowhere: a star forest is a fixed point.
    while old["n"]:
        files = 1 + old["n"] // FILE_ROWS
        mid, mid_path = stored(_star(e, k, True, old["n"]).distinct().coalesce(files), "edges")
        # A large star has no more edges than there were: the bound on hot vertices holds.
        nxt, nxt_path = stored(_star(mid, k, False, old["n"]).distinct().coalesce(files), "edges")
        new = state(nxt)
        remove_path(spark, path)
        remove_path(spark, mid_path)
        e, path, done, old = nxt, nxt_path, old == new, new
        if done:
            break
    roots = e.select(*k, F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(e.select(*k, F.col("b").alias("node"), F.col("b").alias("root")).distinct())
