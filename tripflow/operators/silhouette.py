"""Mean silhouette with Euclidean distance, from a quadtree of weighted cells.

The sum of distances from a point to a cluster's members has no closed form.  Here a cluster's
members in a far cell are taken as a whole: by their weight, centre and second moments, and for all
points of a target cell at once, by the expansion of the distance to second order around the two
centres.  For a target cell and a source cell with radii that add up to R and centres D apart, the
remainder is at most 0.1925 * R**3 / (D - R)**2 a member: the third derivative of |x| along any unit
vector is 3 * sin(t)**2 * cos(t) / |x|**2, at most 2 / sqrt(3) / |x|**2, and a sixth of that is the
factor.  A pair of cells is settled when that is at most ``tolerance * (D - R)``; every distance in it
is at least D - R, so each mean distance has a relative error of at most ``tolerance`` and a
silhouette, (b - a) / max(a, b), one of at most ``2 * tolerance / (1 - tolerance)``.  Other pairs are
opened, and the points of near leaves are compared one by one, exactly.

A cell meets a number of others that depends on the tolerance alone, so the work follows points
times clusters.  No task and no driver holds a cluster; a point with weight w counts as w points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.operators import quadtree
from tripflow.plans.sizing import stored
from tripflow.sources.sinks import remove_path

FACTOR = 0.1925


def _expansion(pairs: DataFrame) -> DataFrame:
    """Per settled pair: what the source adds to the target cell's sum of distances, as a value, a slope
    and a curvature at the cell's centre."""
    w, d = F.col("bw"), F.col("d")
    ux, uy = (F.col("ax") - F.col("bx")) / d, (F.col("ay") - F.col("by")) / d
    turn = (F.col("sxx") * uy * uy - 2 * F.col("sxy") * ux * uy + F.col("syy") * ux * ux) / d
    return pairs.select("a", "l", (w * d + turn / 2).alias("f"), (w * ux).alias("gx"), (w * uy).alias("gy"),
                        (w * uy * uy / d).alias("hxx"), (-w * ux * uy / d).alias("hxy"), (w * ux * ux / d).alias("hyy"))


def distance_sums(points: DataFrame, tolerance: float, leaf: int = quadtree.LEAF) -> tuple[DataFrame, DataFrame]:
    """(id, l, s): the summed distance from every point of ``points`` (id, x, y, l, w) to every label's;
    and (kind, n): how many pairs of cells, and of points, that took."""
    tree = quadtree.build(points.select("id", "x", "y"), leaf=leaf)
    targets, t_path = stored(tree.cells.select(F.col("cell").alias("a"), ((F.col("x0") + F.col("x1")) / 2).alias("ax"), ((F.col("y0") + F.col("y1")) / 2).alias("ay"),
                                               (F.sqrt(F.pow(F.col("x1") - F.col("x0"), 2) + F.pow(F.col("y1") - F.col("y0"), 2)) / 2).alias("ar")), "targets")
    held = tree.places.join(points.select("id", "x", "y", "l", "w"), "id")
    nodes = held.groupBy(F.col("cell").alias("b"), "l").agg(
        F.sum("w").alias("bw"), (F.sum(F.col("w") * F.col("x")) / F.sum("w")).alias("bx"), (F.sum(F.col("w") * F.col("y")) / F.sum("w")).alias("by"),
        *[f(c).alias(f"{c}{i}") for c in "xy" for i, f in enumerate((F.min, F.max))])
    nodes, n_path = stored(nodes, "nodes")
    off = {c: F.col(c) - F.col(f"b{c}") for c in "xy"}
    spread = (held.join(nodes.select(F.col("b").alias("cell"), "l", "bx", "by"), ["cell", "l"]).groupBy(F.col("cell").alias("b"), "l")
              .agg(*[F.sum(F.col("w") * off[p] * off[q]).alias(f"s{p}{q}") for p, q in ("xx", "xy", "yy")]))
    reach = [F.greatest(F.col(f"b{c}") - F.col(f"{c}0"), F.col(f"{c}1") - F.col(f"b{c}")) for c in "xy"]
    radius = F.sqrt(reach[0] * reach[0] + reach[1] * reach[1])
    sources, s_path = stored(nodes.join(spread, ["b", "l"]).select("b", "l", "bw", "bx", "by", "sxx", "sxy", "syy", radius.alias("br")), "sources")
    d = F.sqrt(F.pow(F.col("ax") - F.col("bx"), 2) + F.pow(F.col("ay") - F.col("by"), 2))
    r = F.col("ar") + F.col("br")
    far = (d > r) & (F.lit(FACTOR) * F.pow(r, 3) <= F.lit(tolerance) * F.pow(d - r, 3))
    root = tree.cells.filter("cell.level = 0").select(F.col("cell").alias("a"))
    start = root.crossJoin(sources.filter("b.level = 0").select("b", "l"))  # one root: a row per label
    whole, leaves, paths = quadtree.walk(tree, start, targets, sources, F.when(far, "whole").otherwise("open"),
                                         lambda m: _expansion(m.withColumn("d", d)), ("l",))
    fields, f_path = stored(whole.groupBy("a", "l").agg(*[F.sum(c).alias(c) for c in ("f", "gx", "gy", "hxx", "hxy", "hyy")]), "fields")
    # What a cell has gathered holds for all points below it.
    below = tree.places.select("id", F.col("cell").alias("a")).join(fields, "a").join(targets.select("a", "ax", "ay"), "a").join(points.select("id", "x", "y"), "id")
    tx, ty = F.col("x") - F.col("ax"), F.col("y") - F.col("ay")
    value = F.col("f") + F.col("gx") * tx + F.col("gy") * ty + (F.col("hxx") * tx * tx + 2 * F.col("hxy") * tx * ty + F.col("hyy") * ty * ty) / 2
    at = tree.places.filter("leaf").join(points, "id")
    mine = at.select(F.col("cell").alias("a"), "id", "x", "y")
    theirs = at.select(F.col("cell").alias("b"), "l", F.col("x").alias("qx"), F.col("y").alias("qy"), "w")
    near = leaves.join(mine, "a").join(theirs, ["b", "l"])
    one = F.col("w") * F.sqrt(F.pow(F.col("x") - F.col("qx"), 2) + F.pow(F.col("y") - F.col("qy"), 2))
    parts = below.select("id", "l", value.alias("s"), F.lit(0).alias("p")).unionByName(near.select("id", "l", one.alias("s"), F.lit(1).alias("p")))
    sums, _ = stored(parts.groupBy("id", "l").agg(F.sum("s").alias("s"), F.sum("p").alias("p"), F.count_if(F.col("p") == 0).alias("c")), "distance-sums")
    for p in [t_path, n_path, s_path, f_path, *paths]:
        remove_path(points.sparkSession, p)
    tree.forget()
    return sums.select("id", "l", "s"), sums.agg(F.sum("p").alias("points"), F.sum("c").alias("cells"))


def silhouette_euclidean_df(df: DataFrame, x: str, y: str, label: str, weight: str | None = None, tolerance: float = 1e-2) -> DataFrame:
    """One row (silhouette): the weighted mean of (b - a) / max(a, b), a being the mean distance to the
    point's own cluster without itself, b the least mean distance to another one.

    Rows with a null are left out.  A point whose cluster has weight 1, or whose distances are all 0,
    scores 0; with fewer than two clusters the result is NULL.  See the module for the error bound."""
    w = F.sum(F.col(weight).cast("double")) if weight else F.count(F.lit(1)).cast("double")
    named = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), F.col(label).alias("l"), *([F.col(weight)] if weight else [])).dropna()
    points, path = stored(named.groupBy("x", "y", "l").agg(w.alias("w")).withColumn("id", F.monotonically_increasing_id()), "silhouette-points")
    size = points.groupBy("l").agg(F.sum("w").alias("total"))
    if size.limit(2).count() < 2:
        return size.agg(F.max(F.lit(None).cast("double")).alias("silhouette"))
    sums, _ = distance_sums(points, tolerance)
    each = sums.join(size, "l").join(points.select("id", F.col("l").alias("own"), "w"), "id")
    same = F.col("l") == F.col("own")
    per = each.groupBy("id").agg(F.any_value("w").alias("w"), F.max(F.when(same, F.col("total"))).alias("own"),
                                 F.max(F.when(same & (F.col("total") > 1), F.col("s") / (F.col("total") - 1))).alias("a"),
                                 F.min(F.when(~same, F.col("s") / F.col("total"))).alias("b"))
    top = F.greatest("a", "b")
    score = F.when((F.col("own") <= 1) | (top <= 0), F.lit(0.0)).otherwise((F.col("b") - F.col("a")) / F.nullif(top, F.lit(0.0)))
    return per.agg((F.sum(F.col("w") * score) / F.sum("w")).alias("silhouette"))
