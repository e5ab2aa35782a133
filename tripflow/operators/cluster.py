"""Spatial clustering and cluster quality, as distributed DataFrame jobs.

Trips repeat station coordinates, so every operator first collapses rows to *distinct
weighted points* (partial aggregation before the shuffle).  Neighbourhoods come from a grid
equi-join (each point meets the 3x3 cells around it) - never a cartesian product.  Iterative
steps (connected components, searches with a growing radius) cut lineage with reliable
``checkpoint()`` into the session's checkpoint folder and end by their own stop condition.

* ``standard_scale``: (x - mean) / population sd, all statistics from one aggregation.
* ``dbscan`` / ``dbscan_sweep``: DBSCAN (Euclidean, ``<= eps``, ``min_samples`` counts the point
  itself and weights) over cells whose points are all neighbours, cut into quadtrees; one table of
  thresholds serves every ``min_samples`` of a sweep.
* ``k_distance``: exact weighted k-th neighbour distance by growing the search radius only
  for points not yet resolved; the first radius comes from cell counts.
* ``davies_bouldin``, ``silhouette`` (squared Euclidean): exact, from per-cluster sums that stay
  distributed; the nearest other cluster and the worst partner come from growing searches.
* ``lloyd`` (k-means rounds from given centres), ``assign``, ``kmeans`` (``pyspark.ml``),
  ``top_clusters``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripflow.operators import quadtree
from tripflow.operators.components import components
from tripflow.plans.ranking import dense_rank_distributed
from tripflow.plans.sizing import stored
from tripflow.session import ensure_checkpoint_dir
from tripflow.sources.sinks import remove_path

#: A search grid is made finer until a point shares its cell with so many others on average.
CELL_SHARE = 16.0


def _checkpoint(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# --------------------------------------------------------------------------------------
# points
# --------------------------------------------------------------------------------------

def weighted_points(df: DataFrame, cols: Sequence[str], weight: str | None = None,
                    dropna: bool = True) -> DataFrame:
    """Distinct coordinate tuples with their multiplicity (or summed ``weight``) as ``w``."""
    src = df.dropna(subset=list(cols)) if dropna else df
    w = F.sum(weight) if weight else F.count(F.lit(1))
    return src.groupBy(*cols).agg(w.alias("w"))


def with_point_ids(points: DataFrame, cols: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Add a stable ``id`` increasing with the lexicographic order of ``cols`` (range
    partition + sort + monotonically increasing id), checkpointed so it never changes."""
    n = partitions or int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = points.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    return _checkpoint(ordered.withColumn("id", F.monotonically_increasing_id()))


def standard_scale(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """Zero mean, unit *population* sd per column; one aggregation gives all statistics.  A column
    without spread gives NULL."""
    stats = df.agg(F.struct(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(cols)
                              for n, f in (("m", F.avg), ("s", F.stddev_pop))]).alias("__stats"))
    st = stats.scalar()  # one and the same subquery for all columns
    return df.withColumns({c + suffix: (F.col(c).cast("double") - st[f"m{i}"]) / F.nullif(st[f"s{i}"], F.lit(0.0)) for i, c in enumerate(cols)})


# --------------------------------------------------------------------------------------
# eps neighbourhoods and DBSCAN
# --------------------------------------------------------------------------------------

def _cells(x: Column, y: Column, size: float):
    return F.floor(x / F.lit(size)).cast("long"), F.floor(y / F.lit(size)).cast("long")


def connected_components(nodes: DataFrame, edges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., id, comp) of every node (keys..., id): comp is the smallest id that it reaches over
    the ``edges`` (keys..., src, dst); a node without an edge is its own."""
    k = list(keys)
    linked = components(edges, "src", "dst", k).withColumnsRenamed({"node": "id", "root": "comp"})
    return nodes.select(*k, "id").join(linked, [*k, "id"], "left").select(*k, "id", F.coalesce("comp", "id").alias("comp"))


def dbscan_sweep(points: DataFrame, eps: float, min_samples: Sequence[int], x: str = "x", y: str = "y") -> DataFrame:
    """DBSCAN for several ``min_samples`` at once over weighted distinct points.

    ``points``: (x, y, w, id).  Output per (min_samples, point): x, y, w, degree, is_core,
    label (clusters numbered 0.. by their smallest core member in (x, y) order; noise = -1).
    A border point joins the smallest-numbered cluster among its core neighbours.

    Cells have the side eps / sqrt(2): points of one cell are neighbours of one another, without a
    pair.  Cells are cut into a quadtree, and the trees of neighbouring cells are walked twice.  A pair
    of subcells wholly within eps counts whole, one wholly beyond is dropped, and only leaves at the rim
    are compared point by point: first for degrees, then for the largest degree that a cell's points
    reach in another cell.  A setting m links two cells if some pair in reach has both degrees at m or
    above; so one table of thresholds serves all settings, and the components are those of cells, not of
    points.  A pair of cells linked for every setting is not opened further where all points are core.
    """
    pts, pts_path = stored(points.select("id", F.col(x).alias("x"), F.col(y).alias("y"), "w"), "dbscan-points")
    near = _Neighbours(pts, eps)
    pts, degree_path = stored(near.degrees(), "dbscan-degrees")
    low, high = int(min(min_samples)), int(max(min_samples))
    links, seen, paths = near.thresholds(pts, low, high)
    settings = F.explode(F.array(*[F.lit(int(m)).cast("long") for m in min_samples])).alias("ms")
    best = pts.groupBy("cell").agg(F.max("degree").alias("top"))
    core_cells = best.select("cell", "top", settings).where("top >= ms").select("ms", F.col("cell").alias("id"))
    edges = links.select("cell_a", "cell_b", "top", settings).where("top >= ms").select("ms", F.col("cell_a").alias("src"), F.col("cell_b").alias("dst"))
    comps = connected_components(core_cells, edges, ["ms"]).withColumnRenamed("id", "cell")
    nodes = pts.select("id", F.col("x").alias(x), F.col("y").alias(y), "w", "cell", "degree", settings).withColumn("is_core", F.col("degree") >= F.col("ms"))
    core = nodes.where("is_core").select("ms", "id", "cell").join(comps, ["ms", "cell"])
    low_id, low_path = stored(core.groupBy("ms", "comp").agg(F.min("id").alias("low")), "dbscan-lows")
    comps, comps_path = stored(comps.join(low_id, ["ms", "comp"]).select("ms", "cell", "low"), "dbscan-cells")
    border = (seen.select("id", F.col("cell_b").alias("cell"), "degree", "top", settings).where("degree < ms AND ms <= top")
              .join(comps, ["ms", "cell"]).groupBy("ms", "id").agg(F.min("low").alias("low")))
    member = nodes.where("is_core").select("ms", "id", "cell").join(comps, ["ms", "cell"]).select("ms", "id", "low").unionByName(border)
    # Number clusters 0.. per setting by their smallest core member (a table of one row per cluster).
    ranks = dense_rank_distributed(low_id.select("ms", "low"), ["ms"], ["low"], "label")
    labelled = member.join(ranks, ["ms", "low"]).select("ms", "id", "label")
    out = nodes.join(labelled, ["ms", "id"], "left").withColumn("label", F.coalesce("label", F.lit(-1).cast("long")))
    out, _ = stored(out.select(F.col("ms").alias("min_samples"), "id", x, y, "w", "degree", "is_core", "label"), "dbscan")
    near.forget()
    for p in (pts_path, degree_path, low_path, comps_path, *paths):
        remove_path(points.sparkSession, p)
    return out


class _Neighbours:
    """Points (id, x, y, w) and who of them is within ``eps``, by cells of side eps / sqrt(2) and their
    quadtrees."""

    def __init__(self, pts: DataFrame, eps: float, leaf: int = quadtree.LEAF) -> None:
        self.pts, self.eps = pts, eps
        self.tree = quadtree.build(pts.select("id", "x", "y"), side=eps / 2**0.5 * (1 - 1e-12), leaf=leaf)
        self.boxes, path = stored(self.tree.cells.select("cell", "top", *[f"{c}{i}" for c in "xy" for i in (0, 1)]), "boxes")
        self.paths = [path]
        tops = self.tree.cells.filter("cell.level = 0").select(F.col("cell").alias("b"))
        around = F.explode(F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in range(-2, 3) for j in range(-2, 3) if (i, j) != (0, 0)]))
        a = tops.select(F.col("b").alias("a"), around.alias("o"))
        a = a.select("a", F.struct(F.col("a.level").alias("level"), (F.col("a.cx") + F.col("o.dx")).alias("cx"), (F.col("a.cy") + F.col("o.dy")).alias("cy")).alias("b"))
        self.start = a.join(tops, "b")

    def forget(self) -> None:
        for p in self.paths:
            remove_path(self.pts.sparkSession, p)
        self.tree.forget()

    def _side(self, name: str, values: DataFrame) -> DataFrame:
        """The cells with their boxes and ``values`` (cell, ...), all named for one side of a pair."""
        d = self.boxes.join(values, "cell")
        return d.select(F.col("cell").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in d.columns if c != "cell"])

    def _verdict(self, also_drop=None):
        drop = quadtree.box_gap("a_", "b_") > F.lit(self.eps)
        drop = drop if also_drop is None else drop | also_drop
        return F.when(drop, "drop").when(quadtree.box_span("a_", "b_") <= F.lit(self.eps), "whole").otherwise("open")

    def _rim(self, leaves: DataFrame, held: DataFrame, *value: str) -> DataFrame:
        """Pairs of the leaves' points within eps; the columns of ``held`` (cell, id, x, y, value...)
        as ``*_a`` and ``*_b``."""
        a, b = [held.select(*[F.col(c).alias(n if c == "cell" else f"{c}_{n}") for c in ("cell", "id", "x", "y", *value)]) for n in "ab"]
        d = F.sqrt(F.pow(F.col("x_a") - F.col("x_b"), 2) + F.pow(F.col("y_a") - F.col("y_b"), 2))
        return leaves.join(a, "a").join(b, "b").where(d <= F.lit(self.eps))

    def degrees(self) -> DataFrame:
        """(id, x, y, w, cell, degree): the weight within eps of every point, itself included; cell is its
        cell of level 0."""
        held = self.tree.places.join(self.pts, "id")
        weight = held.groupBy("cell").agg(F.sum("w").alias("w"))
        weight, path = stored(weight, "cell-weights")
        whole, leaves, paths = quadtree.walk(self.tree, self.start, self._side("a", weight), self._side("b", weight), self._verdict(),
                                             lambda m: m.select("a", F.col("b_w").alias("w")))
        self.paths += [path, *paths]
        whole = whole.groupBy(F.col("a").alias("cell")).agg(F.sum("w").alias("n"))
        far = self.tree.places.select("id", "cell").join(whole, "cell").select("id", "n")
        rim = self._rim(leaves, held.filter("leaf"), "w").select(F.col("id_a").alias("id"), F.col("w_b").alias("n"))
        other = far.unionByName(rim).groupBy("id").agg(F.sum("n").alias("n"))
        own = self.tree.places.filter("cell.level = 0").select("id", "cell").join(weight.select("cell", F.col("w").alias("own")), "cell")
        d = self.pts.join(own, "id").join(other, "id", "left")
        return d.select("id", "x", "y", "w", "cell", (F.col("own") + F.coalesce("n", F.lit(0))).alias("degree"))

    def thresholds(self, pts: DataFrame, low: int, high: int) -> tuple[DataFrame, DataFrame, list[str]]:
        """(cell_a, cell_b, top): up to which degree two cells are linked; (id, degree, cell_b, top): up to
        which degree a point of a degree below ``high`` sees core points in a cell, its own included; and
        the tables that these read.  Cells without a degree of ``low`` are not looked at."""
        held = self.tree.places.join(pts.select("id", "x", "y", "degree", F.col("cell").alias("top")), "id")
        tops, path = stored(held.groupBy("cell").agg(F.max("degree").alias("most"), F.min("degree").alias("least")), "cell-degrees")
        both = lambda m: m.select("a", F.col("a_top").alias("cell_a"), F.col("b_top").alias("cell_b"), F.col("a_most").alias("most_a"), F.col("b_most").alias("most_b"))
        name = self.boxes.select("cell", "top")

        def prune(still: DataFrame, whole: DataFrame) -> DataFrame:
            linked = whole.filter(F.least("most_a", "most_b") >= high).select(F.col("cell_a").alias("a_top"), F.col("cell_b").alias("b_top")).distinct().withColumn("linked", F.lit(True))
            sure = tops.select(F.col("cell").alias("a"), (F.col("least") >= high).alias("sure"))
            d = still.join(name.withColumnsRenamed({"cell": "a", "top": "a_top"}), "a").join(name.withColumnsRenamed({"cell": "b", "top": "b_top"}), "b")
            d = d.join(sure, "a").join(linked, ["a_top", "b_top"], "left")
            return d.filter("NOT (sure AND coalesce(linked, false))").select(*still.columns)

        whole, leaves, paths = quadtree.walk(self.tree, self.start, self._side("a", tops), self._side("b", tops), self._verdict(F.col("b_most") < low), both, prune=prune)
        rim, rim_path = stored(self._rim(leaves, held.filter("leaf"), "degree", "top").groupBy("id_a", "degree_a", "top_a", "top_b").agg(F.max("degree_b").alias("top")), "rim")
        links = whole.select("cell_a", "cell_b", F.least("most_a", "most_b").alias("top")).unionByName(
            rim.select(F.col("top_a").alias("cell_a"), F.col("top_b").alias("cell_b"), F.least("degree_a", "top").alias("top")))
        links, links_path = stored(links.groupBy("cell_a", "cell_b").agg(F.max("top").alias("top")), "cell-links")
        weak = held.filter(F.col("degree") < high).select("id", "degree", "cell", F.col("top").alias("own"))
        seen = weak.join(whole.select(F.col("a").alias("cell"), "cell_b", F.col("most_b").alias("top")), "cell").select("id", "degree", "cell_b", "top")
        seen = seen.unionByName(rim.filter(F.col("degree_a") < high).select(F.col("id_a").alias("id"), F.col("degree_a").alias("degree"), F.col("top_b").alias("cell_b"), "top"))
        own = weak.filter("cell.level = 0").join(tops, "cell").select("id", "degree", F.col("cell").alias("cell_b"), F.col("most").alias("top"))
        seen, seen_path = stored(seen.unionByName(own).groupBy("id", "degree", "cell_b").agg(F.max("top").alias("top")), "seen")
        for p in (path, rim_path, *paths):
            remove_path(pts.sparkSession, p)
        return links, seen, [links_path, seen_path]


def dbscan(points: DataFrame, eps: float, min_samples: int, x: str = "x", y: str = "y") -> DataFrame:
    """DBSCAN for one setting (see ``dbscan_sweep``)."""
    return dbscan_sweep(points, eps, [min_samples], x, y).drop("min_samples")


def dbscan_summary(labels: DataFrame, by: Sequence[str] = ("min_samples",)) -> DataFrame:
    """Per setting: clusters, noise / core / border distinct points, noise weight."""
    noise = F.col("label") == -1
    return labels.groupBy(*by).agg(
        F.count_distinct(F.when(~noise, F.col("label"))).alias("clusters"),
        F.count_if(noise).alias("noise_points"),
        F.count_if(F.col("is_core")).alias("core_points"),
        F.count_if(~noise & ~F.col("is_core")).alias("border_points"),
        F.coalesce(F.sum(F.when(noise, F.col("w"))), F.lit(0)).alias("noise_weight"))


def cluster_sizes(labels: DataFrame, by: Sequence[str] = ("min_samples",), label: str = "label") -> DataFrame:
    """Distinct points and weight of every cluster of every setting (noise is cluster -1)."""
    return labels.groupBy(*by, label).agg(F.count(F.lit(1)).alias("points"), F.sum("w").alias("size"))


def settings_with_clusters(summary: DataFrame, clusters: int) -> DataFrame:
    """Sweep settings (rows of ``dbscan_summary``) that produced exactly ``clusters`` clusters."""
    return summary.where(F.col("clusters") == clusters)


# --------------------------------------------------------------------------------------
# k-distance
# --------------------------------------------------------------------------------------

def grid_radius(points: DataFrame, cols: Sequence[str], share: float = CELL_SHARE) -> float:
    """A cell side at which a point shares its cell with at most ``share`` points on average.

    Starts from the extent and looks at cell counts (one small aggregation a step), so one stray
    point far away does not set the scale.  Equal points cannot be parted; the side then ends at
    the resolution of the coordinates."""
    b = points.agg(F.count(F.lit(1)), *[F.max(c) - F.min(c) for c in cols]).first()
    extent = max([float(x or 0.0) for x in b[1:]])
    if not b[0] or extent <= 0:
        return 1.0
    r = extent / max(1.0, float(b[0]) ** 0.5)
    while r > extent * 2.0**-48:
        cells = points.groupBy(*[F.floor(F.col(c) / F.lit(r)).alias(c) for c in cols]).agg(F.count(F.lit(1)).cast("double").alias("n"))
        if cells.agg(F.sum(F.col("n") * F.col("n")) / F.sum("n")).first()[0] <= share:
            break
        r /= 4
    return r


def k_distance(points: DataFrame, k: int, x: str = "x", y: str = "y", radius: float | None = None) -> DataFrame:
    """Exact weighted k-th nearest-neighbour distance of every distinct point (the point
    itself counts as its first neighbour, its weight as that many neighbours).

    Round r searches the 3x3 cells of side ``radius * 2**r`` around each unresolved point:
    every point within that radius is found, so a point whose cumulative neighbour weight
    reaches k inside the radius has its exact answer.  Only unresolved points go on; the total
    weight is checked first, so every point is resolved at last.
    Output: (id, x, y, w, kdist)."""
    total = points.agg(F.sum("w")).first()[0]
    if total is None or total < k:
        raise ValueError(f"k_distance: total weight {total} is below k={k}")
    if radius is None:
        radius = grid_radius(points, [x, y])
    todo = points.select("id", x, y, "w")
    done = []
    r = radius
    while True:
        cx, cy = _cells(F.col(x), F.col(y), r)
        a = todo.select(F.col("id").alias("id_a"), F.col(x).alias("xa"), F.col(y).alias("ya"),
                        cx.alias("cx"), cy.alias("cy"))
        offsets = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                            for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
        bb = points.select(F.col(x).alias("xb"), F.col(y).alias("yb"), F.col("w").alias("w_b"),
                           cx.alias("bx"), cy.alias("by"), F.explode(offsets).alias("o"))
        bb = bb.select("xb", "yb", "w_b", (F.col("bx") + F.col("o.dx")).alias("cx"),
                       (F.col("by") + F.col("o.dy")).alias("cy"))
        d = F.sqrt(F.pow(F.col("xa") - F.col("xb"), 2) + F.pow(F.col("ya") - F.col("yb"), 2))
        near = a.join(bb, ["cx", "cy"]).select("id_a", "w_b", d.alias("d")).where(F.col("d") <= F.lit(r))
        per_d = near.groupBy("id_a", "d").agg(F.sum("w_b").alias("wd"))
        w = Window.partitionBy("id_a").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cum = per_d.withColumn("cum", F.sum("wd").over(w))
        hit = cum.where(F.col("cum") >= k).groupBy("id_a").agg(F.min("d").alias("kdist"))
        hit = _checkpoint(hit)
        done.append(hit)
        todo = _checkpoint(todo.join(hit.withColumnRenamed("id_a", "id"), "id", "left_anti"))
        if todo.limit(1).count() == 0:
            break
        r *= 2
    res = done[0]
    for h in done[1:]:
        res = res.unionByName(h)
    return points.join(res.withColumnRenamed("id_a", "id"), "id").select("id", x, y, "w", "kdist")


# --------------------------------------------------------------------------------------
# cluster quality
# --------------------------------------------------------------------------------------

def _sum(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)


def _labelled(df: DataFrame, feats: Sequence[str], label: str, weight: str | None) -> DataFrame:
    """Distinct (features, label) with their weight ``w``; the label is ``l``, features f0, f1, ..."""
    w = F.sum(F.col(weight).cast("double")) if weight else F.count(F.lit(1)).cast("double")
    named = df.select(F.col(label).alias("l"), *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(feats)],
                      *([F.col(weight).alias("__w")] if weight else []))
    if weight:
        w = F.sum(F.col("__w").cast("double"))
    return named.dropna().groupBy("l", *[f"f{i}" for i in range(len(feats))]).agg(w.alias("w"))


def _near(todo: DataFrame, targets: DataFrame, axes: Sequence[tuple[str, str]], r: float, keys: Sequence[str] = ()) -> DataFrame:
    """Pairs whose coordinates differ by at most a cell of side ``r`` on every axis: an equi-join on
    cells (and ``keys``).  Targets are copied to the cells around theirs."""
    cells = [f"c{i}" for i in range(len(axes))]
    a = todo.withColumns({c: F.floor(F.col(q) / F.lit(r)).cast("long") for c, (q, _) in zip(cells, axes)})
    b = targets.withColumns({c: F.floor(F.col(t) / F.lit(r)).cast("long") for c, (_, t) in zip(cells, axes)})
    for c in cells:
        b = b.withColumn(c, F.explode(F.sequence(F.col(c) - 1, F.col(c) + 1)))
    return a.join(b, [*keys, *cells]).drop(*cells)


def silhouette_df(df: DataFrame, feats: Sequence[str], label: str, weight: str | None = None) -> DataFrame:
    """Mean silhouette with squared Euclidean distance, exact.

    The mean squared distance from a point p to a cluster's members is |p - centre|^2 + scatter
    (scatter: the members' mean squared distance to their centre).  So the own cluster's part needs
    one join on the label, and the nearest other cluster is the nearest point to (p, 0) among
    (centre, sqrt(scatter)): a growing grid search over the centres, in which a point is done as
    soon as what it has found is nearer than the radius searched.  Nothing goes through the driver
    and no two points are paired.  Weights act as multiplicities; a point whose cluster has weight
    1, or whose distances are all 0, scores 0; with a single cluster the result is NULL.
    """
    n = len(feats)
    f = [f"f{i}" for i in range(n)]
    pts = _labelled(df, feats, label, weight)
    centre = pts.groupBy("l").agg(F.sum("w").alias("total"), *[(F.sum(F.col("w") * F.col(c)) / F.sum("w")).alias(f"m_{c}") for c in f])
    off = _sum([F.pow(F.col(c) - F.col(f"m_{c}"), 2) for c in f])
    near = _checkpoint(pts.join(centre, "l").withColumn("off", off))
    scatter = near.groupBy("l").agg((F.sum(F.col("w") * F.col("off")) / F.sum("w")).alias("v"))
    clusters = _checkpoint(centre.join(scatter, "l"))
    if clusters.limit(2).count() < 2:
        return clusters.agg(F.max(F.lit(None).cast("double")).alias("silhouette"))
    # Of clusters with one centre only the two of least scatter can be a nearest other one.
    order = Window.partitionBy(*[f"m_{c}" for c in f]).orderBy("v", "l")
    low = clusters.withColumn("k", F.row_number().over(order)).where("k <= 2").withColumn("h", F.sqrt("v"))
    low = _checkpoint(low.select(F.col("l").alias("o"), *[F.col(f"m_{c}").alias(f"t_{c}") for c in f], F.col("v").alias("o_v"), F.col("h").alias("o_h")))
    # a: mean squared distance to the own cluster without the point itself.
    own = near.join(scatter, "l").select("l", *f, "w", "total", F.when(F.col("total") > 1, (F.col("off") + F.col("v")) * F.col("total") / (F.col("total") - 1)).alias("a"))
    todo = _checkpoint(own.withColumn("pid", F.monotonically_increasing_id()).withColumn("zero", F.lit(0.0)))
    base, done, best = todo, [], None
    axes = [(c, f"t_{c}") for c in f[:2]] + [("zero", "o_h")]
    r = grid_radius(low, [t for _, t in axes])
    while True:
        d = _sum([F.pow(F.col(c) - F.col(f"t_{c}"), 2) for c in f]) + F.col("o_v")
        found = _near(todo, low, axes, r).where(F.col("l") != F.col("o")).groupBy("pid").agg(F.min(d).alias("b"))
        found = _checkpoint(found.where(F.col("b") <= F.lit(r * r)))  # nothing outside can be nearer
        done.append(found)
        todo = _checkpoint(todo.join(found, "pid", "left_anti"))
        if todo.limit(1).count() == 0:
            break
        r *= 2
    best = reduce(DataFrame.unionByName, done)
    top = F.greatest("a", "b")
    s = F.when((F.col("total") <= 1) | (top == 0), F.lit(0.0)).otherwise((F.col("b") - F.col("a")) / F.nullif(top, F.lit(0.0)))
    return base.join(best, "pid").agg((F.sum(F.col("w") * s) / F.sum("w")).alias("silhouette"))


def silhouette(df: DataFrame, feats: Sequence[str], label: str, weight: str | None = None) -> float | None:
    """``silhouette_df`` as a number."""
    res = silhouette_df(df, feats, label, weight).first()[0]
    return None if res is None else float(res)


def davies_bouldin_df(df: DataFrame, feats: Sequence[str], label: str, weight: str | None = None,
                      include_noise: bool = False, noise_label: int = -1) -> DataFrame:
    """Davies-Bouldin index (Euclidean): mean over clusters of the worst (s_i + s_j) / d(c_i, c_j).

    Noise (``noise_label``) is left out unless ``include_noise``; then it counts as one more
    cluster.  The worst partner comes from growing grid searches, one for every power-of-two class
    of scatter s_j: a cluster is done with a class as soon as its worst ratio so far is at least
    what any centre beyond the radius could give.  Two clusters with the same centre have the ratio
    0; with fewer than two clusters the result is NULL.
    """
    n = len(feats)
    f = [f"f{i}" for i in range(n)]
    src = df if include_noise else df.where(F.col(label) != noise_label)
    pts = _labelled(src, feats, label, weight)
    centre = _checkpoint(pts.groupBy("l").agg(*[(F.sum(F.col("w") * F.col(c)) / F.sum("w")).alias(f"m_{c}") for c in f]))
    off = F.sqrt(_sum([F.pow(F.col(c) - F.col(f"m_{c}"), 2) for c in f]))
    scatter = pts.join(centre, "l").groupBy("l").agg((F.sum(F.col("w") * off) / F.sum("w")).alias("s"))
    info = _checkpoint(centre.join(scatter, "l").withColumn("cls", F.when(F.col("s") > 0, F.floor(F.log2("s"))).otherwise(-1100).cast("int")))
    # One row per power of two: at most 2,200, whatever the data.
    classes = info.groupBy("cls").agg(F.max("s").alias("top")).collect()
    if not classes:
        return info.agg(F.max(F.lit(None).cast("double")).alias("davies_bouldin"))
    # Of clusters with one centre and class only the two of most scatter can be a worst partner.
    order = Window.partitionBy("cls", *[f"m_{c}" for c in f]).orderBy(F.desc("s"), "l")
    high = info.withColumn("k", F.row_number().over(order)).where("k <= 2")
    high = _checkpoint(high.select(F.col("l").alias("o"), "cls", *[F.col(f"m_{c}").alias(f"t_{c}") for c in f], F.col("s").alias("o_s")))
    each = F.explode(F.array(*[F.struct(F.lit(c["cls"]).alias("cls"), F.lit(c["top"]).alias("top")) for c in classes]))
    todo = _checkpoint(info.select("l", "s", *[f"m_{c}" for c in f], each.alias("c")).select("*", "c.*").drop("c"))
    axes = [(f"m_{c}", f"t_{c}") for c in f[:2]]
    b = info.agg(*[F.max(f"m_{c}") - F.min(f"m_{c}") for c in f]).first()
    reach = 2 * sum(float(x or 0.0) for x in b)  # beyond the farthest pair
    r = grid_radius(high, [t for _, t in axes])
    worst = _checkpoint(info.select("l", F.lit(None).cast("double").alias("r")))
    while True:
        d = F.sqrt(_sum([F.pow(F.col(f"m_{c}") - F.col(f"t_{c}"), 2) for c in f]))
        ratio = F.when(d > 0, (F.col("s") + F.col("o_s")) / F.nullif(d, F.lit(0.0))).otherwise(0.0)
        found = _near(todo, high, axes, r, ["cls"]).where(F.col("l") != F.col("o")).groupBy("l").agg(F.max(ratio).alias("r"))
        worst = _checkpoint(worst.unionByName(found).groupBy("l").agg(F.max("r").alias("r")))
        if r > reach:
            break
        far = (F.col("s") + F.col("top")) / F.lit(r)
        todo = _checkpoint(todo.join(worst, "l").where(F.col("r").isNull() | (F.col("r") < far)).drop("r"))
        if todo.limit(1).count() == 0:
            break
        r *= 2
    return worst.agg(F.avg("r").alias("davies_bouldin"))


def davies_bouldin(df: DataFrame, feats: Sequence[str], label: str, weight: str | None = None,
                   include_noise: bool = False, noise_label: int = -1) -> float | None:
    """``davies_bouldin_df`` as a number."""
    res = davies_bouldin_df(df, feats, label, weight, include_noise, noise_label).first()[0]
    return None if res is None else float(res)


# --------------------------------------------------------------------------------------
# k-means
# --------------------------------------------------------------------------------------

def assign(points: DataFrame, feats: Sequence[str], centers: Sequence[Sequence[float]], label: str = "label") -> DataFrame:
    """``points`` with the number of the nearest of the given centres (ties: the smallest number)."""
    d = [_sum([(F.col(f) - F.lit(float(v))) * (F.col(f) - F.lit(float(v))) for f, v in zip(feats, c)]) for c in centers]
    best = F.array_min(F.array(*[F.struct(x.alias("d"), F.lit(i).cast("long").alias("i")) for i, x in enumerate(d)]))
    return points.withColumn(label, best["i"])


def lloyd(points: DataFrame, feats: Sequence[str], centers: Sequence[Sequence[float]], rounds: int,
          weight: str | None = None) -> tuple[DataFrame, list[list[float]]]:
    """K-means from given start centres, a given number of rounds: (labelled points, centres).

    A round is one aggregation of the points by their nearest centre; only the centres, one row for
    each of the k that the caller gave, come back.  A centre that no point is nearest to stays."""
    centers = [[float(v) for v in c] for c in centers]
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    for _ in range(rounds):
        g = assign(points, feats, centers, "__l").groupBy("__l").agg(*[(F.sum(w * F.col(f)) / F.sum(w)).alias(f"m{i}") for i, f in enumerate(feats)])
        for row in g.collect():
            centers[row["__l"]] = [row[f"m{i}"] for i in range(len(feats))]
    return assign(points, feats, centers), centers


def kmeans(df: DataFrame, feats: Sequence[str], k: int = 3, seed: int = 1, weight: str | None = None,
           max_iter: int = 50):
    """``pyspark.ml`` k-means (k-means|| init).  Returns (labels df with ``label``, centers
    df (label, centre coordinates))."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    vec = VectorAssembler(inputCols=list(feats), outputCol="__features").transform(df)
    km = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="__features", predictionCol="label")
    if weight:
        km = km.setWeightCol(weight)
    model = km.fit(vec)
    labels = model.transform(vec).drop("__features")
    spark = df.sparkSession
    centers = spark.createDataFrame(
        [(i, *[float(v) for v in c]) for i, c in enumerate(model.clusterCenters())],
        ["label", *[f"center_{f}" for f in feats]])
    return labels, centers


def top_clusters(labels: DataFrame, centers: DataFrame, n: int = 10, label: str = "label",
                 weight: str | None = None) -> DataFrame:
    """The n largest clusters (by weight) with their centres, largest first."""
    w = F.sum(weight) if weight else F.count(F.lit(1))
    sizes = labels.groupBy(label).agg(w.alias("size"))
    return sizes.join(centers, label).orderBy(F.desc("size"), F.asc(label)).limit(n)
