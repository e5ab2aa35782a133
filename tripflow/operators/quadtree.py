"""A quadtree of weighted points as tables, and walks over pairs of its cells.

``build`` parts the plane into square cells of a given side (or one cell that holds all points) and
cuts every cell of more than ``leaf`` points into four, level by level, until none is left: dense
places get small cells, thin places large ones.  A level is one aggregation of the points in cells
still too full.  Cells form one table (cell, parent, leaf, box of its points), points another one
with the cell of every level they lie in.

``walk`` meets pairs of cells from the top down.  A pair that a caller's rule settles as a whole
never meets its points; a pair too far apart is dropped; any other is opened into the pairs of its
cells' children, until both are leaves.  So no more than the pairs of leaves left over are compared
point by point.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.plans.sizing import stored
from tripflow.sources.sinks import remove_path

LEAF = 16
#: A cell's side halves so often at most; points closer than that stay in one leaf.
DEPTH = 40


class Tree(NamedTuple):
    """``cells``: (cell, top, level, leaf, n, x0, x1, y0, y1), ``top`` being its cell of level 0;
    ``children``: (cell, child), a leaf being its own child; ``places``: (id, cell, leaf) for every
    level of every point."""

    cells: DataFrame
    children: DataFrame
    places: DataFrame
    paths: list[str]

    def forget(self) -> None:
        for p in self.paths:
            remove_path(self.cells.sparkSession, p)


def _cell(level: int, side: float, origin: tuple[float, float]) -> Column:
    """The name of a point's cell at a level."""
    at = [F.floor((F.col(c) - F.lit(o)) / F.lit(side / 2.0**level)).cast("long") for c, o in zip(("x", "y"), origin)]
    return F.struct(F.lit(level).alias("level"), at[0].alias("cx"), at[1].alias("cy"))


def build(points: DataFrame, side: float | None = None, leaf: int = LEAF) -> Tree:
    """The tree of ``points`` (id, x, y), whose cells of level 0 have the given side (None: one cell)."""
    origin = (0.0, 0.0)
    if side is None:
        box = points.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
        lo = [float(box[i] or 0.0) for i in (0, 2)]
        extent = max(float(box[1] or 0.0) - lo[0], float(box[3] or 0.0) - lo[1])
        origin, side = (lo[0], lo[1]), (extent or 1.0) * (1 + 1e-9)
    rest = points.select("id", "x", "y", F.lit(None).cast("struct<level:int,cx:bigint,cy:bigint>").alias("top"), F.lit(None).cast("struct<level:int,cx:bigint,cy:bigint>").alias("parent"))
    cells, places, paths = None, None, []
    for level in range(DEPTH + 1):
        rest = rest.withColumn("cell", _cell(level, side, origin))
        rest = rest.withColumn("top", F.coalesce("top", "cell"))
        made = rest.groupBy("cell").agg(F.any_value("top").alias("top"), F.any_value("parent").alias("parent"), F.count(F.lit(1)).alias("n"),
                                        *[f(c).alias(f"{c}{i}") for c in "xy" for i, f in enumerate((F.min, F.max))])
        made = made.withColumn("leaf", (F.col("n") <= leaf) | F.lit(level == DEPTH) | ((F.col("x0") == F.col("x1")) & (F.col("y0") == F.col("y1"))))
        made, path = stored(made, "quadtree-cells")
        at, at_path = stored(rest.join(made.select("cell", "leaf"), "cell").select("id", "x", "y", "top", "cell", "leaf"), "quadtree-points")
        paths += [path, at_path]
        cells = made if cells is None else cells.unionByName(made)
        here = at.select("id", "cell", "leaf")
        places = here if places is None else places.unionByName(here)
        rest = at.filter("NOT leaf").select("id", "x", "y", "top", F.col("cell").alias("parent"))
        if made.filter("NOT leaf").limit(1).count() == 0:
            break
    children = cells.filter("parent IS NOT NULL").select(F.col("parent").alias("cell"), F.col("cell").alias("child"))
    children = children.unionByName(cells.filter("leaf").select("cell", F.col("cell").alias("child")))
    return Tree(cells, children, places, paths)


def box_gap(a: str, b: str) -> Column:
    """The least distance of two boxes' points (columns x0, x1, y0, y1 with the prefixes a and b)."""
    gaps = [F.greatest(F.col(f"{b}{c}0") - F.col(f"{a}{c}1"), F.col(f"{a}{c}0") - F.col(f"{b}{c}1"), F.lit(0.0)) for c in "xy"]
    return F.sqrt(F.pow(gaps[0], 2) + F.pow(gaps[1], 2))


def box_span(a: str, b: str) -> Column:
    """The largest distance of two boxes' points."""
    spans = [F.greatest(F.col(f"{b}{c}1") - F.col(f"{a}{c}0"), F.col(f"{a}{c}1") - F.col(f"{b}{c}0")) for c in "xy"]
    return F.sqrt(F.pow(spans[0], 2) + F.pow(spans[1], 2))


def walk(tree: Tree, pairs: DataFrame, targets: DataFrame, sources: DataFrame, verdict: Column, settled: Callable[[DataFrame], DataFrame],
         label: tuple[str, ...] = (), prune: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> tuple[DataFrame | None, DataFrame, list[str]]:
    """From ``pairs`` (a, b, *label) of cells: what ``settled`` makes of the pairs that ``verdict``
    calls 'whole', and the pairs of leaves (a, b, *label) that it calls 'open' to the last.

    ``targets`` (a, ...) and ``sources`` (b, *label, ...) hold what the verdict needs; 'drop' ends a pair.
    ``prune`` may end more of the open pairs, given what is settled so far.  Also returned: the paths of
    the tables that the results still read."""
    paths: list[str] = []
    whole: DataFrame | None = None
    leaves: DataFrame | None = None
    ends = tree.cells.select("cell", "leaf")
    while True:
        met = pairs.join(targets, "a").join(sources, ["b", *label]).withColumn("verdict", verdict).filter("verdict <> 'drop'")
        met = met.join(ends.select(F.col("cell").alias("a"), F.col("leaf").alias("a_leaf")), "a").join(ends.select(F.col("cell").alias("b"), F.col("leaf").alias("b_leaf")), "b")
        met, path = stored(met, "cell-pairs")
        paths.append(path)
        got = settled(met.filter("verdict = 'whole'"))
        whole = got if whole is None else whole.unionByName(got)
        still = met.filter("verdict = 'open'").select("a", "b", *label, "a_leaf", "b_leaf")
        if prune:
            still = prune(still, whole)
        last = still.filter("a_leaf AND b_leaf").select("a", "b", *label)
        leaves = last if leaves is None else leaves.unionByName(last)
        more = still.filter("NOT (a_leaf AND b_leaf)").select("a", "b", *label)
        if more.limit(1).count() == 0:
            return whole, leaves, paths
        pairs = more.join(tree.children.select(F.col("cell").alias("a"), F.col("child").alias("a_child")), "a")
        pairs = pairs.join(tree.children.select(F.col("cell").alias("b"), F.col("child").alias("b_child")), "b")
        pairs = pairs.select(F.col("a_child").alias("a"), F.col("b_child").alias("b"), *label)
