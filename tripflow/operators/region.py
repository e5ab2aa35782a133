"""Point-in-region tagging.

Work is done on *distinct* points only: trips collapse to their coordinates (partial
aggregation before the shuffle), points meet polygon edges through an equi-join on latitude
bands (never a cartesian product), crossings are counted per (point, region) with even-odd
parity over all rings.  The edges are the broadcast side as long as their counted number allows
(only the regions are read for that, never the points), so points stay where they are; beyond
that the join shuffles.  The tags go back to the trips by a join on the coordinates, whose
smaller side Spark broadcasts by its measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Region edges (times the bands they cross) that may be broadcast; about 100 bytes each.
MAX_BROADCAST_EDGES = 200_000


def region_edges(regions: DataFrame, name_col: str = "name", coords_col: str = "coordinates") -> DataFrame:
    """One row per polygon edge: (name, part, ring, x1, y1, x2, y2).  Rings are closed."""
    parts = regions.select(F.col(name_col).alias("name"),
                           F.posexplode(coords_col).alias("part", "rings"))
    rings = parts.select("name", "part", F.posexplode("rings").alias("ring", "pts"))
    n = F.size("pts")
    edges = rings.select(
        "name", "part", "ring",
        F.explode(F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.struct(
                F.col("pts")[i][0].alias("x1"), F.col("pts")[i][1].alias("y1"),
                F.col("pts")[F.pmod(i + 1, n)][0].alias("x2"),
                F.col("pts")[F.pmod(i + 1, n)][1].alias("y2")))).alias("e"))
    return edges.select("name", "part", "ring", "e.x1", "e.y1", "e.x2", "e.y2")


def _band(v: Column, band: float) -> Column:
    return F.floor(v / F.lit(band)).cast("long")


def tag_points(points: DataFrame, regions: DataFrame, x: str = "x", y: str = "y", *,
               boundary: bool = False, band: float = 0.01, name_col: str = "name",
               coords_col: str = "coordinates") -> DataFrame:
    """(x, y, region) for distinct points inside a region (smallest name when several).

    ``boundary=False`` is the strict-interior test (points on an edge or vertex are outside);
    ``boundary=True`` counts the boundary as inside.  Holes and multi-part regions follow the
    even-odd rule over all rings.
    """
    e = region_edges(regions, name_col, coords_col)
    e = e.select("name", "x1", "y1", "x2", "y2",
                 F.least("y1", "y2").alias("ylo"), F.greatest("y1", "y2").alias("yhi"),
                 F.least("x1", "x2").alias("xlo"), F.greatest("x1", "x2").alias("xhi"))
    e = e.withColumn("band", F.explode(F.sequence(_band(F.col("ylo"), band), _band(F.col("yhi"), band))))
    pts = (points.select(F.col(x).alias("px"), F.col(y).alias("py"))
           .where(F.col("px").isNotNull() & F.col("py").isNotNull()).distinct()
           .withColumn("band", _band(F.col("py"), band)))
    if e.limit(MAX_BROADCAST_EDGES + 1).count() <= MAX_BROADCAST_EDGES:
        e = F.broadcast(e)
    j = pts.join(e, "band").where(F.col("py").between(F.col("ylo"), F.col("yhi")))
    px, py = F.col("px"), F.col("py")
    x1, y1, x2, y2 = F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")
    on_edge = (((x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)) == 0) & px.between(F.col("xlo"), F.col("xhi"))
    # Evaluated only for edges that straddle the point's latitude (so y2 != y1).
    crosses = F.when((y1 > py) != (y2 > py), px < (x2 - x1) * (py - y1) / (y2 - y1) + x1).otherwise(F.lit(False))
    per = j.groupBy("px", "py", "name").agg(
        F.max(on_edge.cast("int")).alias("on_edge"),
        F.sum(crosses.cast("int")).alias("crossings"))
    inside = F.when(F.col("on_edge") == 1, F.lit(boundary)).otherwise(F.col("crossings") % 2 == 1)
    hits = per.where(inside)
    return hits.groupBy("px", "py").agg(F.min("name").alias("region")).withColumnsRenamed({"px": x, "py": y})


def region_of(df: DataFrame, lon: str, lat: str, regions: DataFrame, out: str = "city_name", *,
              boundary: bool = False, default: str | None = "UNKNOWN", band: float = 0.01) -> DataFrame:
    """Add ``out`` = name of the region containing (lon, lat), else ``default``."""
    tags = tag_points(df.select(lon, lat), regions, lon, lat, boundary=boundary, band=band)
    tags = tags.withColumnsRenamed({lon: "__tag_x", lat: "__tag_y"})
    joined = df.join(tags, (df[lon] == tags["__tag_x"]) & (df[lat] == tags["__tag_y"]), "left")
    name = F.coalesce(F.col("region"), F.lit(default)) if default is not None else F.col("region")
    cols = [F.col(c) for c in df.columns if c != out] + [name.alias(out)]
    return joined.select(*cols)
