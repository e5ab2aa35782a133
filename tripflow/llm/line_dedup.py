"""Line dedup by distinct-site spread.

Each line's sites go into a HyperLogLog sketch per line hash; sketches merge by aggregation, so a
line that a third of all rows share costs one sketch per task.  A line whose estimate is clearly at
or above ``min_sites`` is spread, one clearly below is not; those near the threshold (within four
standard errors and one site) are decided by their exact distinct count, of which only they are
part.  A spread line stays where it first occurs (smallest id, then first in its text) and is
removed everywhere else, so a text whose copies are on many sites loses its copies but not itself.

Lines are cut at line feeds and compared without the white space around them; empty ones always
stay.  Rows of one id follow one another by their texts.  The result has the input's columns, every row kept, the text
without its removed lines (and n_chars, if there is one, its new length).  Null texts stay null;
rows without a site count as one site more; rows with null ids come after all others; rows equal in
id and text count as one document and get the same result; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import forget, global_rank, packed, stored, text_of, unpacked

MIN_SITES, LG_K = 5, 10
EDGE = "^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$"


def text_places(df: DataFrame, id_col: str, text_col: str) -> DataFrame | None:
    """(p_id, p_hash, place): the order, by text, of rows that share an id with other texts; None where no
    id has two texts.  A range shuffle ranks the rows of all ids, so no id's texts meet in one task."""
    text = text_of(text_col)
    d = df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    several = d.groupBy("id", "text_hash").agg(F.lit(1).alias("one")).groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if several.limit(1).count() == 0:
        return None
    ranked, _ = global_rank(d, ["id", "text"], "at", "text-places")
    return ranked.groupBy(F.col("id").alias("p_id"), F.col("text_hash").alias("p_hash")).agg(F.min("at").alias("place"))


def lines_of(df: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """One row per line that counts: no_id, id, place (of its text among those of its id), text_hash, pos,
    a, b (two hashes of the line), site."""
    text = text_of(text_col)
    d = df.select(F.col(id_col).alias("id"), F.col(site_col).cast("string").alias("site"), text.alias("text")).withColumn("text_hash", F.xxhash64("text"))
    places = text_places(df, id_col, text_col)
    if places is None:
        d = d.withColumn("place", F.lit(0).cast("long"))
    else:
        d = d.join(places, F.col("id").eqNullSafe(F.col("p_id")) & (F.col("text_hash") == F.col("p_hash")))
    d = d.select(F.col("id").isNull().alias("no_id"), "id", "place", "text_hash", "site", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    d = d.filter(F.octet_length("line") > 0).withColumn("line", F.regexp_replace("line", EDGE, "")).filter(F.octet_length("line") > 0)
    return d.select("no_id", "id", "place", "text_hash", "pos", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"), "site")


def spread_lines(lines: DataFrame, min_sites: int, lg_k: int = LG_K) -> DataFrame:
    """(a, b, first) of the lines on at least ``min_sites`` sites; first: where each stays."""
    site = F.coalesce(F.concat(F.lit("="), F.col("site")), F.lit(""))
    sketched = lines.withColumn("site", site).groupBy("a", "b").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("estimate"), F.min(F.struct("no_id", "id", "place", "text_hash", "pos")).alias("first"))
    margin = 1 + 4 * 1.04 / (2 ** (lg_k / 2)) * min_sites
    sketched = sketched.filter(F.col("estimate") >= min_sites - margin)
    kept, _ = stored(sketched, "line-sketches")
    near = kept.filter(F.col("estimate") <= min_sites + margin).select("a", "b")
    exact = (lines.withColumn("site", site).join(near, ["a", "b"], "left_semi").groupBy("a", "b", "site").agg(F.lit(1).alias("one"))
             .groupBy("a", "b").agg(F.count(F.lit(1)).alias("sites")).filter(F.col("sites") >= min_sites).select("a", "b"))
    sure = kept.filter(F.col("estimate") > min_sites + margin).select("a", "b", "first")
    return sure.unionByName(kept.join(exact, ["a", "b"]).select("a", "b", "first"))


def drop_spread_lines(df: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K,
                      id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", counts: bool = False) -> DataFrame:
    """The rows of ``df`` without their spread lines; ``counts`` adds n_lines and n_removed."""
    lines, path = stored(lines_of(df, id_col, text_col, site_col), "lines")
    spread = spread_lines(lines, min_sites, lg_k)
    here = F.struct("no_id", "id", "place", "text_hash", "pos")
    removed = (lines.join(spread, ["a", "b"]).filter(~here.eqNullSafe(F.col("first")))
               .groupBy("id", "text_hash").agg(F.collect_set("pos").alias("removed")))
    removed, _ = stored(removed.select(F.col("id").alias("r_id"), F.col("text_hash").alias("r_hash"), "removed"), "lines-removed")
    forget(df.sparkSession, path)
    text = text_of(text_col)
    d = packed(df, F.col(id_col).alias("k_id"), F.xxhash64(text).alias("k_hash"))
    d = d.join(removed, F.col("k_id").eqNullSafe(F.col("r_id")) & (F.col("k_hash") == F.col("r_hash")), "left")
    old = F.col("row")[text_col]
    d = d.withColumn("k_lines", F.when(F.col("removed").isNotNull(), F.split(old, "\n")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("k_lines") - 1), F.col("removed"))
    d = d.withColumn("k_text", F.when(F.col("removed").isNull(), old).otherwise(F.array_join(F.transform(kept, lambda i: F.get(F.col("k_lines"), i)), "\n")))
    new = {text_col: F.col("k_text")}
    if "n_chars" in df.columns:
        new["n_chars"] = F.when(F.col("removed").isNull(), F.col("row")["n_chars"]).otherwise(F.length("k_text"))
    if not counts:
        return unpacked(d, df.columns, **new)
    total = F.when(old.isNull() | (old == ""), 0).otherwise(F.size(F.split(old, "\n")))
    return d.select(*[new.get(c, F.col("row")[c]).alias(c) for c in df.columns], total.cast("long").alias("n_lines"),
                    F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"))
