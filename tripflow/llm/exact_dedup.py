"""Exact dedup by distributed MSD radix partitioning over the texts' bytes.

A group starts as all documents.  Each level splits every open group by its documents' next bytes
(one digit of ``FIRST`` bytes, later ``GROWTH`` times wider at each level).  A group is closed when
it has one document or when its texts have ended; texts that end in the same group are equal,
byte for byte, and no digest takes part.  Only open rows carry text to the next level, so each
byte is moved about once however many levels there are.

A level is two jobs: count the digits of the open groups (partial sums first, so a digit that a
third of all rows share is one row per task), number the digits that more than one row has, and join those numbers
back.  The join's small side has one row per digit, and Spark may split a hot digit of the large
side.  Levels end when no row is open; there is no limit on length.

Null texts count as empty; null ids are smallest; of rows with the same text and the same largest
id, one stays; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import forget, stored, text_of

FIRST, GROWTH = 256, 8


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    spark = df.sparkSession
    text = text_of(text_col)
    # Level 0 has one open group; ``rest`` is what of the text is not yet consumed.
    open_rows = df.select(F.col(id_col).alias("id"), F.sha2(text, 256).alias("sha"), F.lit(0).cast("long").alias("grp"),
                          text.cast("binary").alias("rest"))
    width, level, done, dropped = FIRST, 0, [], []
    while True:
        digit = F.substring("rest", 1, width)
        keyed = open_rows.select("id", "sha", "grp", "rest", digit.alias("digit"), (F.octet_length("rest") <= width).alias("ended"))
        digits = (keyed.groupBy("grp", "digit", "ended").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
                  .filter("n > 1").withColumn("next", F.monotonically_increasing_id()))
        digits, digits_path = stored(digits, f"radix-digits{level}")  # fixes the numbers
        split = keyed.join(digits, ["grp", "digit", "ended"], "left")
        is_open = F.col("n").isNotNull() & ~F.col("ended")
        rows, rows_path = stored(split.select(
            "id", "sha", F.col("next").alias("grp"), "n", "top", F.lit(level).alias("level"),
            F.when(is_open, F.expr(f"substring(rest, {width + 1})")).alias("rest"), is_open.alias("open"),
            F.monotonically_increasing_id().alias("rid")), f"radix-rows{level}")
        forget(spark, digits_path, *dropped)
        done.append(rows.filter("NOT open").select("id", "sha", "grp", "n", "top", "level", "rid"))
        open_rows = rows.filter("open").select("id", "sha", "grp", "rest")
        if open_rows.limit(1).count() == 0:
            break
        width, level = width * GROWTH, level + 1
    closed = done[0]
    for more in done[1:]:
        closed = closed.unionByName(more)
    # One row of each group stays: of the rows with the largest id, the first written.
    first = closed.filter("n IS NOT NULL AND id <=> top").groupBy("level", "grp").agg(F.min("rid").alias("rid"))
    # Joined by the row's own number, so that a large group is no key.
    marked = closed.join(first.select("level", "rid", F.lit(True).alias("stays")), ["level", "rid"], "left")
    alone = F.col("n").isNull()
    return marked.select(F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("top")).alias("keep_id"),
                         F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                         (alone | F.col("stays").isNotNull()).alias("kept"), F.col("sha").alias("text_sha256"))
