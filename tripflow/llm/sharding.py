"""Sharding by a keyed Feistel permutation of global row numbers, with cycle walking.

Row numbers are the rows' places in the order (doc_id, hash of the text, text size), so they depend
on the data alone and not on files or partitions.  The permutation sends row number r to place p;
shard = p mod shards, slot = p div shards.  Any place can be computed from its row number and, by
the inverse, any row number from its shard and slot, without a table.

Shard sizes in rows differ by at most one.  Rows are dealt one by one, so copies of a text (a
group) are spread over the shards like any other rows.  Null ids come first in the order; rows
equal in id and text are interchangeable; an empty table gives no rows; null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import global_rank, permuted, permuted_back, text_of


def place(row_number: Column, rows: int, seed: int, shards: int) -> tuple[Column, Column]:
    """(shard, slot) of a row number."""
    p = permuted(row_number, F.lit(rows).cast("long"), F.lit(seed))
    return F.pmod(p, F.lit(shards).cast("long")).cast("int"), F.floor(p / F.lit(shards)).cast("long")


def row_number_at(shard: Column, slot: Column, rows: int, seed: int, shards: int) -> Column:
    """The row number that lies at a shard's slot."""
    return permuted_back(slot.cast("long") * F.lit(shards) + shard.cast("long"), F.lit(rows).cast("long"), F.lit(seed))


def shard_rows(df: DataFrame, shards: int, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, row_number, shard, slot) of every row; size is UTF-8 bytes plus 16."""
    text = text_of(text_col)
    slim = df.select(F.col(id_col).alias("id"), (F.octet_length(text).cast("long") + 16).alias("size"),
                     F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))
    ranked, rows = global_rank(slim, ["id", "text_hash", "size", "text_crc32"], "row_number", "shard-order")
    p = permuted(F.col("row_number"), F.lit(max(rows, 1)).cast("long"), F.lit(seed))
    placed = ranked.withColumn("place", p)
    return placed.select(F.col("id").alias(id_col), "size", "text_crc32", "row_number",
                         F.pmod("place", F.lit(shards).cast("long")).cast("int").alias("shard"),
                         F.floor(F.col("place") / F.lit(shards)).cast("long").alias("slot"))
