"""Mixing sources to target weights by index, without moving the corpus about.

1. **Blocks.** A source's tokens (its documents' words, documents in a salted order) are packed
   into blocks of ``block_words``; the last block of a source may be shorter.  A document's place
   in its source's token stream is the sum of the salt groups before it plus the documents before
   it in its own salt group, so no task sees a whole source.
2. **Targets.** The sources, by code point and null last, weigh 5, 2, 1, repeating; they share
   ``share`` of all words, a target stops at ``most`` times its source's words and the excess is
   shared again.  That is min(cap, level x weight) for one common level.
3. **Draws.** The output has as many slots as the targets need blocks, ``shard_slots`` to a shard.
   Each shard's source counts are a multinomial draw given the sources' whole totals: a
   pseudorandom permutation deals the totals' labels to the slots.  Free draws would meet the
   targets only in expectation and could pass ``most``, so the totals are held.
4. **Indices.** A source's k-th slot reads block perm(k) of pass k div blocks, with a permutation
   of its own for every source and pass.  Its last slot takes only the words still wanted.
5. **Join** of slots and blocks on (source, block).

Only (source, size) rows are shuffled; texts are read once for their sizes and, where texts are
asked for, joined once with their word ranges.  Null texts have no words, null sources are one
source (the last), repeated rows are documents of their own, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripflow.llm.common import WORD, global_rank, packed, permuted, running_sums, shuffle_partitions, stored, text_of, words

WEIGHTS = (5, 2, 1)
BLOCK_WORDS, SHARD_SLOTS = 256, 1024
#: Salt groups of a source.  The order of its token stream depends on them, so they are fixed: reruns
#: agree whatever the session's settings.
SALTS = 4096

#: A word with the white space before it and, for the last word, behind it.
SPACED_WORD = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++(?:[\x20\x09-\x0D]++\z)?+"
SPACE_FIRST, SPACE_LAST = r"\A[\x20\x09-\x0D]+", r"[\x20\x09-\x0D]\z"


def sized(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, text_hash, source, size): size is the number of words."""
    text = text_of(text_col)
    return df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(source_col).alias("source"),
                     F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))


def placed(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """``docs`` (id, text_hash, source, size) with ``start``: the words of its source before it."""
    salt = F.pmod(F.xxhash64("id", "text_hash"), F.lit(salts)).cast("int")
    d = docs.withColumn("salt", salt)
    groups = d.groupBy("source", "salt").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(F.col("source").alias("g_source"), F.col("salt").alias("g_salt"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("g_start"))
    inside = Window.partitionBy("source", "salt").orderBy("id", "text_hash", "size").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    both = d.join(groups, F.col("source").eqNullSafe(F.col("g_source")) & (F.col("salt") == F.col("g_salt")))
    return both.select("id", "text_hash", "source", "size", (F.col("g_start") + F.col("inner")).alias("start"))


def targets(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per source: source, rank, source_size, target, words (the target, whole), and its
    blocks: full (of ``block_words``), blocks, slots, first_slot.  Ranks and running sums come from
    ranges of the sources and one sum per range, so no task holds the whole table."""
    s = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    s, _ = global_rank(s, [F.col("source").asc_nulls_last()], "rank", "mix-ranks")
    s = s.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("rank", F.lit(len(weights))).cast("int")))
    s = s.withColumn("cap", F.lit(most) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    s = running_sums(s, ["ratio", "rank"], "mix-ratios", capped="cap", weight_before="weight")
    size, weight = s.agg(F.sum("source_size"), F.sum("weight")).first()
    # The level at which this source and those of a higher ratio are open; the first that holds is it.
    level = (F.lit(share) * F.lit(size).cast("long") - F.col("capped")) / (F.lit(weight).cast("double") - F.col("weight_before"))
    level = s.agg(F.max(F.when(level <= F.col("ratio"), level))).first()[0]
    s = s.withColumn("level", F.lit(level).cast("double"))
    s = s.withColumn("target", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))))
    s = s.withColumn("words", F.least(F.round("target").cast("long"), F.floor("cap").cast("long")))
    size, long = F.col("source_size"), F.lit(block_words).cast("long")
    s = s.withColumn("full", F.floor(size / long).cast("long")).withColumn("blocks", F.ceil(size / long).cast("long"))
    passes = F.when(size > 0, F.floor(F.col("words") / size)).otherwise(0).cast("long")
    s = s.withColumn("passes", passes)
    s = s.withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil((F.col("words") - F.col("passes") * size) / long).cast("long"))
    s = running_sums(s, ["rank"], "mix-slots", first_slot="slots")
    return s.select("source", "rank", "weight", "source_size", "target", "words", "full", "blocks", "slots", "first_slot")


def draws(sources: DataFrame, seed: int, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """One row per output slot: shard, slot, rank (of its source), pass, block, take (words)."""
    spark = sources.sparkSession
    slots, count = sources.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count(F.lit(1))).first()
    # Ranges of labels meet the slots by equality of a chunk number: sources have whole runs of
    # labels, so a chunk of ``chunk`` labels meets few of them on average.
    chunk = max(1, slots // max(4096, 4 * count))
    ranges = (sources.filter("slots > 0").withColumn("last", F.col("first_slot") + F.col("slots") - 1)
              .withColumn("chunk", F.explode(F.sequence(F.floor(F.col("first_slot") / chunk), F.floor(F.col("last") / chunk)))))
    g = spark.range(0, slots, 1, shuffle_partitions(spark)).withColumnRenamed("id", "out")
    g = g.withColumn("label", permuted(F.col("out"), F.lit(max(slots, 1)).cast("long"), F.lit(seed)))
    g = g.withColumn("chunk", F.floor(F.col("label") / chunk))
    g = g.join(ranges, "chunk").filter(F.col("label").between(F.col("first_slot"), F.col("last")))
    k = F.col("label") - F.col("first_slot")
    g = g.withColumn("pass", F.floor(k / F.col("blocks")).cast("long")).withColumn("at", F.pmod(k, F.col("blocks")))
    # The short last block, if any, stays last in every pass; the full ones are permuted.
    n = F.greatest(F.col("full"), F.lit(1).cast("long"))
    key = F.pmod("rank", F.lit(2**31)).cast("int")  # the draws depend on its type
    block = F.when(F.col("at") < F.col("full"), permuted(F.least(F.col("at"), n - 1), n, key, F.col("pass"), F.lit(seed))).otherwise(F.col("at"))
    size = F.when(F.col("at") < F.col("full"), F.lit(block_words)).otherwise(F.pmod("source_size", F.lit(block_words)))
    left = F.col("words") - F.col("pass") * F.col("source_size") - F.col("at") * F.lit(block_words)
    return g.select(F.floor(F.col("out") / shard_slots).cast("long").alias("shard"), F.pmod("out", F.lit(shard_slots)).cast("int").alias("slot"),
                    "source", "rank", "pass", block.alias("block"), F.least(size, left).cast("long").alias("take"))


def shard_counts(drawn: DataFrame) -> DataFrame:
    """The draw of every output shard: how many of its slots each source fills."""
    return drawn.groupBy("shard", "source").agg(F.count(F.lit(1)).alias("slots"))


def ranges(docs: DataFrame, sources: DataFrame, drawn: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and slot that takes of it: the document's (source, start, size), the
    slot's (shard, slot, pass), ``skip`` words before and ``n`` words taken."""
    ids = sources.select(F.col("source").alias("s_source"), "rank")
    d = docs.filter("size > 0").join(ids, F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source")
    last = F.floor((F.col("start") + F.col("size") - 1) / block_words)
    d = d.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block_words), last)))
    g = drawn.select("rank", "block", "shard", "slot", "pass", "take")
    both = d.join(g, ["rank", "block"])
    begin = F.greatest(F.col("start"), F.col("block") * block_words)
    end = F.least(F.col("start") + F.col("size"), F.col("block") * block_words + F.col("take"))
    both = both.withColumn("begin", begin).withColumn("n", end - begin).filter("n > 0")
    return both.select("id", "text_hash", "source", "rank", "start", "size", "shard", "slot", "pass", "block",
                       (F.col("begin") - F.col("start")).alias("skip"), "n")


class Mix:
    """The decisions of one mix over ``df``; the tables below are all lazily read from storage."""

    def __init__(self, df: DataFrame, seed: int = 11, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0,
                 block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS,
                 id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> None:
        self.df, self.id_col, self.text_col, self.source_col, self.block_words = df, id_col, text_col, source_col, block_words
        sizes, _ = stored(sized(df, id_col, text_col, source_col), "mix-sizes")
        self.docs, _ = stored(placed(sizes), "mix-docs")
        self.sources, _ = stored(targets(self.docs, weights, share, most, block_words), "mix-sources")
        self.draws, _ = stored(draws(self.sources, seed, block_words, shard_slots), "mix-draws")
        self.ranges = ranges(self.docs, self.sources, self.draws, block_words)

    def taken(self) -> DataFrame:
        """Per document: id, size, source, source_size, target, taken."""
        per = self.ranges.groupBy("rank", "start").agg(F.sum("n").alias("taken"))
        s = self.sources.select(F.col("source").alias("s_source"), "rank", "source_size", "target")
        d = self.docs.join(s, F.col("source").eqNullSafe(F.col("s_source")))
        # Documents without words share their start with the next one, and take nothing.
        d = d.withColumn("at", F.when(F.col("size") > 0, F.col("start")))
        per = per.withColumnRenamed("rank", "t_rank").withColumnRenamed("start", "t_start")
        d = d.join(per, (F.col("rank") == F.col("t_rank")) & (F.col("at") == F.col("t_start")), "left")
        return d.select(F.col("id").alias(self.id_col), "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

    def _picked(self, *keys: str, layout: bool = False) -> DataFrame:
        """Texts joined with the ranges ``keys`` names (one array a text), as the pieces they take:
        structs of ``keys`` and words, or with ``layout`` the pieces as text, with their white space.
        Repeated rows (same id, text and source) are one document here, with the other columns of one of them."""
        parts = self.ranges.groupBy("id", "text_hash", "source").agg(F.sort_array(F.collect_list(F.struct(*keys, "skip", "n"))).alias("parts"))
        parts = parts.select(F.col("id").alias("p_id"), F.col("text_hash").alias("p_hash"), F.col("source").alias("p_source"), "parts")
        text = text_of(self.text_col)
        d = packed(self.df, F.col(self.id_col).alias("k_id"), F.xxhash64(text).alias("k_hash"), F.col(self.source_col).alias("k_source"))
        if self.docs.groupBy("id", "text_hash", "source").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count():
            plain = [F.col("row")[f.name] for f in self.df.schema.fields if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
            d = d.groupBy("k_id", "k_hash", "k_source").agg(F.min_by("row", F.xxhash64(*plain)).alias("row"))
        d = d.join(parts, F.col("k_id").eqNullSafe(F.col("p_id")) & (F.col("k_hash") == F.col("p_hash")) & F.col("k_source").eqNullSafe(F.col("p_source")))

        def cut(w: Column, p: Column) -> Column:
            return F.slice(w, (p["skip"] + 1).cast("int"), p["n"].cast("int"))

        def taken(w: Column) -> Column:
            return F.transform("parts", lambda p: F.struct(*[p[k].alias(k) for k in keys], cut(w, p).alias("words")))

        def written(w: Column) -> Column:
            def one(p: Column, i: Column) -> Column:
                before = F.get("parts", i - 1)
                start, end = F.get(w, p["skip"].cast("int")), F.get(w, (before["skip"] + before["n"] - 1).cast("int"))
                parted = start.rlike(SPACE_FIRST) | end.rlike(SPACE_LAST)
                made = F.array_join(cut(w, p), "")
                return (F.when((i == 0) & (p["skip"] > 0), F.regexp_replace(made, SPACE_FIRST, ""))
                        .when((i > 0) & ~parted, F.concat(F.lit(" "), made)).otherwise(made))
            return F.transform("parts", one)

        # The words are bound once for all parts: as a lambda's variable they are not computed again.
        whole = text_of(F.col("row")[self.text_col])
        pieces = F.transform(F.array(F.regexp_extract_all(whole, F.lit(SPACED_WORD), F.lit(0))), written)[0] if layout else F.transform(F.array(words(whole)), taken)[0]
        return d.select("row", F.col("k_id").alias("doc_id"), pieces.alias("pieces"))

    def documents(self, layout: bool = False) -> DataFrame:
        """The input's columns, one row per document that the mix takes words of: its text is those
        words in the mix's order (pass by pass), joined by spaces; n_chars follows, if there is one.
        Repeated rows (same id, text and source) become one document with all that they give; rows of one id
        and text from several sources stay apart.

        With ``layout`` the text is cut from the original instead: white space stays in and between
        ranges, and at the text's two ends where the mix takes them, so a document taken whole once
        keeps its text.  A range begins with the white space before its first word (not so the row's
        first, if it begins inside the document).  Passes follow one another in one row: a document
        taken in two passes has its text twice, parted by a space where no white space parts it."""
        d = self._picked("pass", "start", layout=layout)
        new_text = F.array_join("pieces", "") if layout else F.array_join(F.flatten(F.col("pieces.words")), " ")
        d = d.withColumn("new", new_text)
        new = {self.text_col: F.col("new"), "n_chars": F.length("new").cast("long")}
        return d.select(*[new.get(c, F.col("row")[c]).alias(c) for c in self.df.columns])

    def blocks(self) -> DataFrame:
        """The mix itself: shard, slot, source, doc_ids and the words of every output block (at most
        ``block_words`` of them)."""
        d = self._picked("shard", "slot", "source", "start").select("doc_id", F.explode("pieces").alias("p"))
        j = d.select("p.shard", "p.slot", "p.source", F.struct("p.start", "doc_id", "p.words").alias("piece"))
        b = j.groupBy("shard", "slot").agg(F.first("source").alias("source"), F.sort_array(F.collect_list("piece")).alias("pieces"))
        return b.select("shard", "slot", "source", F.col("pieces.doc_id").alias("doc_ids"), F.flatten(F.col("pieces.words")).alias("words"))
