"""The queries opN_<name>: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import exact_dedup, fingerprints, line_dedup, minhash, mixing, secrets, sentencepiece_bpe, sharding, simhash, spelling, token_counts, toxicity, whitening
from tripflow.llm.common import read_table
from tripflow.llm.sql import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]
PIECES = "piece_bpe_32k.model"


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' fingerprints and those of their edited texts, whose last half is the start of
    the next document's by descending id."""
    d, w = fingerprints.with_next(read_table(spark, sf_dir, "documents"))
    n = F.length("text")
    d = d.withColumn("next_text", F.lead("text").over(w))
    d = fingerprints.with_sketch(d, F.col("text"), "sketch")
    half = F.floor(n / 2).cast("int")
    d = d.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    d = fingerprints.with_sketch(d, F.col("edited"), "edited_sketch")
    d = d.select("id", "guard", "bucket", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "sketch", "edited_sketch", F.xxhash64("text").alias("text_hash"), "text")
    d = d.withColumn("next_sketch", F.lead("sketch").over(w)).filter("NOT guard")
    return d.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
                    fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
                    fingerprints.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                    fingerprints.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to their sources' targets: what the mix takes of each."""
    mix = mixing.Mix(read_table(spark, sf_dir, "documents"))
    return mix.taken().select("doc_id", "size", "source_size", "target", "taken")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' greedy word-piece counts."""
    first, more = token_counts.pieces_of_model(public_tokenizers.path(PIECES))
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), first, more)


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their fingerprint and their near-duplicate component."""
    return simhash.with_component(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' secrets."""
    d = secrets.scan(read_table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_literal")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that many sources share."""
    d = line_dedup.drop_spread_lines(read_table(spark, sf_dir, "documents"), counts=True)
    return d.select("doc_id", "n_lines", "n_removed", "text")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the row that stays of each group of equal texts."""
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again."""
    vocabulary = sentencepiece_bpe.load(public_tokenizers.path(PIECES))
    return sentencepiece_bpe.encoded(read_table(spark, sf_dir, "documents"), vocabulary, ids=False)


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to 40 shards whose row counts are at most one apart (law ``rows``)."""
    d = sharding.shard_rows(read_table(spark, sf_dir, "documents"), shards=40)
    return d.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' toxicity; labels are learnt from rows that are not held out."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    weights = toxicity.train(docs, labels, eligible=~toxicity.held_out("id"))
    d = docs.select("doc_id", toxicity.held_out().alias("held_out"), toxicity.score(F.col("text"), spark, weights).alias("score"))
    return d.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their component over links of 85 % of their 3-word shingles."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their 32 first principal components, whitened."""
    return whitening.whitened(read_table(spark, sf_dir, "embeddings"), components=32)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the documents with the forms that they are variants of."""
    return spelling.variants(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_fingerprints, op2_mix_sources, op3_token_counts, op4_simhash_near_dedup, op5_secret_scan, op6_line_dedup,
    op7_exact_dedup, op8_sentencepiece, op9_shards, op10_toxicity, op11_minhash_near_dedup, op12_whitening, op13_spelling_variants)}
