"""The pipeline's stages: each takes (spark, docs, sf_dir) and returns what is kept of ``docs``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import line_dedup, mixing, sentencepiece_bpe, simhash, toxicity
from tripflow.llm.common import read_table, stored
from tripflow.llm.queries import PIECES

REJECT_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a toxicity below ``REJECT_FROM``; labels are learnt as in the query op10."""
    weights = toxicity.train(docs, read_table(spark, sf_dir, "labels"), eligible=~toxicity.held_out("id"))
    return docs.filter(toxicity.score(F.col("text"), spark, weights) < REJECT_FROM)


def drop_spread_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many sources share (each stays where it first occurs)."""
    return line_dedup.drop_spread_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: 3-word shingles, at most 3 differing bits."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words of; their text is the original's at those words, with its
    white space."""
    return mixing.Mix(docs).documents(layout=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every document."""
    return sentencepiece_bpe.encoded(docs, sentencepiece_bpe.load(public_tokenizers.path(PIECES)))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_spread_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs, _ = stored(docs, f"stage-{name}")
    return docs
