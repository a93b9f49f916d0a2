"""A corpus pipeline of five stages; each reads what its predecessor wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from silverlake.llm import byte_bpe, chunk_dedup, mixing, ngram_join, ordinal_toxicity
from silverlake.llm.base import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal regression does not find toxic."""
    return ordinal_toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return chunk_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id."""
    return ngram_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.mix(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``source``, ``n_tokens``, ``ids`` and ``decoded`` (the text that the ids stand for)."""
    ranks = byte_bpe.share_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    both = byte_bpe.encode(docs.select("doc_id", "source", "text"), ranks, drop_text=True, bytes_col="decoded")
    return both.selectExpr(
        "doc_id", "source", "cast(size(ids) as bigint) AS n_tokens", "ids", "cast(decoded as string) AS decoded"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", to_tokens),
]

# Trained weights, set similarity and BPE merges are beyond SQL; tests/llm/test_pipeline.py has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
