"""A corpus from raw documents to tokens: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluice.llm import byte_bpe, exact_dedup, mixing, ngram_join, toxicity
from sluice.llm.queries import TOKENIZER
from sluice.llm.scratch import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from all labelled documents of the input and keeps what the classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.accepted(docs, toxicity.learn(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.unique(docs, exact_dedup.new_index(spark))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in fives, similarity of 0.8 or more; the smallest doc_id of each group stays."""
    return ngram_join.one_of_each(docs, n=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of digests per document; workers that hold what earlier stages left remember fewer words."""
    return byte_bpe.token_digests(docs, TOKENIZER, public_tokenizers.PATTERN, cached=100_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE", tokenise),
]

#: Toxicity is learnt and near-duplicate components are a closure over a similarity join; neither can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written and read again."""
    scratch = Scratch(spark, "corpus")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.keep(docs, f"stage{i}")
    return docs
