"""Cleaning and packing a corpus: classifier, rules, near-duplicates, sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from daedap.llm.cotraining import without_rejected
from daedap.llm.minhash import without_near_duplicates
from daedap.llm.packing import pack, token_pieces
from daedap.llm.queries import table
from daedap.llm.supervision import without_bad
from daedap.session import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier takes for good."""
    return without_rejected(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are good by the weighed votes of the rules."""
    return without_bad(docs)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return without_near_duplicates(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left, as pieces of token sequences."""
    return pack(token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near-deduplication", near_deduplication),
    ("best-fit packing", best_fit_packing),
]

# Estimates and tokenizers decide here, which SQL cannot express; tests compare the
# stages with plain Python forms.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
