"""The registered queries of these operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from daedap.llm.cotraining import classified
from daedap.llm.counts import token_counts
from daedap.llm.dac import read_tokens, write_tokens
from daedap.llm.licenses import license_matches
from daedap.llm.maxplus import digests
from daedap.llm.minhash import near_duplicates
from daedap.llm.oracle import ORACLE
from daedap.llm.packing import pack, token_pieces
from daedap.llm.pii import personal_data
from daedap.llm.search import ranked
from daedap.llm.supervision import judged
from daedap.llm.syncmers import fingerprints, shared_passages
from daedap.llm.warc import page_captures, read_archives, transactions, write_archives
from daedap.llm.whitening import whitened


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_archives(table(spark, sf_dir, "pages"))
    return page_captures(transactions(read_archives(files)))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts(table(spark, sf_dir, "documents"), model)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack(token_pieces(table(spark, sf_dir, "documents"), tokenizer))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(table(spark, sf_dir, "documents"))


def op8_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def syncmer_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_passages(table(spark, sf_dir, "documents"))


def op9_max_plus_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and checksums of the ids of each document, and of the text they give back."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return digests(table(spark, sf_dir, "documents"), model)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return read_tokens(write_tokens(table(spark, sf_dir, "documents"), tokenizer))


def op11_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op12_accumulator_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_captures": op1_warc_captures,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_token_counts": op3_token_counts,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_quality_rules": op5_quality_rules,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_license_scan": op7_license_scan,
    "op8_closed_syncmers": op8_closed_syncmers,
    "op9_max_plus_encoding": op9_max_plus_encoding,
    "op10_token_files": op10_token_files,
    "op11_skip_chain_pii": op11_skip_chain_pii,
    "op12_accumulator_search": op12_accumulator_search,
    "op13_chebyshev_whitening": op13_chebyshev_whitening,
    "syncmer_passages": syncmer_passages,
}

__all__ = ["ORACLE", "QUERIES", "table"]
