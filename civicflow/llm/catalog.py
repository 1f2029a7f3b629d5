"""Registered queries of this subpackage: (spark, sf_dir) -> DataFrame.

Each is a thin view of its operator over the whole of its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civicflow.llm import (
    bpe, exact_dedup, lexical, licenses, mixing, near_dedup, periodic, quality, secrets, sharding, token_files, topk, warc,
)
from civicflow.llm.common import read_table


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(spark, read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.file_digests(spark, read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(read_table(spark, sf_dir, "documents"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read_table(spark, sf_dir, "embeddings"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.span_digests(read_table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(read_table(spark, sf_dir, "pages"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A budget of the corpus's own size, no source shown more than four times."""
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"), budget_ratio=1.0, max_passes=4.0)
    return mixed.select("doc_id", "source", "tokens", "epoch", "mix_key")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(periodic.with_planted_runs(read_table(spark, sf_dir, "documents")))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated(read_table(spark, sf_dir, "documents"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_token_files, op3_quality, op4_topk, op5_warc, op6_licenses, op7_secrets, op8_mixing, op9_shards, op10_near_dedup,
    op11_periodic, op12_exact_dedup, op13_lexical)}
