"""A corpus pipeline: documents in, token ids out.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor
kept and returns the documents it keeps, with their columns; the last one
returns token ids.  ``run`` writes every stage as Parquet under the shared
folder and reads it again, so a stage never recomputes those before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.llm import bpe, mixing, near_dedup, quality, secrets
from civicflow.llm.catalog import tokenizer_path
from civicflow.llm.common import read_table
from civicflow.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the current policy rejects."""
    return quality.apply_policy(quality.ledger(docs), "v2").where("kept").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every near-duplicate class."""
    return near_dedup.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; small sources up to twice as often."""
    return mixing.mix(docs, max_passes=2.0).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) of every document."""
    encoder = bpe.ByteBPE(spark, tokenizer_path("byte_bpe_50k.json"))
    tokens = encoder.round_trip(docs.select("doc_id", "source", "text"))
    return tokens.select(
        "doc_id", "source", bpe.n_tokens(F.col("ids")).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixture", mix_sources),
    ("tokens", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage{number}")
    return docs


#: Tokens, sketches and decoded secrets are beyond SQL; tests/llm/test_pipeline.py
#: holds the rows against a brute-force version instead.
ORACLE_SQL = None
