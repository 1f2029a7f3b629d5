"""Exact duplicates against a persistent digest index.

Texts are equal when identical without ASCII white space; their digest is the
SHA-256 of what is left.  The index is a Parquet table in a shared folder,
bucketed and sorted by digest, with one entry per distinct text: the digest,
the document that stays, and the batch that brought it.  A batch of documents
is deduplicated in four steps:

1. one pass over the texts writes a narrow table (document, length, digest);
2. it is grouped by digest (combined before the shuffle, so a text that makes
   up a third of all rows is a row per task);
3. the groups meet the index in a sort-merge anti-join, for which the index is
   not shuffled; those left are appended to it, bucket by bucket;
4. every document is told which one stays.  Groups of more than a thousandth
   of all rows (so at most a thousand groups) are broadcast; the others are
   joined by digest, and none of them is a hot key.

Of equal texts in a batch the longest stays (in code points, before the white
space goes), then the smallest id; a text that an earlier batch brought keeps
the document of that batch.  A batch that is repeated under its name, after a
lost driver for instance, finds its own entries, appends what is missing and
gives the same result.  One writer at a time.

Defined results: a null text counts as empty, and empty texts are equal to each
other; a null doc_id comes after all others; of repeated rows (same id and
text) one stays; further columns are ignored; an empty batch gives no rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.session import materialize, scratch_path

SPACE = " \t\n\x0b\x0c\r"
#: A group with more than this share of the rows of a batch is broadcast.
HOT_SHARE = 1000
ENTRIES = "digest BINARY, keep_id BIGINT, keep_chars BIGINT, batch STRING"


def normalised(text: str) -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), SPACE, "")


def digests(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """uid (a row number), doc_id, n_chars and digest of every row."""
    return documents.select(
        F.monotonically_increasing_id().alias("uid"), F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.length(text), F.lit(0)).cast("long").alias("n_chars"), F.unhex(F.sha2(normalised(text), 256)).alias("digest"))


def grouped(rows: DataFrame) -> DataFrame:
    """digest, copies and the row (doc_id, n_chars, uid) that stays of every distinct text."""
    first = F.min(F.struct((-F.col("n_chars")).alias("shorter"), F.col("doc_id").isNull().alias("last"), "doc_id", "uid"))
    return rows.groupBy("digest").agg(first.alias("first"), F.count("*").alias("copies")).select(
        "digest", "copies", F.col("first.doc_id").alias("own_id"), (-F.col("first.shorter")).alias("own_chars"), F.col("first.uid").alias("own_uid"))


class DigestIndex:
    """The index in folder ``root``; use ``create`` for a new one, ``open`` for an existing one."""

    def __init__(self, spark: SparkSession, root: str, buckets: int):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.table = "digests_" + hashlib.md5(self.root.encode()).hexdigest()
        location = f"{self.root}/entries".replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({ENTRIES}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{location}'")

    @classmethod
    def create(cls, spark: SparkSession, root: str, buckets: int | None = None) -> DigestIndex:
        """A new index.  ``buckets`` is fixed for its life: choose it for the size the
        index will have, a bucket being what one task sorts and merges (default: the
        number of shuffle partitions)."""
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.range(1).select(F.lit(buckets).alias("buckets")).write.json(f"{root.rstrip('/')}/layout")
        return cls(spark, root, buckets)

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> DigestIndex:
        return cls(spark, root, spark.read.json(f"{root.rstrip('/')}/layout").first()["buckets"])

    def entries(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def new_groups(self, groups: DataFrame) -> DataFrame:
        """The groups whose text the index does not hold."""
        return groups.join(self.entries().hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame, batch: str) -> None:
        """The join above leaves its rows dealt as the buckets are: one file a bucket."""
        new = groups.select("digest", F.col("own_id").alias("keep_id"), F.col("own_chars").alias("keep_chars"), F.lit(batch).alias("batch"))
        new.write.insertInto(self.table)

    def add(self, documents: DataFrame, batch: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Deduplicate a batch and append its new texts.

        One row per document: doc_id, n_chars, digest, keep_id and keep_chars (of the
        document that stays), known (an earlier batch brought the text), group_size
        (its rows in this batch) and kept.
        """
        rows = materialize(digests(documents, doc_id, text), "exact-rows")
        groups = materialize(grouped(rows), "exact-groups")
        self.append(self.new_groups(groups), batch)
        told = groups.join(self.entries().hint("merge"), "digest").select(
            "digest", "keep_id", "keep_chars", (F.col("batch") != batch).alias("known"), F.col("copies").alias("group_size"), "own_uid")
        told = materialize(told, "exact-told")
        hot = F.broadcast(told.where(F.col("group_size") * HOT_SHARE > rows.count()))  # fewer than HOT_SHARE rows
        in_hot = rows.join(hot, "digest")
        others = rows.join(hot.select("digest"), "digest", "left_anti").join(told, "digest")
        return in_hot.unionByName(others).select(
            "doc_id", "n_chars", "digest", "keep_id", "keep_chars", "known", "group_size",
            (~F.col("known") & (F.col("uid") == F.col("own_uid"))).alias("kept"))

    def compacted(self, root: str) -> DigestIndex:
        """The index rewritten in a new folder with one file a bucket."""
        out = DigestIndex.create(self.spark, root, self.buckets)
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))  # the whole of a bucket to one task
        self.entries().repartition(self.buckets, bucket).write.insertInto(out.table)
        return out


def deduplicated(documents: DataFrame) -> DataFrame:
    """Digest columns of every document, from an index made for this table alone."""
    spark = documents.sparkSession
    found = DigestIndex.create(spark, scratch_path(spark, "digest-index")).add(documents, "all")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
