"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as it is; Spark's own scan splitting decides the tasks."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(columns: list[str], *names: str) -> list[str]:
    """``names`` for working columns, each with underscores before it until no
    input column has it (whatever the case)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def per_process(key, build):
    """``build()`` once for each Python worker process and ``key``.

    Functions are pickled by value, so module globals start afresh in every
    task; reused workers keep what is stored here.  Only the last ``key`` is
    kept: a worker that goes on to another operator frees what it held.
    """
    kept = sys.__dict__.setdefault("_civicflow_llm_kept", {})
    if key not in kept:
        kept.clear()
        kept[key] = build()
    return kept[key]


class BoundedMemo(dict):
    """Memo of a pure function that holds at most ``limit`` entries in two
    generations: when the young one is full it becomes the old one, so that
    what is used often stays (a dropped entry is computed again)."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.half, self.old = compute, limit // 2 or 1, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def shared_uri(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme that Spark's own readers and writers take for it
    (without one: that of ``fs.defaultFS``), so that tasks open the same file
    system.  One that they can't open is an error here, before any job."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    store_uri(uri)
    return uri


#: Schemes of Hadoop and those under which the same store is opened in tasks.
STORES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def store_uri(uri: str) -> str:
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        raise ValueError(f"{uri} has no scheme: give file:, hdfs:, s3a: or the like")
    if scheme not in STORES:
        raise ValueError(f"files under {scheme}: can't be opened in tasks; known are {', '.join(STORES)}")
    return f"{STORES[scheme]}:{rest if rest.startswith('//') else '//' + rest}"


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and inner path of a shared folder (file:, hdfs:, s3a:, ...).
    Without a scheme that is an error: it would be the disk of one machine."""
    return pafs.FileSystem.from_uri(store_uri(uri))


def write_file(uri: str, data_parts) -> int:
    """Write the byte strings of ``data_parts`` to a new file; the number of bytes.

    Callers put the task attempt into the name and publish the name in a
    manifest, so a lost or repeated attempt leaves at most an unused file.
    """
    store, path = open_store(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    n = 0
    with store.open_output_stream(path, compression=None) as out:
        for part in data_parts:
            out.write(part)
            n += len(part)
    return n


def read_range(uri: str, offset: int, length: int) -> bytes:
    store, path = open_store(uri)
    with store.open_input_file(path) as f:
        f.seek(offset)
        return f.read(length)
