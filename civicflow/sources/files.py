"""File sources: JSON-lines records and CSV lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from civicflow.functions.timecols import event_time_from_iso
from civicflow.operators.lookup import dedupe_last, with_line_order


def read_jsonl(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    stream: bool = False,
    mode: str = "PERMISSIVE",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Typed records from JSON-lines files (one record per line), batch or stream.

    The schema is declared, never inferred; ``event_time``/``t_ms`` come from
    the ISO ``timestamp`` field when the schema has one.
    """
    reader = spark.readStream if stream else spark.read
    reader = reader.schema(schema).option("mode", mode)
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.json(path)
    return event_time_from_iso(df) if "timestamp" in schema.fieldNames() else df


def read_lookup_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    key: str | None = None,
) -> DataFrame:
    """A static lookup from CSV files with a header and a declared schema.

    With ``key``, a key repeated on several lines keeps its *last* line, as a
    dictionary built line by line would (a plain join would multiply rows);
    of several files the one with the last name comes last.
    """
    df = spark.read.option("header", "true").schema(schema).csv(path)
    if key is None:
        return df
    return dedupe_last(with_line_order(df), key, "_line")
