"""Event-time columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def iso_to_timestamp(c: str | Column) -> Column:
    """ISO-8601 string (``...Z``, up to microseconds) -> TIMESTAMP; bad -> null."""
    return F.try_to_timestamp(F.col(c) if isinstance(c, str) else c)


def event_time_from_iso(df: DataFrame, field: str = "timestamp") -> DataFrame:
    """Add ``event_time`` (TIMESTAMP) and ``t_ms`` (floored epoch millis)."""
    return df.withColumn("event_time", iso_to_timestamp(field)).withColumn(
        "t_ms", F.unix_millis("event_time")
    )


def now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())
