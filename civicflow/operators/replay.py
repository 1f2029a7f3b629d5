"""Replay ingestion: the first N records of a JSON-lines source, keyed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.functions.jsonio import to_json_value

# Fixed value: records per replay.
REPLAY_LIMIT = 300


def replay(
    records: DataFrame,
    key: str,
    fields: list[str],
    order: str = "seq",
    limit: int | None = REPLAY_LIMIT,
) -> DataFrame:
    """``(key, value, order)`` rows for a keyed topic write.

    The limit is the feature (the reference replays the first 300 lines); it
    plans as a top-k (per-partition heaps, no global sort).
    """
    rows = records.select(
        F.col(key).cast("string").alias("key"),
        to_json_value(fields).alias("value"),
        F.col(order).alias("offset"),
    )
    return rows.orderBy("offset").limit(limit) if limit else rows
