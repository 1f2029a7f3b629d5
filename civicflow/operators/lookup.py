"""Static lookups: last-wins de-duplication and file line order.

Joins with a lookup carry no broadcast hint: the planner decides by the bytes
it knows (``spark.sql.autoBroadcastJoinThreshold``) and AQE by those it sees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_last(lookup: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """One row per key: the one with the greatest ``order`` (the last line wins).

    ``max_by`` aggregates partially before the shuffle, so a key that repeats a
    huge number of times costs one row per partition, not one task's memory.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in lookup.columns if c not in keys and c != order]
    best = F.max_by(F.struct(*rest), F.col(order)).alias("_best")
    return lookup.groupBy(*keys).agg(best).select(*keys, *[F.col("_best")[c].alias(c) for c in rest])


def with_line_order(df: DataFrame, name: str = "_line") -> DataFrame:
    """Order of the lines of a file read, also of several files and of files read
    in several splits: files by name, splits by their place in the file, and
    within a split (which one task reads from its beginning) row after row."""
    return df.select("*", F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row")).alias(name))
