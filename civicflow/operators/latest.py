"""Latest record per key (the newest known position of every bus)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: list[str], order: list[str], cols: list[str]
) -> DataFrame:
    """For each key, the values of the row with the greatest ``order`` tuple.

    ``max_by`` is a partial aggregate: combined map-side, so a hot key never
    gathers its rows in one task.
    """
    best = F.max_by(F.struct(*cols), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_best")[c].alias(c) for c in cols])
