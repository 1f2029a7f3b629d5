"""Stream x static lookup enrichment (route schedule onto bus pings)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from civicflow.operators.lookup import dedupe_last


def enrich(
    df: DataFrame,
    lookup: DataFrame,
    on: str,
    how: str = "inner",
    order: str | None = None,
) -> DataFrame:
    """Attach every lookup column to each row whose ``on`` key matches.

    * duplicate keys in the lookup: the row with the greatest ``order`` wins
      (the last CSV line); without ``order`` the lookup must already be unique;
    * lookup fields overwrite same-named fields of the record;
    * ``how='inner'`` drops records whose key has no lookup row.
    The lookup is broadcast only after its size is checked.
    """
    if order is not None:
        lookup = dedupe_last(lookup, on, order)
    extra = [c for c in lookup.columns if c != on]
    left = df.drop(*[c for c in extra if c in df.columns])
    return left.join(lookup, on, how)
