"""Exact per-key look-back that does not put a hot key in one task.

``lag(c, k) OVER (PARTITION BY key ORDER BY t, seq)`` sends every row of a key
to one task.  Here the key's rows are split into event-time buckets.  From the
``n``-th row of a bucket on, all looked-at rows lie in the bucket, so a window
over ``(key, bucket)`` is enough.  The first ``n`` rows of a bucket look back
at each other and at last rows of earlier buckets: a second window, over the
key, holds the first and the last ``n`` rows of every bucket only.  Its rows
grow with the time covered, not with the number of rows.

Both windows read the same exchange of the input by (key, bucket), which the
planner reuses: one scan and one full shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_MS = 3_600_000


def floor_div(c, n: int):
    """Exact integer floor division of a long column (also for negatives)."""
    return ((c - F.pmod(c, F.lit(n))) / F.lit(n)).cast("long")


def with_lookback(
    df: DataFrame,
    key: str | list[str],
    t: str,
    seq: str,
    cols: list[str],
    n: int,
    bucket_ms: int = DEFAULT_BUCKET_MS,
) -> DataFrame:
    """Add ``{c}_lag{k}`` for ``k`` in 1..n and ``_has_lag{k}`` (row exists).

    Order is (t, seq), nulls first as in any window; rows with a null key form
    a key of their own.
    """
    keys = [key] if isinstance(key, str) else list(key)
    names = df.columns

    def lags(w):
        found = [F.lag(c, k).over(w).alias(f"{c}_lag{k}") for k in range(1, n + 1) for c in cols]
        return found + [F.lag(F.lit(True), k, False).over(w).alias(f"_has_lag{k}") for k in range(1, n + 1)]

    in_bucket = Window.partitionBy(*keys, "_bkt").orderBy(F.col(t), F.col(seq))
    placed = df.withColumn("_bkt", floor_div(F.col(t), bucket_ms)).select(
        *names, "_bkt", F.row_number().over(in_bucket).alias("_pos"),
        F.lead(F.lit(False), n, True).over(in_bucket).alias("_tail"),
    )
    inner = placed.select(*names, "_pos", *lags(in_bucket)).filter(F.col("_pos") > n)
    edges = placed.filter((F.col("_pos") <= n) | F.col("_tail"))
    in_key = Window.partitionBy(*keys).orderBy(F.col(t), F.col(seq))
    first = edges.select(*names, "_pos", *lags(in_key)).filter(F.col("_pos") <= n)
    return inner.unionByName(first).drop("_pos")


def with_lookahead(
    df: DataFrame,
    key: str | list[str],
    t: str,
    seq: str,
    cols: list[str],
    bucket_ms: int = DEFAULT_BUCKET_MS,
) -> DataFrame:
    """Add ``{c}_next`` (the next row of the key in (t, seq) order) and
    ``_has_next``; the mirror image of ``with_lookback`` with ``n = 1``."""
    neg = (
        df.withColumn("_nt", -F.col(t))
        .withColumn("_nseq", -F.col(seq))
    )
    out = with_lookback(neg, key, "_nt", "_nseq", cols, 1, bucket_ms)
    ren = {f"{c}_lag1": f"{c}_next" for c in cols}
    for a, b_ in ren.items():
        out = out.withColumnRenamed(a, b_)
    return out.withColumnRenamed("_has_lag1", "_has_next").drop("_nt", "_nseq")
