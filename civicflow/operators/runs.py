"""Consecutive-run detection (gridlock): fire when a per-key run of breaching
rows reaches exactly ``n``.

Row ``r`` fires iff rows ``r, r-1, ..., r-n+1`` of its key breach and row
``r-n`` does not exist or does not breach.  That is the reference's counter
(+1 on breach, reset on non-breach, fire on ``== n``) written as a bounded
look-back, so it needs no running state and no per-key global order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.operators.sequence import DEFAULT_BUCKET_MS, with_lookback

# Breach threshold (seconds of wait) and run length.
GRIDLOCK_WAIT_SEC = 180.0
GRIDLOCK_CYCLES = 3


def consecutive_runs(
    df: DataFrame,
    key: str,
    breach: Column,
    n: int = GRIDLOCK_CYCLES,
    t: str = "t_ms",
    seq: str = "seq",
    bucket_ms: int = DEFAULT_BUCKET_MS,
) -> DataFrame:
    """Rows at which a run of exactly ``n`` breaches is completed.

    ``breach`` null counts as no breach (a missing wait reads as 0 in the
    reference).  Order is (t, seq); pass ``t=seq`` for arrival order.
    """
    usable = df.filter(F.col("t_ms").isNotNull() & F.col(key).isNotNull())  # as the stream form
    flagged = usable.withColumn("_breach", F.coalesce(breach, F.lit(False)))
    looked = with_lookback(flagged, key, t, seq, ["_breach"], n, bucket_ms)
    fire = F.col("_breach")
    for k in range(1, n):
        fire = fire & F.col(f"_has_lag{k}") & F.col(f"_breach_lag{k}")
    fire = fire & ~(F.col(f"_has_lag{n}") & F.coalesce(F.col(f"_breach_lag{n}"), F.lit(False)))
    drop = ["_breach"] + [c for c in looked.columns if "_lag" in c]
    return looked.filter(fire).drop(*drop)


def gridlock_breach(wait_col: str = "avg_wait_sec", threshold: float = GRIDLOCK_WAIT_SEC) -> Column:
    return F.coalesce(F.col(wait_col), F.lit(0.0)) > F.lit(threshold)
