"""Detectors that emit incident alerts, and their union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.functions import alerts as A
from civicflow.functions.jsonio import to_json_value
from civicflow.operators.runs import (
    GRIDLOCK_CYCLES, GRIDLOCK_WAIT_SEC, consecutive_runs, gridlock_breach,
)

# Fixed value: the emergency threshold.
AQI_EMERGENCY_THRESHOLD = 300


def aqi_emergency(
    aqi: DataFrame, threshold: int = AQI_EMERGENCY_THRESHOLD, detected_at: Column | None = None
) -> DataFrame:
    """One alert per reading with ``aqi > threshold`` (null AQI never fires).

    Stateless: the same function runs on a batch or a streaming DataFrame.
    """
    hits = aqi.filter(F.col("aqi") > F.lit(threshold))
    desc = F.format_string(A.AQI_TEMPLATE, F.col("aqi"), F.lit(threshold), F.col("sensor_id"))
    return hits.select(
        *A.alert_columns(A.AQI_EMERGENCY, F.col("sensor_id"), F.col("zone"), desc,
                         F.col("timestamp"), detected_at),
        "t_ms", "seq",
    )


def gridlock(
    traffic: DataFrame,
    threshold: float = GRIDLOCK_WAIT_SEC,
    cycles: int = GRIDLOCK_CYCLES,
    detected_at: Column | None = None,
    order: str = "event_time",
) -> DataFrame:
    """Alert on the row completing ``cycles`` consecutive waits above ``threshold``."""
    t = "t_ms" if order == "event_time" else "seq"
    fired = consecutive_runs(traffic, "junction_id", gridlock_breach("avg_wait_sec", threshold),
                             cycles, t=t, seq="seq")
    desc = F.format_string(
        A.GRIDLOCK_TEMPLATE, F.col("junction_id"), F.col("avg_wait_sec"),
        F.lit(int(threshold)), F.lit(cycles), F.col("zone"),
    )
    return fired.select(
        *A.alert_columns(A.GRIDLOCK, F.col("junction_id"), F.col("zone"), desc,
                         F.col("timestamp"), detected_at),
        "t_ms", "seq",
    )


def union_alerts(*alerts: DataFrame) -> DataFrame:
    """Bag union of alert streams (no de-duplication)."""
    cols = list(A.ALERT_COLUMNS) + ["t_ms"]
    out = None
    for a in alerts:
        a = a.select(*cols)
        out = a if out is None else out.unionByName(a)
    return out


def alerts_json(alerts: DataFrame) -> DataFrame:
    """Incident topic rows: value = camelCase JSON with nulls kept."""
    return alerts.select(to_json_value(list(A.ALERT_COLUMNS)).alias("value"))
