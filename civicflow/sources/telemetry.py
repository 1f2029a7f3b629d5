"""Telemetry streams derived from the driver's ``events`` table.

The reference consumes four JSON streams (bus GPS, traffic signals, air
quality, smart meters).  The test data ships one generic ``events`` table, so
each stream is a pure projection of it (no shuffle, only ``event_id``, ``ts``,
``user_id`` and ``value`` are read from Parquet).  Event time is compressed 60x
so that minute-scale windows hold many rows.

Every view carries
  ``seq``        the arrival order (``event_id``; zero time inversions),
  ``t_ms``       event time in epoch milliseconds (floored),
  ``event_time`` the same instant as TIMESTAMP (UTC session),
  ``timestamp``  the ISO-8601 wire string of the record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow import schemas

# Fixed values of the derived views (shared with the DuckDB oracle text).
EPOCH_MS = 1704067200000          # 2024-01-01T00:00:00Z
TIME_COMPRESSION = 60             # 30 days of events become 12 hours
HISTORY_STRETCH = 4               # for long histories they become 120 days
SIGNAL_PHASES = ("RED", "GREEN", "YELLOW")
ISO_MS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ensure_parallelism(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster has cores
    (e.g. one file with one row group) with a round-robin repartition.

    A large input already scans in many splits and is returned unchanged, so
    this costs nothing at scale.  Filters and column pruning still reach the
    Parquet scan below the repartition.
    """
    if df.isStreaming:
        return df
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= target:
            return df
    except Exception:  # no RDD view (e.g. Spark Connect): leave the plan alone
        return df
    return df.repartition(target)


def _dbl(x: float) -> Column:
    return F.lit(float(x)).cast("double")


def _base(events: DataFrame, time_scale: str = f"div {TIME_COMPRESSION}") -> DataFrame:
    t_ms = F.lit(EPOCH_MS) + F.expr(f"(unix_millis(cast(ts AS timestamp)) - {EPOCH_MS}) {time_scale}")
    return (
        events.select(
            F.col("event_id").alias("seq"),
            F.col("user_id").alias("_u"),
            F.col("value").alias("_v"),
            t_ms.alias("t_ms"),
        )
        .withColumn("event_time", F.timestamp_millis("t_ms"))
        .withColumn("timestamp", F.date_format("event_time", ISO_MS_FORMAT))
    )


def _tag(prefix: str, n: Column) -> Column:
    return F.concat(F.lit(prefix), n.cast("string"))


def smart_meters(events: DataFrame) -> DataFrame:
    b = _base(events)
    e, u, v = F.col("seq"), F.col("_u"), F.col("_v")
    return b.select(
        "seq", "t_ms", "event_time", "timestamp",
        _tag("SM-", 1000 + u).alias("meter_id"),
        _tag("WARD-", u % 5 + 1).alias("ward_id"),
        (v / _dbl(100)).alias("kwh_reading"),
        (_dbl(220) + (e % 201) / _dbl(10)).alias("voltage"),
        (_dbl(0.7) + (e % 31) / _dbl(100)).alias("power_factor"),
    )


def smart_meters_history(events: DataFrame) -> DataFrame:
    """Meter readings over several months, every 13th without a power factor."""
    b = _base(events, f"* {HISTORY_STRETCH}")
    e, u, v = F.col("seq"), F.col("_u"), F.col("_v")
    return b.select(
        "seq", "t_ms", "event_time", "timestamp",
        _tag("SM-", 1000 + u).alias("meter_id"),
        _tag("WARD-", u % 5 + 1).alias("ward_id"),
        (v / _dbl(100)).alias("kwh_reading"),
        (_dbl(220) + (e % 201) / _dbl(10)).alias("voltage"),
        F.when(e % 13 != 0, _dbl(0.7) + (e % 31) / _dbl(100)).alias("power_factor"),
    )


def air_quality(events: DataFrame) -> DataFrame:
    b = _base(events)
    e, u, v = F.col("seq"), F.col("_u"), F.col("_v")
    return b.select(
        "seq", "t_ms", "event_time", "timestamp",
        _tag("AQI-", u % 100 + 1).alias("sensor_id"),
        _tag("ZONE-", u % 7 + 1).alias("zone"),
        v.alias("pm25"),
        (v * _dbl(1.5)).alias("pm10"),
        F.when(e % 20 == 0, F.lit(None).cast("int"))
        .otherwise(F.floor(v * _dbl(3)).cast("int")).alias("aqi"),
    )


def traffic_signals(events: DataFrame) -> DataFrame:
    b = _base(events)
    e, u, v = F.col("seq"), F.col("_u"), F.col("_v")
    phase = F.element_at(F.array(*[F.lit(p) for p in SIGNAL_PHASES]), (e % 3 + 1).cast("int"))
    return b.select(
        "seq", "t_ms", "event_time", "timestamp",
        _tag("JUNC-", 100 + u % 400).alias("junction_id"),
        _tag("ZONE-", u % 400 % 6 + 1).alias("zone"),
        F.floor(v).cast("int").alias("vehicle_count"),
        (v * _dbl(4)).alias("avg_wait_sec"),
        phase.alias("signal_phase"),
    )


def bus_gps(events: DataFrame) -> DataFrame:
    b = _base(events)
    e, u, v = F.col("seq"), F.col("_u"), F.col("_v")
    lat = (
        F.when(e % 97 == 0, F.lit(None).cast("double"))
        .when(e % 89 == 0, _dbl(95.0))
        .otherwise(_dbl(28.40) + ((F.expr("t_ms div 900000") * 37 + (u % 30) * 11) % 7) * _dbl(0.0005))
    )
    lon = (
        F.when(e % 83 == 0, _dbl(-190.0))
        .otherwise(_dbl(77.00) + ((F.expr("t_ms div 600000") * 5 + (u % 30)) % 3) * _dbl(0.0003))
    )
    return b.select(
        "seq", "t_ms", "event_time", "timestamp",
        _tag("BUS-", 1000 + u % 30).alias("bus_id"),
        _tag("R-", u % 30 % 6 + 1).alias("route_id"),
        lat.alias("lat"),
        lon.alias("lon"),
        (v % 65).alias("speed_kmh"),
        (_dbl(10) + v % 90).alias("occupancy_pct"),
    )


VIEWS = {
    "smart_meters": smart_meters,
    "air_quality": air_quality,
    "traffic_signals": traffic_signals,
    "bus_gps": bus_gps,
}


def view(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return VIEWS[kind](read_table(spark, sf_dir, "events"))


def wire_records(df: DataFrame, kind: str) -> DataFrame:
    """Kafka-shaped rows ``(topic, offset, value)``: the record as a JSON string.

    ``offset`` is the arrival order.  The value holds exactly the wire fields of
    the stream's schema (nulls written as ``null``); event time travels
    inside as the ISO string.
    """
    fields = [f.name for f in schemas.BY_KIND[kind].fields]
    return df.select(
        F.lit(kind).alias("topic"),
        F.col("seq").alias("offset"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


# Static lookups (the reference ships them as small CSV files).  They are built
# by rule; the driver tables hold nothing to derive them from.
ZONE_COUNT = 6
ROUTE_COUNT = 5


def zone_profile(spark: SparkSession) -> DataFrame:
    k = F.col("id")
    return spark.range(1, ZONE_COUNT + 1).select(
        _tag("ZONE-", k).alias("zone"),
        (k * 10000).cast("int").alias("population"),
        k.cast("int").alias("num_schools"),
    )


def route_schedule(spark: SparkSession) -> DataFrame:
    k = F.col("id")
    return spark.range(1, ROUTE_COUNT + 1).select(
        _tag("R-", k).alias("route_id"),
        _tag("Line ", k).alias("route_name"),
        _tag("T-", k % 3 + 1).alias("terminal"),
        F.concat(F.lit("1"), k.cast("string"), F.lit(":00:00")).alias("scheduled_arrival_time"),
    )
