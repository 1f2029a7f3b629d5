"""Streaming jobs: the batch operators wired to stream sources and sinks.

Each builder takes a stream of Kafka-shaped records and returns started
queries (one per sink, each with its own checkpoint).  The default trigger is
``availableNow`` (backfill / tests); production passes
``{"processingTime": "30 seconds"}``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow import schemas
from civicflow.functions.jsonio import parse_records
from civicflow.operators import incidents, quality, windows
from civicflow.operators.enrich import enrich
from civicflow.streaming.io import kafka_rows, write_stream

PRODUCTION_TRIGGER = {"processingTime": "30 seconds"}
DETECTOR_DELAY = "10 seconds"


def typed(records: DataFrame, kind: str, mode: str = "permissive") -> DataFrame:
    """Parse one topic's JSON values; ``seq`` = arrival order (``arrival_seq``)."""
    numbered = records.withColumn("seq", arrival_seq(records.columns))
    return parse_records(numbered, schemas.BY_KIND[kind], mode=mode, keep=("seq",))


#: Partitions of a topic that ``arrival_seq`` tells apart.
PARTITION_BITS = 16


def arrival_seq(columns: list[str]):
    """A number that is unique in a topic and grows with the offset in each of its
    partitions: offset and partition in one long (a topic has fewer than 2^16
    partitions, a partition fewer than 2^47 records; more is an error).  Records
    without a partition (files) are numbered by their offset alone."""
    if "partition" not in columns:
        return F.col("offset")
    fits = (F.col("partition") < 1 << PARTITION_BITS) & (F.col("offset") < 1 << (63 - PARTITION_BITS))
    seq = F.shiftleft(F.col("offset").cast("long"), PARTITION_BITS).bitwiseOR(F.col("partition").cast("long"))
    return F.when(fits, seq).otherwise(F.raise_error(F.lit("partition or offset too large for arrival_seq")).cast("long"))


def ward_energy_job(records: DataFrame, history_path: str, ckpt: str, live_path: str | None = None,
                    live_sink: str = "update_log", topic: str | None = None, trigger: dict | None = None,
                    state_partitions: int | None = None):
    """Two sinks from one aggregation: a live feed in update mode and the
    15-minute history as Parquet partitioned by (ward_id, date), append mode
    (each window written once, when the 45-minute watermark closes it; the closed
    windows of a ward and day go to one file per micro-batch)."""
    meters = typed(records, "smart_meters")
    windowed = windows.ward_energy(meters, watermark=windows.WARD_WATERMARK)
    counted = windows.ward_energy_with_counts(meters, watermark=windows.WARD_WATERMARK)  # for roll-ups
    daily = windows.with_window_date(counted).repartition("ward_id", "date")
    hist = write_stream(daily, "parquet", f"{ckpt}/history", mode="append",
                        path=history_path, partition_by=["ward_id", "date"], trigger=trigger,
                        state_partitions=state_partitions)
    live_df = kafka_rows(windowed) if live_sink == "kafka" else windowed
    live = write_stream(live_df, live_sink, f"{ckpt}/live", mode="update", path=live_path, topic=topic,
                        trigger=trigger, state_partitions=state_partitions)
    return hist, live


def health_advisory_job(records: DataFrame, zones: DataFrame, path: str, ckpt: str,
                        mode: str = "append", sink: str = "parquet", topic: str | None = None,
                        trigger: dict | None = None, state_partitions: int | None = None):
    """Rolling AQI advisories; ``mode='update'`` re-emits a window whenever its
    mean changes while above the threshold (the reference's Kafka feed)."""
    aqi = typed(records, "air_quality")
    adv = windows.health_advisories(aqi, zones, watermark=windows.AQI_WATERMARK)
    out = kafka_rows(adv, key="zone") if sink == "kafka" else adv
    return write_stream(out, sink, ckpt, mode=mode, path=path, topic=topic, trigger=trigger,
                        state_partitions=state_partitions)


def aqi_emergency_job(records: DataFrame, path: str, ckpt: str, sink: str = "parquet",
                      topic: str | None = None, trigger: dict | None = None):
    alerts = incidents.aqi_emergency(typed(records, "air_quality"))
    out = incidents.alerts_json(alerts) if sink == "kafka" else alerts
    return write_stream(out, sink, ckpt, path=path, topic=topic, trigger=trigger)


def route_enrichment_job(records: DataFrame, routes: DataFrame, path: str, ckpt: str,
                         sink: str = "parquet", topic: str | None = None, trigger: dict | None = None):
    """Stream x static lookup (joined as the planner sees fit); misses dropped."""
    bus = typed(records, "bus_gps")
    out = enrich(bus, routes, on="route_id")
    if sink == "kafka":
        out = kafka_rows(out)
    return write_stream(out, sink, ckpt, path=path, topic=topic, trigger=trigger)


def dead_letter_job(records: DataFrame, path: str, ckpt: str, sink: str = "parquet",
                    topic: str | None = None, trigger: dict | None = None):
    """Multi-topic stream -> first-match rules -> dead-letter envelopes."""
    dead = quality.dead_letters(quality.classify(records))
    env = quality.envelope(dead)
    out = env.select(F.col("dlq_value").alias("value")) if sink == "kafka" else env
    return write_stream(out, sink, ckpt, path=path, topic=topic, trigger=trigger)


def subscriber_job(records: DataFrame, name: str, path: str, ckpt: str, trigger: dict | None = None):
    """One independent consumer of the traffic topic (own checkpoint = own
    offsets).  A throttled subscriber is a rate-limited source (set
    ``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger`` on ``records``), not a sleep."""
    traffic = typed(records, "traffic_signals")
    view = traffic.select(F.lit(name).alias("subscriber"), "seq", "junction_id", "signal_phase", "vehicle_count")
    return write_stream(view, "parquet", ckpt, path=path, trigger=trigger)


def dead_letter_report(spark, source: str = "kafka", topic: str = "dlq", path: str | None = None,
                       options: dict | None = None) -> DataFrame:
    """Bounded read of the whole dead-letter topic (earliest to latest, no
    stored offsets, so every run sees every message) -> counts per reason
    plus the total."""
    from civicflow.streaming.io import read_records

    msgs = read_records(spark, source, path=path, topics=[topic], bounded=True, options=options)
    return quality.report_from_messages(msgs)


def incident_jobs(aqi_records: DataFrame, traffic_records: DataFrame, bus_records: DataFrame,
                  ckpt: str, path: str | None = None, sink: str = "parquet", topic: str | None = None,
                  trigger: dict | None = None, state_partitions: int | None = None) -> list:
    """The incident feed: one streaming query per detector (each with its own
    watermark, state and checkpoint) writing the same feed.  Kafka: one topic,
    JSON values; Parquet: one folder per detector under ``path``, read back
    together with ``read_incidents``."""
    from civicflow.streaming.stateful import bunching_stream, gridlock_stream

    detectors = {
        "aqi_emergency": incidents.aqi_emergency(typed(aqi_records, "air_quality")),
        "gridlock": gridlock_stream(typed(traffic_records, "traffic_signals")),
        "bus_bunching": bunching_stream(typed(bus_records, "bus_gps")),
    }
    queries = []
    for name, alerts in detectors.items():
        feed = incidents.union_alerts(alerts)
        out = incidents.alerts_json(feed) if sink == "kafka" else feed
        queries.append(write_stream(out, sink, f"{ckpt}/{name}", path=f"{path}/{name}" if path else None,
                                    topic=topic, trigger=trigger, state_partitions=state_partitions))
    return queries


def read_incidents(spark, path: str) -> DataFrame:
    """The Parquet incident feed of ``incident_jobs`` as one DataFrame."""
    parts = [spark.read.parquet(f"{path}/{n}") for n in ("aqi_emergency", "gridlock", "bus_bunching")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
