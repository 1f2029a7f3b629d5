"""Registered streaming queries.

Each one replays telemetry derived from the driver's ``events`` table as a
file stream (Kafka-shaped JSON records, written in consecutive offset ranges
under the shared checkpoint folder), runs the streaming job with
``availableNow`` and returns the sink's content read back as a batch
DataFrame.  The rows equal the batch operators' results (for append mode:
the windows the final watermark has closed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.operators import windows
from civicflow.operators.history import History, WardRollup
from civicflow.plans.catalog import ALERT_OUT, BUNCHING_EXPIRY_MS, _r6, _r6_mean, _ts, _views, corrupt_wire, no_object_wire
from civicflow.sources import telemetry as tv
from civicflow.streaming import jobs
from civicflow.streaming.io import (
    latest_from_update_log, new_run_dir, read_records, run_to_completion, slice_of, stage_records,
    stage_slices, write_stream,
)
from civicflow.streaming.late import late_feed_job, read_feeds, window_amendments
from civicflow.streaming.process import Silence, process_batch, process_stream
from civicflow.streaming.stateful import bunching_stream, gridlock_stream

REPLAY_SLICES = 4
# The two consumer groups of the traffic topic.
HIGH_PRIORITY, STANDARD_PRIORITY = "HIGH_PRIORITY", "STANDARD_PRIORITY"


def _state_partitions(spark: SparkSession) -> int:
    """State partitions of the replay queries: one per core of the cluster."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _files_per_slice(spark: SparkSession) -> int:
    """Files (and writing tasks) of a replay slice: one per core of the cluster."""
    return _state_partitions(spark)


def _replay(spark: SparkSession, sf_dir: str, kinds: list[str], name: str):
    """Stage the given streams (merged in offset order) and open a file stream
    that reads one slice per micro-batch."""
    recs = None
    for kind, v in zip(kinds, _views(spark, sf_dir, *kinds)):
        r = tv.wire_records(v, kind)
        recs = r if recs is None else recs.unionByName(r)
    return _replay_records(spark, recs, name)


def _replay_records(spark: SparkSession, recs: DataFrame, name: str):
    run = new_run_dir(spark, name)
    files = _files_per_slice(spark)
    stage_records(recs, f"{run}/input", slices=REPLAY_SLICES, files_per_slice=files)
    stream = read_records(spark, "files", path=f"{run}/input", options={"maxFilesPerTrigger": str(files)})
    return run, stream


def _ward_out(df: DataFrame) -> DataFrame:
    return df.select(
        "ward_id",
        _ts("window.start").alias("window_start"), _ts("window.end").alias("window_end"),
        F.date_format(F.to_date(F.col("window.start")), "yyyy-MM-dd").alias("date"),
        _r6("total_kwh_consumed").alias("total_kwh_consumed"),
        _r6_mean("avg_power_factor").alias("avg_power_factor"),
        _r6("peak_voltage").alias("peak_voltage"),
    )


def _run_ward_energy(spark: SparkSession, sf_dir: str, name: str) -> str:
    return _run_ward_job(spark, *_replay(spark, sf_dir, ["smart_meters"], name))


def _months_of_history(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The history table the ward job writes from several months of readings."""
    meters = tv.smart_meters_history(tv.read_table(spark, sf_dir, "events"))
    run = _run_ward_job(spark, *_replay_records(spark, tv.wire_records(meters, "smart_meters"), name))
    return spark.read.parquet(f"{run}/history")


def _run_ward_job(spark: SparkSession, run: str, stream: DataFrame) -> str:
    hist, live = jobs.ward_energy_job(stream, f"{run}/history", f"{run}/ckpt", live_path=f"{run}/live",
                                      state_partitions=_state_partitions(spark))
    run_to_completion(hist)
    run_to_completion(live)
    return run


def q_ward_energy_stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History sink: every window closed by the final watermark, written once."""
    run = _run_ward_energy(spark, sf_dir, "ward-energy")
    return _ward_out(spark.read.parquet(f"{run}/history"))


def q_ward_energy_stream_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live sink (update mode): the last emission per (ward, window) equals the
    complete batch aggregate."""
    run = _run_ward_energy(spark, sf_dir, "ward-energy-live")
    return _ward_out(latest_from_update_log(spark, f"{run}/live", ["ward_id", "window"]))


def q_ward_history_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ward officer's view of the history: partition filters on ward_id and
    date reach the Parquet listing (PartitionFilters), not a row scan."""
    hist = _months_of_history(spark, sf_dir, "ward-history")
    scoped = hist.filter((F.col("ward_id") == "WARD-3") & (F.col("date") >= F.lit("2024-03-01").cast("date")))
    return _ward_out(scoped)


def q_health_advisory_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, stream = _replay(spark, sf_dir, ["air_quality"], "advisory")
    q = jobs.health_advisory_job(stream, tv.zone_profile(spark), f"{run}/out", f"{run}/ckpt",
                                 state_partitions=_state_partitions(spark))
    run_to_completion(q)
    out = spark.read.parquet(f"{run}/out")
    return out.select("zone", _ts("window_end").alias("window_end"),
                      _r6("rolling_avg_aqi").alias("rolling_avg_aqi"), "population", "num_schools")


def q_health_advisory_stream_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The advisory feed in update mode (the reference's topic): a window is
    re-published whenever new readings change its mean while it is above the
    threshold; a window whose mean later falls back keeps its last published
    value (what a consumer of the topic holds at the end)."""
    run, stream = _replay(spark, sf_dir, ["air_quality"], "advisory-update")
    q = jobs.health_advisory_job(stream, tv.zone_profile(spark), f"{run}/log", f"{run}/ckpt",
                                 mode="update", sink="update_log", state_partitions=_state_partitions(spark))
    run_to_completion(q)
    latest = latest_from_update_log(spark, f"{run}/log", ["zone", "window_end"])
    return latest.select("zone", _ts("window_end").alias("window_end"),
                         _r6("rolling_avg_aqi").alias("rolling_avg_aqi"), "population", "num_schools")


def q_aqi_emergency_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, stream = _replay(spark, sf_dir, ["air_quality"], "aqi-emergency")
    run_to_completion(jobs.aqi_emergency_job(stream, f"{run}/out", f"{run}/ckpt"))
    return spark.read.parquet(f"{run}/out").select(*ALERT_OUT)


def q_route_enrichment_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, stream = _replay(spark, sf_dir, ["bus_gps"], "enrichment")
    run_to_completion(jobs.route_enrichment_job(stream, tv.route_schedule(spark), f"{run}/out", f"{run}/ckpt"))
    out = spark.read.parquet(f"{run}/out")
    return out.select(
        "seq", "bus_id", "route_id", _r6("lat").alias("lat"), _r6("lon").alias("lon"),
        "timestamp", "route_name", "terminal", "scheduled_arrival_time",
    )


def q_dlq_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, stream = _replay(spark, sf_dir, ["air_quality", "bus_gps"], "dlq")
    run_to_completion(jobs.dead_letter_job(stream, f"{run}/out", f"{run}/ckpt"))
    j = F.col("dlq_value")
    return spark.read.parquet(f"{run}/out").select(
        F.get_json_object(j, "$.source_topic").alias("source_topic"),
        F.get_json_object(j, "$.error_reason").alias("error_reason"),
        "offset",
        F.coalesce(F.get_json_object(j, "$.original_record.sensor_id"),
                   F.get_json_object(j, "$.original_record.bus_id")).alias("entity_id"),
        F.get_json_object(j, "$.original_record.timestamp").alias("record_timestamp"),
    )


def q_dlq_malformed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged records through the streaming dead-letter job."""
    (aqi,) = _views(spark, sf_dir, "air_quality")
    run, stream = _replay_records(spark, no_object_wire(corrupt_wire(tv.wire_records(aqi, "air_quality"))), "dlq-malformed")
    run_to_completion(jobs.dead_letter_job(stream, f"{run}/out", f"{run}/ckpt"))
    return spark.read.parquet(f"{run}/out").select(
        F.get_json_object("dlq_value", "$.source_topic").alias("source_topic"),
        F.get_json_object("dlq_value", "$.error_reason").alias("error_reason"), "offset")


def q_gridlock_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, stream = _replay(spark, sf_dir, ["traffic_signals"], "gridlock")
    alerts = gridlock_stream(jobs.typed(stream, "traffic_signals"))
    run_to_completion(write_stream(alerts, "parquet", f"{run}/ckpt", path=f"{run}/out",
                                   state_partitions=_state_partitions(spark)))
    return spark.read.parquet(f"{run}/out").select(*ALERT_OUT)


def q_bus_bunching_stream(spark: SparkSession, sf_dir: str, expire_ms: int | None = None) -> DataFrame:
    run, stream = _replay(spark, sf_dir, ["bus_gps"], "bunching")
    alerts = bunching_stream(jobs.typed(stream, "bus_gps"), expire_ms=expire_ms)
    run_to_completion(write_stream(alerts, "parquet", f"{run}/ckpt", path=f"{run}/out",
                                   state_partitions=_state_partitions(spark)))
    return spark.read.parquet(f"{run}/out").select(*ALERT_OUT)


def q_bus_bunching_expiring_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bus_bunching_expiring`` with expiry timers in the stream's state."""
    return q_bus_bunching_stream(spark, sf_dir, BUNCHING_EXPIRY_MS)


def q_incidents_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incident feed from three streaming detectors (one query each)."""
    run = new_run_dir(spark, "incidents")
    aqi, traffic, bus = _views(spark, sf_dir, "air_quality", "traffic_signals", "bus_gps")
    streams, files = [], _files_per_slice(spark)
    for kind, v in (("air_quality", aqi), ("traffic_signals", traffic), ("bus_gps", bus)):
        stage_records(tv.wire_records(v, kind), f"{run}/in-{kind}", slices=REPLAY_SLICES, files_per_slice=files)
        streams.append(read_records(spark, "files", path=f"{run}/in-{kind}",
                                    options={"maxFilesPerTrigger": str(files)}))
    for q in jobs.incident_jobs(*streams, ckpt=f"{run}/ckpt", path=f"{run}/out",
                                state_partitions=_state_partitions(spark)):
        run_to_completion(q)
    return jobs.read_incidents(spark, f"{run}/out").select(*ALERT_OUT)


def q_priority_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two independent subscribers of the traffic topic; the standard one is
    throttled to one slice per trigger.  Both see every record."""
    run, files = new_run_dir(spark, "fanout"), _files_per_slice(spark)
    (traffic,) = _views(spark, sf_dir, "traffic_signals")
    stage_records(tv.wire_records(traffic, "traffic_signals"), f"{run}/input", slices=REPLAY_SLICES,
                  files_per_slice=files)
    outs = []
    for name, per_trigger in ((HIGH_PRIORITY, None), (STANDARD_PRIORITY, files)):
        opts = {"maxFilesPerTrigger": str(per_trigger)} if per_trigger else {}
        stream = read_records(spark, "files", path=f"{run}/input", options=opts)
        run_to_completion(jobs.subscriber_job(stream, name, f"{run}/{name}", f"{run}/ckpt-{name}"))
        outs.append(spark.read.parquet(f"{run}/{name}"))
    return outs[0].unionByName(outs[1])


#: Every 50th record comes three slices late: the watermark of a batch stems from
#: the batches up to the second before it.
LATE_EVERY, LATE_PHASE, LATE_BY = 50, 7, 3


def q_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late data: every 50th traffic record is delivered three replay slices late.
    A 1-minute count with a 10-second watermark drops the rows that are behind
    the watermark; closed windows are emitted once."""
    run = new_run_dir(spark, "late-rows")
    (traffic,) = _views(spark, sf_dir, "traffic_signals")
    recs = tv.wire_records(traffic, "traffic_signals")
    lo, hi = recs.agg(F.min("offset"), F.max("offset")).first()
    late = (F.col("offset") % LATE_EVERY == LATE_PHASE).cast("long") * LATE_BY
    staged = recs.withColumn("_slice", slice_of("offset", lo, hi, REPLAY_SLICES) + late)
    files = _files_per_slice(spark)
    stage_slices(staged, f"{run}/input", "_slice", REPLAY_SLICES + LATE_BY, files)
    stream = read_records(spark, "files", path=f"{run}/input", options={"maxFilesPerTrigger": str(files)})
    counts = (
        jobs.typed(stream, "traffic_signals")
        .withWatermark("event_time", jobs.DETECTOR_DELAY)
        .groupBy(F.window("event_time", "1 minute").alias("window"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    run_to_completion(write_stream(counts, "parquet", f"{run}/ckpt", path=f"{run}/out",
                                   state_partitions=_state_partitions(spark)))
    out = spark.read.parquet(f"{run}/out")
    return out.select(_ts("window.start").alias("window_start"), _ts("window.end").alias("window_end"), "n_rows")


def q_late_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same late delivery with the late rows kept: per minute the rows on time,
    the late ones, those that came after the minute was closed, and all."""
    run = new_run_dir(spark, "late-feed")
    (traffic,) = _views(spark, sf_dir, "traffic_signals")
    recs = tv.wire_records(traffic, "traffic_signals")
    lo, hi = recs.agg(F.min("offset"), F.max("offset")).first()
    late = (F.col("offset") % LATE_EVERY == LATE_PHASE).cast("long") * LATE_BY
    files = _files_per_slice(spark)
    stage_slices(recs.withColumn("_slice", slice_of("offset", lo, hi, REPLAY_SLICES) + late), f"{run}/input", "_slice", REPLAY_SLICES + LATE_BY, files)
    stream = read_records(spark, "files", path=f"{run}/input", options={"maxFilesPerTrigger": str(files)})
    run_to_completion(late_feed_job(jobs.typed(stream, "traffic_signals"), f"{run}/feeds", f"{run}/ckpt", 10_000))
    amended = window_amendments(*read_feeds(spark, f"{run}/feeds"), "1 minute")
    return amended.select(_ts("window.start").alias("window_start"), "n_on_time", "n_late", "n_after_close", "n_rows")


def reconcile(stream_rows: DataFrame, batch_rows: DataFrame) -> DataFrame:
    """Rows only one side has (bag semantics, both directions), tagged by side."""
    return stream_rows.exceptAll(batch_rows).withColumn("side", F.lit("stream_only")).unionByName(
        batch_rows.exceptAll(stream_rows).withColumn("side", F.lit("batch_only"))
    )


def _closed_windows(meters: DataFrame) -> DataFrame:
    """The batch form of what the stream has written: windows the watermark has closed."""
    max_t = meters.agg(F.max("t_ms")).first()[0]
    summary = windows.with_window_date(windows.ward_energy_with_counts(meters))
    return summary.filter(F.unix_millis(F.col("window.end")) <= F.lit(max_t - 45 * 60 * 1000))


def q_stream_batch_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch layer check: the stream's ward history against the batch form over
    the same input.  Per side its rows and those the other side does not have."""
    run = _run_ward_energy(spark, sf_dir, "reconcile")
    streamed = _ward_out(spark.read.parquet(f"{run}/history"))
    (meters,) = _views(spark, sf_dir, "smart_meters")
    closed = _ward_out(_closed_windows(meters))
    found = reconcile(streamed, closed).groupBy("side").agg(F.count("*").alias("n_unmatched"))
    sides = streamed.agg(F.count("*").alias("n_rows")).withColumn("side", F.lit("stream_only")).unionByName(
        closed.agg(F.count("*").alias("n_rows")).withColumn("side", F.lit("batch_only")))
    return sides.join(found, "side", "left").select("side", "n_rows", F.coalesce("n_unmatched", F.lit(0)).alias("n_unmatched"))


def _damaged_history(spark: SparkSession, sf_dir: str, name: str) -> tuple[History, DataFrame]:
    """A versioned history from a stream's output that lost and doubled windows,
    and the batch result for the same input."""
    run = _run_ward_energy(spark, sf_dir, name)
    lost = (F.col("ward_id") == "WARD-2") & (F.hour("window.start") % 5 == 0)
    twice = F.when((F.col("ward_id") == "WARD-3") & (F.hour("window.start") % 7 == 1), 2.0).otherwise(1.0)
    bad = spark.read.parquet(f"{run}/history").where(~lost).withColumn("total_kwh_consumed", F.col("total_kwh_consumed") * twice)
    (meters,) = _views(spark, sf_dir, "smart_meters")
    return History.create(bad, f"{run}/versions", ["ward_id", "date"]), _closed_windows(meters)


def q_ward_history_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch layer rewrites the partitions that differ from its own result."""
    history, truth = _damaged_history(spark, sf_dir, "corrected")
    history.correct(truth, ["ward_id", "window"])
    return _ward_out(history.read())


def q_ward_rollup_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly totals kept beside the history: made from the damaged version, then
    brought up to date from the corrected partitions alone."""
    history, truth = _damaged_history(spark, sf_dir, "rollup")
    rollup = WardRollup(history, f"{history.root}-sums")
    rollup.refresh()
    history.correct(truth, ["ward_id", "window"])
    rollup.refresh()
    return rollup.totals("week").select(
        "ward_id", _ts("period_start").alias("period_start"), _r6("total_kwh_consumed").alias("total_kwh_consumed"),
        _r6_mean("avg_power_factor").alias("avg_power_factor"), _r6("peak_voltage").alias("peak_voltage"), "n_readings")


#: A signal that says nothing for half an hour.
QUIET_MS = 30 * 60 * 1000


def _silence_out(found: DataFrame) -> DataFrame:
    return found.select("junction_id", "last_t_ms", "due_t_ms")


def q_signal_silence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silent junctions by a keyed process function with one timer a junction, over
    the table: what a stream with a 10-second watermark has found."""
    (traffic,) = _views(spark, sf_dir, "traffic_signals")
    return _silence_out(process_batch(traffic, ["junction_id"], Silence(QUIET_MS), [], delay_ms=10_000, end="open"))


def q_signal_silence_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same process function over a stream."""
    run, stream = _replay(spark, sf_dir, ["traffic_signals"], "silence")
    found = process_stream(jobs.typed(stream, "traffic_signals"), ["junction_id"], Silence(QUIET_MS), [], delay=jobs.DETECTOR_DELAY)
    run_to_completion(write_stream(found, "parquet", f"{run}/ckpt", path=f"{run}/out", state_partitions=_state_partitions(spark)))
    return _silence_out(spark.read.parquet(f"{run}/out"))


def q_ward_energy_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rollup(spark, sf_dir, "week")


def q_ward_energy_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rollup(spark, sf_dir, "month")


def _rollup(spark: SparkSession, sf_dir: str, unit: str) -> DataFrame:
    rolled = windows.rollup_history(_months_of_history(spark, sf_dir, f"ward-{unit}"), unit)
    return rolled.select(
        "ward_id", _ts("period_start").alias("period_start"),
        _r6("total_kwh_consumed").alias("total_kwh_consumed"),
        _r6_mean("avg_power_factor").alias("avg_power_factor"),
        _r6("peak_voltage").alias("peak_voltage"), "n_readings",
    )


STREAM_QUERIES = {
    "ward_energy_stream_append": q_ward_energy_stream_append,
    "ward_energy_stream_update": q_ward_energy_stream_update,
    "ward_history_pruned": q_ward_history_pruned,
    "health_advisory_stream": q_health_advisory_stream,
    "health_advisory_stream_update": q_health_advisory_stream_update,
    "aqi_emergency_stream": q_aqi_emergency_stream,
    "route_enrichment_stream": q_route_enrichment_stream,
    "dlq_stream": q_dlq_stream,
    "dlq_malformed_stream": q_dlq_malformed_stream,
    "gridlock_stream": q_gridlock_stream,
    "bus_bunching_stream": q_bus_bunching_stream,
    "bus_bunching_expiring_stream": q_bus_bunching_expiring_stream,
    "incidents_stream": q_incidents_stream,
    "priority_fanout": q_priority_fanout,
    "late_rows": q_late_rows,
    "late_feed": q_late_feed,
    "stream_batch_diff": q_stream_batch_diff,
    "ward_history_corrected": q_ward_history_corrected,
    "ward_rollup_corrected": q_ward_rollup_corrected,
    "signal_silence": q_signal_silence,
    "signal_silence_stream": q_signal_silence_stream,
    "ward_energy_weekly": q_ward_energy_weekly,
    "ward_energy_monthly": q_ward_energy_monthly,
}
