"""Streaming forms: equal to the batch forms, and restartable from checkpoints."""

import time
import uuid

import pytest
from conftest import frame
from pyspark.sql import functions as F

from civicflow.operators import incidents, windows
from civicflow.operators.proximity import bus_bunching
from civicflow.sources import telemetry as tv
from civicflow.streaming import jobs
from civicflow.streaming.io import read_records, run_to_completion, stage_records, stage_slices, write_stream
from civicflow.streaming.stateful import bunching_stream, gridlock_stream


def _run_dir(tmp_path):
    return str(tmp_path / uuid.uuid4().hex[:8])


def _stream_of(spark, df, kind, run, slices=3):
    stage_records(tv.wire_records(df, kind), f"{run}/in", slices=slices)
    return read_records(spark, "files", path=f"{run}/in", options={"maxFilesPerTrigger": "1"})


def _alerts(df):
    return sorted((r.entityId, r.t_ms, r.description, r.sourceTimestamp) for r in df.collect())


def test_gridlock_stream_equals_batch(spark, tmp_path):
    waits = {"J1": [181, 190, 200, 210, 180, 185, 185, 185], "J2": [200, 200, None, 200, 200, 200]}
    rows = [{"sec": 10 * i, "junction_id": j, "zone": "Z", "vehicle_count": 1, "signal_phase": "RED",
             "avg_wait_sec": None if w is None else float(w)} for j, ws in waits.items() for i, w in enumerate(ws)]
    df = frame(spark, rows, "junction_id string, zone string, vehicle_count int, signal_phase string, avg_wait_sec double")
    run = _run_dir(tmp_path)
    alerts = gridlock_stream(jobs.typed(_stream_of(spark, df, "traffic_signals", run), "traffic_signals"))
    run_to_completion(write_stream(alerts, "parquet", f"{run}/ck", path=f"{run}/out"))
    got = _alerts(spark.read.parquet(f"{run}/out"))
    assert got == _alerts(incidents.gridlock(df))
    assert [g[0] for g in got] == ["J1", "J1", "J2"]


def test_bunching_stream_equals_batch(spark, tmp_path):
    near, far = (28.401, 77.0), (28.402, 77.0)
    rows = []
    for t in range(0, 1021, 60):  # case d: re-arming every 5 minutes
        rows += [{"sec": t, "bus_id": "A", "lat": 28.4, "lon": 77.0}, {"sec": t, "bus_id": "B", "lat": near[0], "lon": near[1]}]
    rows += [{"sec": 0, "bus_id": "C", "lat": 28.4, "lon": 77.0}, {"sec": 10, "bus_id": "D", "lat": near[0], "lon": 77.0},
             {"sec": 311, "bus_id": "D", "lat": far[0], "lon": far[1]}]  # case c on another route
    for r in rows:
        r["route_id"] = "R-1" if r["bus_id"] in "AB" else "R-2"
        r.update(speed_kmh=0.0, occupancy_pct=0.0)
    rows.sort(key=lambda r: r["sec"])
    df = frame(spark, rows, "bus_id string, lat double, lon double, route_id string, speed_kmh double, occupancy_pct double")
    run = _run_dir(tmp_path)
    alerts = bunching_stream(jobs.typed(_stream_of(spark, df, "bus_gps", run, slices=4), "bus_gps"))
    run_to_completion(write_stream(alerts, "parquet", f"{run}/ck", path=f"{run}/out"))
    got = _alerts(spark.read.parquet(f"{run}/out"))
    assert got == _alerts(bus_bunching(df))
    assert [g[0] for g in got] == ["A:B", "A:B", "C:D"]


def test_ward_history_restarts_from_checkpoint(spark, tmp_path):
    events = tv.read_table(spark, "/root/testdata/sf0.001", "events")
    meters = tv.smart_meters(events)
    recs = tv.wire_records(meters, "smart_meters")
    run = _run_dir(tmp_path)
    cut = recs.agg(F.percentile_approx("offset", 0.5)).first()[0]
    stage_records(recs.filter(F.col("offset") <= cut), f"{run}/in", slices=2)
    for attempt in range(2):  # the second run reads only the files added since the first
        stream = read_records(spark, "files", path=f"{run}/in", options={"maxFilesPerTrigger": "1"})
        hist, live = jobs.ward_energy_job(stream, f"{run}/hist", f"{run}/ck", live_path=f"{run}/live")
        run_to_completion(hist)
        run_to_completion(live)
        if attempt == 0:
            stage_records(recs.filter(F.col("offset") > cut), f"{run}/in", slices=2)
    got = spark.read.parquet(f"{run}/hist")
    max_t = meters.agg(F.max("t_ms")).first()[0]
    exp = windows.ward_energy(meters).filter(F.unix_millis("window.end") <= max_t - 45 * 60 * 1000)
    key = lambda df: sorted((r.ward_id, str(r.window.start), round(r.total_kwh_consumed, 6)) for r in df.collect())
    assert key(got) == key(exp)
    assert got.count() == got.select("ward_id", "window").distinct().count()  # each window written once


def test_stream_detectors_skip_records_without_event_time(spark, tmp_path):
    rows = [(1, "traffic_signals", '{"junction_id":"J","zone":"Z","avg_wait_sec":200.0,"timestamp":"bad"}'),
            (2, "traffic_signals", '{"junction_id":"J","zone":"Z","avg_wait_sec":200.0,"timestamp":"2024-01-01T00:00:01Z"}'),
            (3, "bus_gps", '{"bus_id":null,"route_id":"R","lat":1.0,"lon":1.0,"timestamp":"2024-01-01T00:00:01Z"}')]
    run = _run_dir(tmp_path)
    spark.createDataFrame(rows, "offset long, topic string, value string").coalesce(1).write.json(f"{run}/in")
    recs = read_records(spark, "files", path=f"{run}/in")
    traffic = jobs.typed(recs.filter("topic = 'traffic_signals'"), "traffic_signals")
    bus = jobs.typed(recs.filter("topic = 'bus_gps'"), "bus_gps")
    q1 = write_stream(gridlock_stream(traffic), "parquet", f"{run}/ck1", path=f"{run}/o1")
    q2 = write_stream(bunching_stream(bus), "parquet", f"{run}/ck2", path=f"{run}/o2")
    run_to_completion(q1)
    run_to_completion(q2)


def test_empty_replay_runs(spark, tmp_path):
    run = _run_dir(tmp_path)
    empty = spark.createDataFrame([], "topic string, offset long, value string")
    assert stage_records(empty, f"{run}/in") == 0
    stream = read_records(spark, "files", path=f"{run}/in")
    run_to_completion(write_stream(jobs.typed(stream, "air_quality"), "parquet", f"{run}/ck", path=f"{run}/out"))
    assert spark.read.schema("seq long").parquet(f"{run}/out").count() == 0


def test_staged_slices_have_exact_file_counts_and_keep_their_order(spark, tmp_path):
    """A slice with few rows or none still has its files, so micro-batches are slices."""
    recs = spark.range(1, 41).select(F.lit("t").alias("topic"), F.col("id").alias("offset"),
                                     F.lit("{}").alias("value"))
    part = F.when(F.col("offset") <= 38, F.lit(0)).otherwise(F.lit(2))
    path = str(tmp_path / "in")
    stage_slices(recs.withColumn("_slice", part), path, "_slice", slices=3, files_per_slice=4)
    assert read_records(spark, path=path, bounded=True).count() == 40
    stream = read_records(spark, path=path, options={"maxFilesPerTrigger": "4"})
    run_to_completion(write_stream(stream.select("offset"), "update_log", str(tmp_path / "ck"),
                                   path=str(tmp_path / "log")))
    log = spark.read.parquet(str(tmp_path / "log")).groupBy("batch_id").agg(
        F.min("offset").alias("lo"), F.max("offset").alias("hi"))
    assert sorted(map(tuple, log.collect())) == [(0, 1, 38), (2, 39, 40)]


def test_throttled_subscriber_takes_one_slice_per_batch(spark, tmp_path):
    from civicflow.streaming import jobs
    from civicflow.streaming.io import read_records, run_to_completion, stage_records

    rows = [("traffic_signals", i, '{"junction_id":"J","vehicle_count":1}') for i in range(40)]
    recs = spark.createDataFrame(rows, "topic string, offset long, value string")
    stage_records(recs, str(tmp_path / "in"), slices=4, files_per_slice=2)
    batches = {}
    for name, options in (("fast", {}), ("slow", {"maxFilesPerTrigger": "2"})):
        stream = read_records(spark, "files", path=str(tmp_path / "in"), options=options)
        query = jobs.subscriber_job(stream, name, str(tmp_path / name), str(tmp_path / f"ckpt-{name}"))
        run_to_completion(query)
        batches[name] = sum(q.numInputRows > 0 for q in query.recentProgress)
        assert spark.read.parquet(str(tmp_path / name)).count() == 40
    assert batches == {"fast": 1, "slow": 4}


@pytest.mark.parametrize("sink", ["memory", "console"])
def test_debug_sinks_with_the_production_trigger(spark, tmp_path, sink):
    rows = [{"sec": i, "junction_id": "J", "zone": "Z", "vehicle_count": i, "signal_phase": "RED", "avg_wait_sec": 1.0} for i in range(3)]
    df = frame(spark, rows, "junction_id string, zone string, vehicle_count int, signal_phase string, avg_wait_sec double")
    run = _run_dir(tmp_path)
    signals = jobs.typed(_stream_of(spark, df, "traffic_signals", run, slices=1), "traffic_signals")
    query = write_stream(signals, sink, f"{run}/ck", trigger=jobs.PRODUCTION_TRIGGER, query_name=f"debug_{sink}")
    try:
        limit = time.monotonic() + 90
        while not any(p.numInputRows for p in query.recentProgress) and time.monotonic() < limit:
            time.sleep(0.2)
        assert any(p.numInputRows for p in query.recentProgress)
        assert query.isActive and query.exception() is None  # it waits for the next 30 seconds, and never ends by itself
        if sink == "memory":
            assert sorted(r.vehicle_count for r in spark.table("debug_memory").collect()) == [0, 1, 2]
    finally:
        query.stop()
