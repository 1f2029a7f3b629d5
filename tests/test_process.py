"""Keyed process functions: batch, stream and a plain simulation agree."""

import random

import pytest
from conftest import EPOCH_MS, frame

from civicflow.operators.runs import consecutive_runs, gridlock_breach
from civicflow.sources import telemetry as tv
from civicflow.streaming import jobs
from civicflow.streaming.io import read_records, run_to_completion, stage_records, write_stream
from civicflow.streaming.process import Context, Gridlock, KeyedProcess, Silence, process_batch, process_stream

DELAY_MS = 10_000


def traffic(spark, n=160, seed=1):
    rng = random.Random(seed)
    rows = [{"sec": rng.randrange(0, 2400), "junction_id": rng.choice(["J1", "J1", "J2", "J3", None]), "zone": "Z",
             "vehicle_count": 1, "avg_wait_sec": rng.choice([10.0, 200.0, 300.0, None]), "signal_phase": "RED"} for _ in range(n)]
    rows.sort(key=lambda r: r["sec"])
    return frame(spark, rows, "junction_id string, zone string, vehicle_count int, avg_wait_sec double, signal_phase string")


def streamed(spark, df, run, make):
    stage_records(tv.wire_records(df, "traffic_signals"), f"{run}/in", slices=4)
    stream = read_records(spark, "files", path=f"{run}/in", options={"maxFilesPerTrigger": "1"})
    run_to_completion(write_stream(make(jobs.typed(stream, "traffic_signals")), "parquet", f"{run}/ck", path=f"{run}/out", state_partitions=2))
    return sorted(map(tuple, spark.read.parquet(f"{run}/out").collect()))


class Mixed(KeyedProcess):
    """Timers that set timers, deletions, past timers and emissions from both."""

    state = "seen long, fired long, names string"
    output = "what string, t long, n long"

    def on_row(self, row, ctx):
        ctx.state["seen"] = (ctx.state["seen"] or 0) + 1
        t, n = int(row.t_ms), ctx.state["seen"]
        ctx.set_timer(t + 30_000)
        if n % 3 == 0:
            ctx.delete_timer(t + 30_000)
        if n % 5 == 0:
            ctx.set_timer(t - 1_000)
        if row.avg_wait_sec is None:
            ctx.emit("null", t, n)

    def on_timer(self, t, ctx):
        ctx.state["fired"] = (ctx.state["fired"] or 0) + 1
        ctx.emit("timer", t, ctx.state["fired"])
        if ctx.state["fired"] % 4 == 0:
            ctx.set_timer(t + 45_000)


def simulate(rows, process, until):
    out = []
    for key in sorted({r.junction_id for r in rows if r.junction_id}):
        own = sorted((r for r in rows if r.junction_id == key), key=lambda r: (r.t_ms, r.seq))
        ctx = Context((key,), dict.fromkeys([x.split()[0] for x in process.state.split(", ")]), [], True)
        for row in [r for r in own if r.t_ms <= until] + [None]:
            while ctx.timers and min(ctx.timers) < (until if row is None else row.t_ms):
                t = min(ctx.timers)
                ctx.delete_timer(t)
                process.on_timer(t, ctx)
            if row is not None:
                process.on_row(row, ctx)
        out += ctx.emitted
    return sorted(out)


def test_rows_and_timers_agree_in_all_forms(spark, tmp_path):
    df = traffic(spark)
    rows = df.collect()
    final = max(r.t_ms for r in rows) - DELAY_MS
    want = simulate(rows, Mixed(), final)
    batch = process_batch(df, ["junction_id"], Mixed(), ["avg_wait_sec"], delay_ms=DELAY_MS, end="open")
    assert sorted(map(tuple, batch.collect())) == want and {w[1] for w in want} == {"null", "timer"}
    assert streamed(spark, df, str(tmp_path), lambda s: process_stream(s, ["junction_id"], Mixed(), ["avg_wait_sec"], delay="10 seconds")) == want
    closed = process_batch(df, ["junction_id"], Mixed(), ["avg_wait_sec"], delay_ms=DELAY_MS)
    assert sorted(map(tuple, closed.collect())) == simulate(rows, Mixed(), float("inf"))


def test_gridlock_as_a_process(spark, tmp_path):
    df = traffic(spark, seed=2)
    out = ["junction_id", "zone", "avg_wait_sec", "timestamp", "t_ms", "seq"]
    want = sorted(map(tuple, consecutive_runs(df, "junction_id", gridlock_breach()).select(*out).collect()))
    process = Gridlock(180.0, 3)
    columns = ["zone", "avg_wait_sec", "timestamp"]
    assert sorted(map(tuple, process_batch(df, ["junction_id"], process, columns).collect())) == want != []
    assert streamed(spark, df, str(tmp_path), lambda s: process_stream(s, ["junction_id"], process, columns)) == want


def test_silence(spark):
    df = frame(spark, [{"sec": s, "k": k} for s, k in [(0, "a"), (50, "a"), (110, "a"), (171, "a"), (5, "b"), (400, "c")]], "k string")
    got = lambda **o: sorted((r.k, r.last_t_ms - EPOCH_MS, r.due_t_ms - EPOCH_MS) for r in process_batch(df, ["k"], Silence(60_000), [], delay_ms=DELAY_MS, **o).collect())
    # 110 s comes with the timer of 50 s and so before it; 171 s comes after that of 110 s
    assert got(end="open") == [("a", 110_000, 170_000), ("a", 171_000, 231_000), ("b", 5_000, 65_000)]
    assert got() == got(end="open") + [("c", 400_000, 460_000)]


def test_timers_need_a_watermark_and_empty_input(spark):
    df = frame(spark, [{"sec": 1, "k": "a"}], "k string")
    assert process_batch(df.where("false"), ["k"], Silence(5), [], delay_ms=1, end="open").count() == 0
    with pytest.raises(Exception, match="timers need a delay"):
        process_batch(df, ["k"], Silence(5), []).collect()
