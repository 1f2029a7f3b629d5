"""Streaming bunching by grid cell: against brute force, moves over cells, spread of one route."""

import random

import numpy as np
import pytest
from conftest import EPOCH_MS
from test_proximity_bruteforce import SPOTS, arrival_frame, random_pings, simulate, simulate_expiring

from civicflow.functions.geo import chord_cell_size
from civicflow.operators.proximity import bus_bunching
from civicflow.streaming import cells
from civicflow.streaming.stateful import bunching_stream, haversine


def run_stream(spark, df, run, slices=4, **options):
    from pyspark.sql import functions as F

    from civicflow.sources import telemetry as tv
    from civicflow.streaming import jobs
    from civicflow.streaming.io import read_records, run_to_completion, stage_records, write_stream

    full = df.withColumns({"speed_kmh": F.lit(0.0), "occupancy_pct": F.lit(0.0)})
    stage_records(tv.wire_records(full, "bus_gps"), f"{run}/in", slices=slices)
    stream = read_records(spark, "files", path=f"{run}/in", options={"maxFilesPerTrigger": "1"})
    query = write_stream(bunching_stream(jobs.typed(stream, "bus_gps"), **options), "parquet", f"{run}/ck", path=f"{run}/out", state_partitions=4)
    run_to_completion(query)
    rows = spark.read.parquet(f"{run}/out").collect()
    return sorted((r.entityId, r.t_ms, r.sourceTimestamp, r.description) for r in rows), query


def moving_pings(rnd, n, buses="ABCDEF"):
    """Buses of one route that drive through many cells, near each other and apart."""
    where = {b: [28.4 + rnd.uniform(0, 0.004), 77.0 + rnd.uniform(0, 0.004)] for b in buses}
    pings = []
    for i in range(n):
        b = rnd.choice(buses)
        where[b] = [where[b][0] + rnd.uniform(-0.0004, 0.0005), where[b][1] + rnd.uniform(-0.0004, 0.0005)]
        if rnd.random() < 0.05:
            where[b] = list(where[rnd.choice(buses)])
        pings.append({"route": "R1", "bus": b, "lat": where[b][0], "lon": where[b][1], "t": EPOCH_MS + i * 15000 + rnd.randint(0, 4) * 1000})
    pings.sort(key=lambda p: p["t"])
    for i, p in enumerate(pings):
        p["seq"] = i + 1
    return pings


def test_cells_hold_all_within_the_radius():
    rng = random.Random(2)
    edge = 2 * chord_cell_size(200.0)
    for _ in range(3000):
        lat, lon = rng.choice([28.4, 0.0, 89.9995, -60.0, 95.0]) + rng.uniform(-0.002, 0.002), rng.choice([77.0, 180.0, -180.0]) + rng.uniform(-0.002, 0.002)
        lat2, lon2 = lat + rng.uniform(-0.003, 0.003), lon + rng.uniform(-0.003, 0.003)
        found = cells.cells_of(lat, lon, edge)
        assert len(set(found)) == 8
        if haversine(lat, lon, lat2, lon2) < 200:
            assert cells.cells_of(lat2, lon2, edge)[0] in found


def test_roster_distances_and_removal():
    r = cells.Roster([])
    for i in range(40):
        r.put(f"b{i}", 28.4 + i * 0.001, 77.0, i % 2 == 0, "")
    for i in range(0, 40, 3):
        r.drop(f"b{i}")
    r.put("b1", 0.0, 0.0, True, "")
    want = {f"b{i}": haversine(28.41, 77.0, 28.4 + i * 0.001, 77.0) for i in range(40) if i % 3}
    want["b1"] = haversine(28.41, 77.0, 0.0, 0.0)
    assert dict(zip(r.names, np.round(r.distances(28.41, 77.0), 6))) == {k: round(v, 6) for k, v in want.items()}


@pytest.mark.parametrize("seed,once", [(1, False), (2, True)])
def test_moving_buses_match_bruteforce(spark, tmp_path, seed, once):
    pings = moving_pings(random.Random(seed), 400)
    df = arrival_frame(spark, pings)
    want = sorted((e, t, ts) for e, t, ts, _ in simulate(pings, once))
    got, _ = run_stream(spark, df, str(tmp_path / "s"), once_per_episode=once)
    assert [g[:3] for g in got] == want and len(want) > 3
    batch = bus_bunching(df, once_per_episode=once).collect()
    assert got == sorted((r.entityId, r.t_ms, r.sourceTimestamp, r.description) for r in batch)


def test_route_keying_gives_the_same_alerts(spark, tmp_path):
    pings = random_pings(random.Random(11), 90)
    df = arrival_frame(spark, pings)
    by_cell, _ = run_stream(spark, df, str(tmp_path / "c"))
    by_route, _ = run_stream(spark, df, str(tmp_path / "r"), keyed_by="route")
    assert by_cell == by_route != []
    with pytest.raises(ValueError):
        bunching_stream(df, keyed_by="cell", position_ttl_ms=1)


def test_one_route_is_spread_over_state_partitions(spark, tmp_path):
    """The rows of a single route reach several partitions of every operator."""
    rnd = random.Random(5)
    pings = [{"route": "R1", "bus": f"B{i % 40}", "lat": 28.4 + 0.01 * (i % 20), "lon": 77.0, "t": EPOCH_MS + i * 2000, "seq": i + 1} for i in range(800)]
    rnd.shuffle(pings)
    df = arrival_frame(spark, pings)
    got, query = run_stream(spark, df, str(tmp_path / "w"), slices=2)
    assert len(got) >= 20  # the two buses of each of the 20 places
    state = spark.read.format("statestore").option("operatorId", 1).option("stateVarName", "buses").load(f"{tmp_path}/w/ck")
    spread = state.groupBy("partition_id").count().collect()
    assert len(spread) == 4 and max(r["count"] for r in spread) < sum(r["count"] for r in spread) / 2


@pytest.mark.parametrize("seed,once,expire", [(1, False, 120_000), (2, True, 200_000)])
def test_expiry_timers_match_bruteforce_and_batch(spark, tmp_path, seed, once, expire):
    pings = moving_pings(random.Random(seed), 400, "ABCD")
    df = arrival_frame(spark, pings)
    want = sorted((e, t, ts) for e, t, ts, _ in simulate_expiring(pings, expire, once))
    got, _ = run_stream(spark, df, str(tmp_path / "e"), slices=8, once_per_episode=once, expire_ms=expire)
    assert [g[:3] for g in got] == want and len(want) > 3
    batch = bus_bunching(df, once_per_episode=once, expire_ms=expire).collect()
    assert got == sorted((r.entityId, r.t_ms, r.sourceTimestamp, r.description) for r in batch)
    with pytest.raises(ValueError):
        bunching_stream(df, keyed_by="route", expire_ms=expire)


def test_rows_at_the_very_watermark_are_not_late(spark, tmp_path):
    """A ping at exactly the watermark of its micro-batch reaches the operators
    behind and counts there (holds for timers one ms later as well).  The
    ping of B apart at 290 s is the watermark after Z's of 300 s."""
    at = lambda t, b, spot: {"route": "R1" if b != "Z" else "R9", "bus": b, "lat": SPOTS[spot][0], "lon": SPOTS[spot][1], "t": EPOCH_MS + t}
    pings = [at(0, "A", 0), at(0, "B", 1), at(290_000, "B", 4), at(300_000, "Z", 0), at(302_000, "Z", 0), at(304_000, "Z", 0),
             at(500_000, "Z", 0), at(600_000, "Z", 0), at(900_000, "Z", 0), at(900_001, "Z", 0)]
    for i, p in enumerate(pings):
        p["seq"] = i + 1
    df = arrival_frame(spark, pings)
    got, _ = run_stream(spark, df, str(tmp_path / "w"), slices=5)
    assert got == [] == simulate(pings)


@pytest.mark.parametrize("seed", [1, 2])
def test_blocks_of_a_cell_match_row_by_row(monkeypatch, seed):
    """A cell's rows in blocks of any size: the observations of applying them one by one."""
    rnd = random.Random(seed)
    names = [f"b{i}" for i in range(6)]
    rows = [(rnd.randrange(6), rnd.choice([cells.LEFT, cells.AROUND, cells.HOME, cells.HOME]), rnd.choice([0.0, 0.001, 0.0018]), 0.0) for _ in range(400)]

    def run(step):
        watch, out = cells.CellWatch(cells.Roster([]), {n: i for i, n in enumerate(names)}, set(), 150.0), []
        for i in range(0, len(rows), step):
            who, kind, lat, lon = (np.array(c) for c in zip(*rows[i:i + step]))
            at = np.arange(i, i + len(who))
            ts = np.array([str(j) for j in at], object)
            for lo, hi, *arrays in watch.apply({"who": who, "kind": kind, "lat": lat, "lon": lon, "t": at, "seq": at}, ts):
                assert len(arrays[0]) <= cells.PIECE
                out += [(lo, hi, int(t), bool(near), ts, None if d != d else round(float(d), 6)) for t, _, near, ts, d in zip(*arrays)]
        return sorted(out, key=lambda o: o[:3]), watch.near_pairs()

    at, near, want = {}, set(), []
    for j, (b, kind, lat, lon) in enumerate(rows):
        at[b] = (kind, lat, lon, str(j))
        for o in set(at) - {b}:
            lo, hi = sorted((b, o))
            d = haversine(at[b][1], at[b][2], at[o][1], at[o][2])
            if at[lo][0] == cells.HOME and at[hi][0] != cells.LEFT and d < 150:
                near.add((lo, hi))
                want.append((names[lo], names[hi], j, True, at[lo][3], round(d, 6)))
            elif (lo, hi) in near:
                near.discard((lo, hi))
                want.append((names[lo], names[hi], j, False, None, None))
    want = sorted(want), {(names[a], names[b]) for a, b in near}
    assert len(want[0]) > 200
    for step in (1, 7, 400):
        assert run(step) == want


def test_a_dense_bus_travels_in_few_rows():
    """Many pings of a bus in one cell are no row each, and no row holds all of them."""
    import pyarrow as pa

    n = 3 * cells.PINGS + 5
    pings = pa.table([[28.4] * n, [77.0] * n, list(range(n)), list(range(n)), ["x"] * n], schema=cells.PINGS_OF_A_BUS)
    frames = list(cells.BusCells(2 * chord_cell_size(200.0))._moves("R", "b", pings, np.arange(n), None, n))
    assert max(len(f) for f in frames) * cells.PIECE <= 8 * cells.PINGS
    sizes = [len(t) for f in frames for t in f["t"]]
    assert max(sizes) <= cells.PIECE and sum(sizes) == 8 * n and len(sizes) <= 8 * (n // cells.PIECE + 4)


class _State:
    """The parts of a state handle that ``PairWatch`` uses, in memory."""

    def __init__(self):
        self.value, self.timers = None, set()
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.remove

    def getValueState(self, name, schema):
        return self

    exists = lambda self: self.value is not None
    get = lambda self: self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


@pytest.mark.parametrize("seed,once", [(1, False), (2, True), (3, False), (4, True)])
def test_watch_of_a_pair_matches_row_by_row(seed, once):
    """From one change of a watch to the next: the alerts of applying each observation."""
    import pandas as pd

    rnd, hold = random.Random(seed), 50
    rows, t = [], 0
    for seq in range(600):
        t += rnd.choice([0, 1, 3, 9, 30])
        rows.append((t, seq, rnd.random() < 0.93, f"s{seq}", float(seq)))
        if rnd.random() < 0.1:  # the owner before says apart for the same ping
            rows.append((t, seq, not rows[-1][2], f"s{seq}", float(seq)))
    want, deadline, quiet, seen, told, batch = [], None, False, None, None, 0
    watch, state, got = cells.PairWatch(hold, once, ["lo", "hi", "deadline", "ts", "distance"]), _State(), []
    watch.init(state)
    while batch < len(rows):
        size = rnd.choice([1, 40, 200])
        while batch + size < len(rows) and rows[batch + size][1] == rows[batch + size - 1][1]:
            size += 1
        some, batch = rows[batch:batch + size], batch + size
        wm = some[-1][0]
        for t, seq, near, ts, distance in sorted(some, key=lambda r: (r[0], r[1], not r[2])):
            if (t, seq) == told:
                continue
            told = (t, seq)
            if deadline is not None and t > deadline:
                want.append(("A", "B", deadline, *seen))
                deadline, quiet = None, once
            if not near:
                deadline, quiet = None, False
                continue
            seen = (ts, distance)
            if deadline is None and not quiet:
                deadline = t + hold
        if deadline is not None and deadline < wm:
            want.append(("A", "B", deadline, *seen))
            deadline, quiet = None, once
        rnd.shuffle(some)
        pieces = [some[i:i + 7] for i in range(0, len(some), 7)]
        columns = pd.DataFrame([[list(c) for c in zip(*p)] for p in pieces], columns=["t", "seq", "near", "ts", "distance"])
        found = cells.unpacked(iter([columns]), ["t", "seq", "near", "distance"])
        got += list(watch._step(("A", "B"), found, wm).itertuples(index=False, name=None))
        assert state.timers == ({deadline} if deadline is not None else set())
    assert got == want and len(want) > 10
