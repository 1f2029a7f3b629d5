"""Bus bunching vs. a brute-force simulation on random small fixtures.

The simulation applies the documented semantics directly: every ping is
compared with the latest position of every other bus of its route (all
pairs), watches start on near, stop on far, fire at the deadline when the
next observation comes after it or at the end, and only if the deadline is at
most ``max(t) - 10001``; the alert carries the positions as of the deadline.
"""

import random

import pytest
from conftest import EPOCH_MS, frame

from civicflow.operators.proximity import bus_bunching
from civicflow.streaming.stateful import haversine

HOLD, DELAY = 300_000, 10_000
SPOTS = [(28.4, 77.0), (28.4009, 77.0), (28.4017, 77.0), (28.4, 77.0021), (28.403, 77.003)]


def simulate(pings, once=False):
    horizon = max(p["t"] for p in pings) - DELAY - 1
    hist = {}  # (route, bus) -> list of (t, seq, lat, lon, ts)
    watches, fired, quiet = {}, [], set()
    for p in sorted(pings, key=lambda p: (p["t"], p["seq"])):
        r, b = p["route"], p["bus"]
        hist.setdefault((r, b), []).append((p["t"], p["seq"], p["lat"], p["lon"], p["ts"]))
        for (r2, o), h in hist.items():
            if r2 != r or o == b:
                continue
            lo, hi = sorted((b, o))
            d = haversine(p["lat"], p["lon"], h[-1][2], h[-1][3])
            dl = watches.get((r, lo, hi))
            if dl is not None and p["t"] > dl and dl <= horizon:
                fired.append((r, lo, hi, dl))
                dl = None
                del watches[(r, lo, hi)]
                if once:
                    quiet.add((r, lo, hi))
            if not d < 200:
                watches.pop((r, lo, hi), None)
                quiet.discard((r, lo, hi))
            elif dl is None and (r, lo, hi) not in quiet:
                watches[(r, lo, hi)] = p["t"] + HOLD
    fired += [(r, lo, hi, dl) for (r, lo, hi), dl in watches.items() if dl <= horizon]
    out = []
    for r, lo, hi, dl in fired:
        a = [x for x in hist[(r, lo)] if x[0] <= dl][-1]
        c = [x for x in hist[(r, hi)] if x[0] <= dl][-1]
        out.append((f"{lo}:{hi}", dl, a[4], round(haversine(a[2], a[3], c[2], c[3]), 3)))
    return sorted(out)


def random_pings(rnd, n):
    pings = []
    for i in range(n):
        lat, lon = rnd.choice(SPOTS)
        t = EPOCH_MS + rnd.randrange(0, 1500) * 1000
        pings.append({"route": rnd.choice(["R1", "R1", "R2"]), "bus": rnd.choice("ABCD"),
                      "lat": lat, "lon": lon, "t": t})
    pings.sort(key=lambda p: p["t"])
    for i, p in enumerate(pings):  # seq = arrival order (time order, ties broken arbitrarily)
        p["seq"] = i + 1
    return pings


@pytest.mark.parametrize("seed,once,split", [(1, False, True), (2, False, True), (3, False, True),
                                             (4, False, False), (5, False, True), (6, False, False),
                                             (1, True, True), (8, True, False)])
def test_bunching_matches_bruteforce(spark, seed, once, split):
    rnd = random.Random(seed)
    pings = random_pings(rnd, 60)
    rows = [{"sec": (p["t"] - EPOCH_MS) / 1000, "route_id": p["route"], "bus_id": p["bus"],
             "lat": p["lat"], "lon": p["lon"]} for p in pings]
    df = frame(spark, rows, "route_id string, bus_id string, lat double, lon double")
    # frame() numbers rows in list order, which is the pings' seq order
    by_seq = {r.seq: r.timestamp for r in df.select("seq", "timestamp").collect()}
    for p in pings:
        p["ts"] = by_seq[p["seq"]]
    got = sorted((r.entityId, r.t_ms, r.sourceTimestamp, round(r.distance, 3))
                 for r in bus_bunching(df, once_per_episode=once, split_episodes=split).collect())
    assert got == simulate(pings, once)


@pytest.mark.parametrize("once,buffered", [(False, True), (True, True), (False, False)])
def test_bunching_stream_matches_bruteforce(spark, tmp_path, once, buffered):
    from civicflow.sources import telemetry as tv
    from civicflow.streaming import jobs
    from civicflow.streaming.io import read_records, run_to_completion, stage_records, write_stream
    from civicflow.streaming.stateful import bunching_stream

    rnd = random.Random(7)
    pings = random_pings(rnd, 80)
    rows = [{"sec": (p["t"] - EPOCH_MS) / 1000, "route_id": p["route"], "bus_id": p["bus"],
             "lat": p["lat"], "lon": p["lon"], "speed_kmh": 0.0, "occupancy_pct": 0.0} for p in pings]
    df = frame(spark, rows, "route_id string, bus_id string, lat double, lon double, "
                            "speed_kmh double, occupancy_pct double")
    by_seq = {r.seq: r.timestamp for r in df.select("seq", "timestamp").collect()}
    for p in pings:
        p["ts"] = by_seq[p["seq"]]
    run = str(tmp_path / "bb")
    stage_records(tv.wire_records(df, "bus_gps"), f"{run}/in", slices=5)
    stream = read_records(spark, "files", path=f"{run}/in", options={"maxFilesPerTrigger": "1"})
    q = write_stream(bunching_stream(jobs.typed(stream, "bus_gps"), once_per_episode=once,
                                     buffer_until_watermark=buffered), "parquet",
                     f"{run}/ck", path=f"{run}/out",
                     state_partitions=4)
    run_to_completion(q)
    got = sorted((r.entityId, r.t_ms, r.sourceTimestamp, round(float(r.description.split("within ")[1].split("m")[0]), 0))
                 for r in spark.read.parquet(f"{run}/out").collect())
    exp = sorted((e, t, ts, round(d, 0)) for e, t, ts, d in simulate(pings, once))
    assert got == exp and len(exp) > 0


def test_bunching_stream_handles_out_of_order_arrival(spark, tmp_path):
    """A far ping at 309 s arrives after a ping at 312 s (3 s late, within the
    10 s delay).  In event order the far ping cancels the watch due at 310 s;
    applied in arrival order the 312 s ping would decide it first.  The stream
    buffers until the watermark and equals the batch form: no alert."""
    from pyspark.sql import functions as F

    from civicflow.sources import telemetry as tv
    from civicflow.streaming import jobs
    from civicflow.streaming.io import read_records, run_to_completion, stage_slices, write_stream
    from civicflow.streaming.stateful import bunching_stream

    base, near, far = SPOTS[0], SPOTS[1], SPOTS[4]
    arrival = [("A", 0, base, 0), ("B", 10, near, 0), ("A", 312, base, 1), ("B", 309, far, 2),
               ("Z", 2000, base, 3)]
    rows = [{"sec": t, "route_id": "R9" if b == "Z" else "R1", "bus_id": b, "lat": pos[0], "lon": pos[1],
             "speed_kmh": 0.0, "occupancy_pct": 0.0} for b, t, pos, _ in arrival]
    df = frame(spark, rows, "route_id string, bus_id string, lat double, lon double, "
                            "speed_kmh double, occupancy_pct double")
    batch_of = {i + 1: sl for i, (_, _, _, sl) in enumerate(arrival)}
    recs = tv.wire_records(df, "bus_gps")
    slice_col = F.element_at(F.create_map(*[x for kv in batch_of.items() for x in (F.lit(kv[0]), F.lit(kv[1]))]),
                             F.col("offset"))
    run = str(tmp_path / "ooo")
    stage_slices(recs.withColumn("_slice", slice_col), f"{run}/in", "_slice", slices=4)
    stream = read_records(spark, "files", path=f"{run}/in", options={"maxFilesPerTrigger": "1"})
    q = write_stream(bunching_stream(jobs.typed(stream, "bus_gps")), "parquet", f"{run}/ck", path=f"{run}/out",
                     state_partitions=2)
    run_to_completion(q)
    assert bus_bunching(df).count() == 0
    assert spark.read.parquet(f"{run}/out").count() == 0


def simulate_arrival(pings, once=False):
    """The reference's processing: rows in arrival order, timers when the watermark passes."""
    latest, watches, quiet, out, top = {}, {}, set(), [], None
    for p in sorted(pings, key=lambda p: p["seq"]):
        r, b = p["route"], p["bus"]
        latest[(r, b)] = p
        for (r2, o), q in latest.items():
            if r2 != r or o == b:
                continue
            pair = (r, *sorted((b, o)))
            if not haversine(p["lat"], p["lon"], q["lat"], q["lon"]) < 200:
                watches.pop(pair, None)
                quiet.discard(pair)
            elif pair not in watches and pair not in quiet:
                watches[pair] = p["t"] + HOLD
        top = p["t"] if top is None else max(top, p["t"])
        for pair, due in list(watches.items()):
            if due <= top - DELAY - 1:
                a, c = latest[pair[0], pair[1]], latest[pair[0], pair[2]]
                out.append((f"{pair[1]}:{pair[2]}", due, a["ts"], round(haversine(a["lat"], a["lon"], c["lat"], c["lon"]), 3)))
                del watches[pair]
                if once:
                    quiet.add(pair)
    return sorted(out)


def arrival_frame(spark, pings):
    rows = [{"sec": (p["t"] - EPOCH_MS) / 1000, "route_id": p["route"], "bus_id": p["bus"],
             "lat": p["lat"], "lon": p["lon"]} for p in sorted(pings, key=lambda p: p["seq"])]
    df = frame(spark, rows, "route_id string, bus_id string, lat double, lon double")
    by_seq = {r.seq: r.timestamp for r in df.select("seq", "timestamp").collect()}
    for p in pings:
        p["ts"] = by_seq[p["seq"]]
    return df


@pytest.mark.parametrize("seed,once,delay_s", [(1, False, 0), (2, False, 30), (3, False, 400), (4, True, 30), (5, False, 900)])
def test_arrival_order_matches_bruteforce(spark, monkeypatch, seed, once, delay_s):
    """Shuffled arrival: event time and arrival order disagree by up to ``delay_s``."""
    from civicflow.operators import chains

    monkeypatch.setattr(chains, "BLOCK_REACHES", 1 + seed % 3)
    rnd = random.Random(seed)
    pings = random_pings(rnd, 90)
    for p in pings:
        if rnd.random() < 0.8:
            p["lat"], p["lon"] = SPOTS[rnd.randrange(2)]
    pings.sort(key=lambda p: p["t"] + rnd.randint(0, delay_s) * 1000)
    for i, p in enumerate(pings):
        p["seq"] = i + 1
    df = arrival_frame(spark, pings)
    got = sorted((r.entityId, r.t_ms, r.sourceTimestamp, round(r.distance, 3))
                 for r in bus_bunching(df, once_per_episode=once, order="arrival").collect())
    assert got == simulate_arrival(pings, once) and len(got) > 0


def test_a_far_ping_before_the_watermark_cancels(spark):
    """Due at 300 s, seen apart at 305 s: the watermark passes 300 s only with the
    row at 310.001 s, so the watch is cancelled; the canonical deadline fires."""
    at = lambda t, b, spot: {"route": "R1", "bus": b, "lat": SPOTS[spot][0], "lon": SPOTS[spot][1], "t": EPOCH_MS + t}
    pings = [at(0, "A", 0), at(0, "B", 1), at(305_000, "B", 4), at(311_000, "A", 0), at(900_000, "A", 0)]
    for i, p in enumerate(pings):
        p["seq"] = i + 1
    df = arrival_frame(spark, pings)
    assert bus_bunching(df, order="arrival").count() == 0 == len(simulate_arrival(pings))
    assert [r.t_ms for r in bus_bunching(df).collect()] == [EPOCH_MS + 300_000]
    pings[2]["t"] = EPOCH_MS + 310_001  # the row that moves the watermark is applied before the watch fires
    assert bus_bunching(arrival_frame(spark, pings), order="arrival").count() == 0 == len(simulate_arrival(pings))
    pings[2]["t"], pings[2]["lat"], pings[2]["lon"] = EPOCH_MS + 310_001, *SPOTS[1]
    got = bus_bunching(arrival_frame(spark, pings), order="arrival").collect()
    assert [(r.entityId, r.t_ms) for r in got] == [x[:2] for x in simulate_arrival(pings)] != []


@pytest.mark.parametrize("reaches", [1, 16])
def test_endless_episode_matches_bruteforce(spark, monkeypatch, reaches):
    from civicflow.operators import chains

    monkeypatch.setattr(chains, "BLOCK_REACHES", reaches)
    rnd = random.Random(3)
    pings = [{"route": "R1", "bus": rnd.choice("AB"), "lat": SPOTS[i % 2][0], "lon": SPOTS[i % 2][1],
              "t": EPOCH_MS + 17_000 * i, "seq": i + 1} for i in range(900)]
    df = arrival_frame(spark, pings)
    got = sorted((r.entityId, r.t_ms, r.sourceTimestamp, round(r.distance, 3)) for r in bus_bunching(df).collect())
    assert got == simulate(pings) and len(got) > 40


def simulate_expiring(pings, expire, once=False):
    """``simulate`` with an event a position that expires: the bus is unknown from then on."""
    horizon = max(p["t"] for p in pings) - DELAY - 1
    ordered = sorted(pings, key=lambda p: (p["t"], p["seq"]))
    events = [(p["t"], 1, p["seq"], p) for p in ordered] + [(p["t"] + expire, 0, p["seq"], p) for p in ordered]
    known, hist, watches, quiet, fired = {}, {}, {}, set(), []
    for t, is_ping, _, p in sorted(events, key=lambda e: e[:3]):
        r, b = p["route"], p["bus"]
        if not is_ping and known.get((r, b)) is not p:
            continue
        for pair, dl in list(watches.items()):
            if dl < t:
                fired.append((*pair, dl))
                del watches[pair]
                if once:
                    quiet.add(pair)
        if not is_ping:
            del known[r, b]
            for kept in (watches, quiet):
                for pair in [x for x in kept if x[0] == r and b in x[1:]]:
                    kept.pop(pair) if kept is watches else kept.discard(pair)
            continue
        known[r, b] = p
        hist.setdefault((r, b), []).append(p)
        for (r2, o), q in known.items():
            if r2 != r or o == b:
                continue
            pair = (r, *sorted((b, o)))
            if not haversine(p["lat"], p["lon"], q["lat"], q["lon"]) < 200:
                watches.pop(pair, None)
                quiet.discard(pair)
            elif pair not in watches and pair not in quiet:
                watches[pair] = t + HOLD
    fired += [(*pair, dl) for pair, dl in watches.items()]
    out = []
    for r, lo, hi, dl in fired:
        if dl <= horizon:
            a, c = ([x for x in hist[r, b] if x["t"] <= dl][-1] for b in (lo, hi))
            out.append((f"{lo}:{hi}", dl, a["ts"], round(haversine(a["lat"], a["lon"], c["lat"], c["lon"]), 3)))
    return sorted(out)


@pytest.mark.parametrize("seed,once,split,expire", [(1, False, True, 120_000), (2, False, False, 120_000), (3, True, True, 200_000),
                                                    (4, True, False, 150_000), (5, False, True, 300_000), (6, False, True, 10**9)])
def test_expiring_positions_match_bruteforce(spark, seed, once, split, expire):
    rnd = random.Random(seed)
    pings = random_pings(rnd, 130)
    for p in pings:
        if rnd.random() < 0.85:
            p["lat"], p["lon"] = SPOTS[rnd.randrange(2)]
    df = arrival_frame(spark, pings)
    want = simulate_expiring(pings, expire, once)
    got = bus_bunching(df, once_per_episode=once, split_episodes=split, expire_ms=expire).collect()
    assert sorted((r.entityId, r.t_ms, r.sourceTimestamp, round(r.distance, 3)) for r in got) == want and len(want) > 0
    assert (want == simulate(pings, once)) == (expire == 10**9)


def test_expiry_at_the_deadline_and_at_a_ping(spark):
    """Both buses report until 200 s: the position of 200 s expires at the deadline
    (300 s) after 100 s and cancels; a limit one ms longer lets the alert through."""
    at = lambda t, b: {"route": "R1", "bus": b, "lat": SPOTS[0][0], "lon": SPOTS[0][1], "t": EPOCH_MS + t}
    pings = [at(t, b) for t in (0, 90_000, 150_000, 200_000) for b in "AB"] + [at(900_000, "Z")]
    for i, p in enumerate(pings):
        p["seq"] = i + 1
    df = arrival_frame(spark, pings)
    assert bus_bunching(df, expire_ms=100_000).count() == 0 == len(simulate_expiring(pings, 100_000))
    assert [r.t_ms for r in bus_bunching(df, expire_ms=100_001).collect()] == [EPOCH_MS + 300_000]
    assert bus_bunching(df, expire_ms=90_000).count() == 0  # expires at the very instant of the next ping
    for wrong in ({"expire_ms": 0}, {"expire_ms": 5, "order": "arrival"}):
        with pytest.raises(ValueError):
            bus_bunching(df, **wrong)
