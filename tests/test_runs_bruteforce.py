"""Consecutive runs vs. a direct counter, on random sequences."""

import random

import pytest
from conftest import frame

from civicflow.operators.runs import consecutive_runs, gridlock_breach


def counter(rows, n):
    fired, runs = [], {}
    for r in sorted(rows, key=lambda r: (r["sec"], r["i"])):
        w = r["avg_wait_sec"]
        if w is not None and w > 180:
            runs[r["junction_id"]] = runs.get(r["junction_id"], 0) + 1
            if runs[r["junction_id"]] == n:
                fired.append(r["i"])
        else:
            runs[r["junction_id"]] = 0
    return sorted(fired)


@pytest.mark.parametrize("seed,n", [(1, 3), (2, 3), (3, 2), (4, 4)])
def test_runs_match_counter(spark, seed, n):
    rnd = random.Random(seed)
    rows, t = [], 0
    for i in range(300):
        t += rnd.choice([1, 5, 60, 900, 4000])  # gaps that cross the look-back buckets
        w = rnd.choice([None, 100.0, 181.0, 200.0, 240.0, 250.0])
        rows.append({"i": i + 1, "sec": t, "junction_id": rnd.choice("JK"), "zone": "Z", "avg_wait_sec": w})
    df = frame(spark, [{k: v for k, v in r.items() if k != "i"} for r in rows],
               "junction_id string, zone string, avg_wait_sec double")
    got = sorted(r.seq for r in consecutive_runs(df, "junction_id", gridlock_breach(), n,
                                                  bucket_ms=600_000).collect())
    assert got == counter(rows, n)
