"""Chains of deadlines against a row-by-row scan."""

import random

import pytest

from civicflow.operators import chains
from civicflow.operators.arrival import passing_arrivals

SCHEMA = "k string, at long, seq long, due long, mark long, next_at long"


def scan(rows):
    out = []
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        starts, due = [], None
        for r in own:
            if due is None or r[1] > due:
                starts.append(r)
                due = r[3]
        out += [(*r[:5], r is starts[-1], own[-1][5]) for r in starts]
    return sorted(out)


def group(rng, key, n, step, reach, never=0.0):
    at, out = rng.randrange(50), []
    for i in range(n):
        at += rng.choice([0, 1, step, step])
        out.append([key, at, i, chains.NEVER if rng.random() < never else at + rng.randint(0, reach), at * 7, 0])
    for a, b in zip(out, out[1:]):
        a[5] = b[1]
    out[-1][5] = at + rng.choice([1, 5, 500])
    return [tuple(r) for r in out]


@pytest.mark.parametrize("seed,reaches", [(1, 16), (2, 1), (3, 2)])
def test_starts_match_the_sequential_scan(spark, monkeypatch, seed, reaches):
    monkeypatch.setattr(chains, "BLOCK_REACHES", reaches)
    rng = random.Random(seed)
    rows = group(rng, "endless", 900, 3, 20) + group(rng, "sparse", 60, 400, 20) + group(rng, "ends", 50, 2, 15, never=0.1) + group(rng, "one", 1, 1, 9)
    for i in range(40):
        rows += group(rng, f"g{i}", rng.randint(1, 30), rng.choice([1, 4, 60]), 20)
    rng.shuffle(rows)
    got = chains.chain_starts(spark.createDataFrame(rows, SCHEMA).repartition(5), ["k"])
    assert sorted(map(tuple, got.collect())) == scan(rows)


def test_an_endless_group_runs_over_many_tasks(spark, monkeypatch):
    """No task holds more of the group than a block, and blocks are many."""
    seen = spark.sparkContext.accumulator(0)
    most = 400
    real = chains.block_entries

    def watched(at, seq, due, mark, last_entry):
        assert len(at) <= most
        seen.add(1)
        return real(at, seq, due, mark, last_entry)

    monkeypatch.setattr(chains, "block_entries", watched)
    rows = [("p", 10 * i, i, 10 * i + 200, i, 10 * i + 10) for i in range(5000)]
    got = chains.chain_starts(spark.createDataFrame(rows, SCHEMA).repartition(4), ["k"])
    assert [r["at"] for r in got.orderBy("at").collect()] == list(range(0, 50_000, 210))
    assert seen.value >= 5000 * 10 // (16 * 200)


def test_empty_and_reachless_groups(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chains.chain_starts(empty, ["k"]).count() == 0
    rows = [("a", i, i, i, 0, i + 1) for i in range(40)] + [("b", i, i, chains.NEVER, 0, i + 1) for i in range(9)]
    got = chains.chain_starts(spark.createDataFrame(rows, SCHEMA), ["k"])
    assert sorted(map(tuple, got.collect())) == scan(rows)


@pytest.mark.parametrize("bucket", [7, 60_000])
def test_passing_arrivals(spark, bucket):
    rng = random.Random(bucket)
    rows = [(i, i * 3 + rng.randint(-40, 40)) for i in range(300)] + [(300, 10_000), (301, 905)]
    df = spark.createDataFrame(rows, "seq long, t_ms long").repartition(3)
    got = {r["t_ms"]: r["passed"] for r in passing_arrivals(df, 25, bucket_ms=bucket).collect()}
    want = {t: min((s for s, u in rows if u >= t + 25), default=None) for _, t in rows}
    assert got == want
