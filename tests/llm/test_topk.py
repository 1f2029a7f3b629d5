import math
import random

import numpy as np
import pytest

from civicflow.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, k):
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (qid, q) in enumerate(ok):
        if qid % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(q, v)), vid) for b, (vid, v) in enumerate(ok) if b != a and len(v) == len(q))
            out += [(qid, r + 1, vid, -s) for r, (s, vid) in enumerate(scored[:k])]
    return sorted(out)


def run(df, **more):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.search(df, **more).collect())


@pytest.mark.parametrize("sizes", [{}, {"tile_rows": 16, "query_tiles": 1, "shard_tiles": 2, "fan_in": 2}])
def test_against_brute_force(spark, sizes):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, -0.25, 0.0, 0.3, 0.5]) for _ in range(6)], 1) for i in range(300)]  # many ties
    rows += [(300, None, 1), (350, [None, 1.0, 0.0, 0.0, 0.0, 0.0], 1), (400, [math.nan] + [0.0] * 5, 1), (450, [math.inf] * 6, 1), (None, [1.0] * 6, 1),
             (50, [0.5] * 6, 2), (50, [0.5] * 6, 2), (1000, [1.0, 2.0], 3), (1001, [3.0, -1.0], 3), (2000, [], 4), (3000, [1.0] * 3, 4)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert run(df, **sizes) == brute(rows, 50, 5)


@pytest.mark.parametrize("tile_rows", [2, 3, 4, 5])
def test_fewer_candidates_in_a_tile_than_k(spark, tile_rows):
    for ids in ([1, 50], [50, 51], [1, 2, 50], [1, 50, 100], list(range(40, 58)) + [50]):
        rows = [(i, [0.5, 0.25 * (i % 3)], 1) for i in ids]
        assert run(spark.createDataFrame(rows, SCHEMA).coalesce(1), tile_rows=tile_rows) == brute(rows, 50, 5)


def test_exact_beyond_doubles():
    a = np.array([[3.0e9, 2.0**31, 1.0]])
    b = np.array([[3.0e9, 2.0**31, 1.0], [3.0e9, 2.0**31, 2.0], [1e300, 0, 0]])
    assert topk.product(a, b[:2]).tolist() == [[9 * 10**18 + 2**62 + 1, 9 * 10**18 + 2**62 + 2]]
    assert topk.product(a, b)[0, 2] == int(1e300) * 3 * 10**9


def test_empty_and_no_query(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
    assert run(spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 1)], SCHEMA)) == []
    assert run(spark.createDataFrame([(50, [1.0], 1)], SCHEMA)) == []


def test_query_against_brute_force(spark, sf):
    from civicflow.llm.catalog import QUERIES

    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = QUERIES["op4_topk"](spark, sf).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == brute(rows, 50, 5)


def test_only_the_places_of_tiles_are_shuffled_and_lists_follow_the_queries(spark):
    """Ten times the candidates: no vector in a unit, and as many list rows a query."""
    a_query = {}
    for n in (400, 4000):
        rows = [(i, [float((i * p) % 101) / 101 for p in (3, 7, 11, 13)], 1) for i in range(1, n + 1)]
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        lists = topk.shard_lists(df, query_every=100, tile_rows=8, query_tiles=2, shard_tiles=2, max_shards=5)
        assert lists.agg({"shard": "max"}).first()[0] == 4
        a_query[n] = lists.count() / (n // 100)
        assert run(df, query_every=100, tile_rows=8, query_tiles=2, shard_tiles=2, max_shards=5, fan_in=2) == brute(rows, 100, 5)
    assert a_query[400] == a_query[4000] == 25
    manifest = spark.createDataFrame([], topk.TILE_SCHEMA)
    assert "binary" not in topk.units(manifest).schema.simpleString()


def test_groups_take_the_bytes_of_a_task(spark):
    one = [(dim, kind, 0, s, "f", 0, 0, 1024, False) for dim in (64, 1 << 16) for kind in (True, False) for s in range(300)]
    found = topk.units(spark.createDataFrame(one, topk.TILE_SCHEMA)).selectExpr("dim", "grp", "shard", "size(q) q", "size(c) c").collect()
    assert max(r["q"] for r in found if r["dim"] == 64) == 128 and max(r["q"] for r in found if r["dim"] > 64) == 1
    assert {(r["grp"], r["shard"]) for r in found if r["dim"] == 64} == {(g, s) for g in range(3) for s in range(19)}
    assert sum(r["q"] * r["c"] for r in found if r["dim"] == 64) == 300 * 300
