import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicflow.llm import lexical as lx


def brute_terms(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if ord(c) >= 128 or c.isalnum():
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
        elif word:
            out.append(word)
            word = ""
    return out


def brute(rows, items, k=20):
    docs = [(d, Counter(t), len(t)) for d, text in rows for t in [brute_terms(text)] if t]
    n_docs, length = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        asked, scored = Counter(brute_terms(text)), []
        for d, c, n in docs:
            m = 75 + 25 * n * n_docs // length
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in asked.items() if t in c)
            scored.append((-s, d is None, d))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k]) if s < 0]
    return sorted(out, key=str)


def corpus(rng, n, vocabulary):
    common = [f"w{i}" for i in range(vocabulary)]
    word = lambda: common[min(int(rng.expovariate(0.08)), vocabulary - 1)]
    rows = [(i, rng.choice([" ", ", ", "-"]).join(word() for _ in range(rng.choice([1, 3, 10, 40, 200])))) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, " .,- "), (n + 3, "W1 w1 W2"), (n + 4, "Äpfel äpfel naïve\x00w3_w4"), (None, "w5 w6 w7"), (4, "w1 w50"), (4, "w1 w50"), (n + 5, "w1 " * 30_000)]
    rng.shuffle(rows)
    return rows


def frames(spark, rows, items):
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return docs, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("seed,block_docs,first", [(1, 4096, 64), (2, 16, 1)])
def test_search_against_brute_force(spark, monkeypatch, seed, block_docs, first):
    monkeypatch.setattr(lx, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(lx, "FIRST_SCORED", first)
    rng = random.Random(seed)
    rows = corpus(rng, 250, 90)
    items = [(i, " ".join("w%d" % rng.randrange(95) for _ in range(rng.choice([1, 4, 30])))) for i in range(20)]
    items += [(20, None), (21, ""), (22, "nothing of this"), (23, "w1 w1 W1, w2"), (24, "ÄPFEL Äpfel naïve"), (25, " ".join(f"w{i}" for i in range(90)))]  # 90 terms: masks of two words
    docs, asked = frames(spark, rows, items)
    docs = docs.withColumns({c: F.lit(1) for c in ("uid", "n", "terms", "score", "rank")})
    got = lx.search(docs, asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and dict(got.dtypes)["rank"] == "int"
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, items)


def test_query_blocks_and_repeated_items(spark, monkeypatch):
    rng = random.Random(4)
    rows = corpus(rng, 60, 40)
    items = [(i, " ".join("w%d" % rng.randrange(40) for _ in range(6))) for i in range(9)] + [(3, "w1 w2"), (3, "w1 w2")]
    docs, asked = frames(spark, rows, items)
    whole = sorted((tuple(r) for r in lx.search(docs, asked, k=5).collect()), key=str)
    assert whole == brute(rows, items, 5)
    monkeypatch.setattr(lx, "BLOCK_TERMS", 12)
    assert len(list(lx.query_blocks(asked, "item_id", "text"))) > 2
    assert sorted((tuple(r) for r in lx.search(docs, asked, k=5).collect()), key=str) == whole


def test_empty_tables(spark):
    docs, asked = frames(spark, [], [(1, "w1")])
    assert lx.search(docs, asked).count() == 0
    docs, asked = frames(spark, [(1, "w1")], [])
    assert lx.search(docs, asked).count() == 0 and dict(lx.search(docs, asked).dtypes)["item_id"] == "bigint"
    docs, asked = frames(spark, [(1, None), (2, "...")], [(1, "w1"), (2, None)])
    assert lx.search(docs, asked).count() == 0


def test_masks_are_left_unscored_when_the_list_is_safe():
    """Of many documents with common terms only, and some with a rare one, the latter groups suffice."""
    n = 2000
    held = [np.array([1, 2] if i % 50 == 0 else [1], np.int32) for i in range(n)]
    times = [np.ones(len(h), np.int32) for h in held]
    block = lx.Block(np.arange(n), np.arange(n), np.zeros(n, np.int64), np.full(n, 10), [h.tobytes() for h in held], [t.tobytes() for t in times], n, 10 * n)
    scored, scores = [], block.scores
    block.scores = lambda docs, dense: scored.append(len(docs)) or scores(docs, dense)
    best, dense = lx.Best(20), np.zeros(3, np.int64)
    block.search({1: 10, 2: 5000}, best, dense)
    assert sum(scored) == 40 and best.rows[2].tolist() == list(range(0, 1000, 50)) and not dense.any()
