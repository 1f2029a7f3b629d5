import hashlib
import random
import time
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civicflow.llm import periodic as pr


def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            part = words[i:i + length]
            if length >= max(24, 3 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def split(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in "\t\n\x0b\x0c\r ":
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def brute_row(doc_id, text):
    words = split(text)
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join("%d,%d,%d\n" % r for r in runs)), sha(kept))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

pieces = st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.integers(1, 40)), max_size=6)


@settings(max_examples=400, deadline=None)
@given(pieces)
def test_runs_against_every_diagonal(parts):
    words = [w for part, times in parts for w in (part * times)[:240]]
    assert pr.periodic_runs(np.array(words, np.int64)) == brute_runs(words)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**9), st.integers(1, 3), st.integers(0, 900))
def test_runs_of_few_symbols(seed, symbols, n):
    """Periods that hold their own 16-grams several times."""
    rng = random.Random(seed)
    block = [rng.randrange(symbols) for _ in range(rng.randint(1, 25))]
    root = [w for _ in range(rng.randint(1, 6)) for w in block + [rng.randrange(symbols) for _ in range(rng.randint(0, 3))]]
    words = ([rng.randrange(symbols) for _ in range(rng.randint(0, 30))] + root * 30)[:n]
    assert pr.periodic_runs(np.array(words, np.int64)) == brute_runs(words)


def test_known_runs_and_bounds():
    run = lambda ws: pr.periodic_runs(np.array(ws, np.int64))
    assert run([7] * 24) == [(0, 24, 1)] and run([7] * 23) == []
    assert run([1] + [2, 3] * 12) == [(1, 24, 2)]
    root = list(range(100))
    assert run((root * 4)[:300]) == [(0, 300, 100)] and run((root * 4)[:299]) == []
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    assert run(fib[-1]) == brute_runs(fib[-1]) != []


def test_long_texts_take_little_more_than_linear_time():
    rng = random.Random(1)
    root = [rng.randrange(9) for _ in range(5000)]
    for words in ([5] * 400_000, root * 80, [w for _ in range(4000) for w in [rng.randrange(3)] * 100]):
        started = time.process_time()
        pr.periodic_runs(np.array(words, np.int64))
        assert time.process_time() - started < 20


def texts():
    rng = random.Random(5)
    out = [None, "", " \n\t", "one", "a " * 23, "a " * 24, "a\x0bb\x0c" * 40, "a b " * 30, "x\x1cy " * 30, "née\x85 " * 25]
    for size in (24, 60, 200, 700):
        for _ in range(6):
            words = ["w%d" % rng.randrange(size) for _ in range(size)]
            at = rng.randrange(size)
            words[at:at] = words[at:at + rng.choice([1, 3, 9, 40])] * rng.randint(2, 30)
            out.append(rng.choice([" ", "\n", "  "]).join(words))
    return out + out[12:14]


def test_query_against_brute_force(spark, docs):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts())] + [(None, "b " * 40, None, None, None), (3, "again", "en", "s", 0), (3, "again", "en", "s", 0)]
    planted = sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows if r[0] is not None)
    assert planted >= 2
    df = docs(rows).withColumns({c: F.lit(1) for c in ("runs", "_words", "_hash", "best", "collapsed", "start", "n_words")})
    got = pr.run_digests(pr.with_planted_runs(df))
    assert got.columns == COLUMNS
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted((brute_row(*r[:2]) for r in rows), key=key)


def test_whole_table_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    small = {r[0] for r in rows if len(split(r[1])) <= 700}  # brute force is quadratic; the query runs over all
    got = {r["doc_id"]: tuple(r) for r in pr.run_digests(pr.with_planted_runs(docs)).collect()}
    assert len(got) == len(rows) and len(small) > 150
    assert {i: got[i] for i in small} == {r[0]: brute_row(*r) for r in rows if r[0] in small}
    assert any(got[i][1] for i in small)


def test_library_result_and_empty_table(spark, docs):
    df = docs(["x y " * 12 + "end", None])
    assert [(r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in pr.scan(df).orderBy("doc_id").collect()] == [(25, [(0, 24, 2)], "x y end"), (0, [], "")]
    assert pr.run_digests(pr.with_planted_runs(docs([]))).count() == 0


def test_plan_has_no_shuffle(spark, sf):
    plan = pr.run_digests(pr.with_planted_runs(spark.read.parquet(f"{sf}/documents.parquet")))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
