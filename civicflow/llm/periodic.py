"""Periodic runs of words: seeds on diagonals, extended once.

Words are the parts of a text between ASCII white space.  A run is a stretch
whose words a period q apart are identical, q the smallest such number, of at
least max(24, 3 q) words, and not to be extended on either side.

Method.  In a run of period q the words of at least ``guaranteed(q)`` places
in a row equal those q further on: 16 for q up to 16, more than 2 q beyond.
So the k-grams of the text are indexed for k = 16, 32, 64, ..., each k serving
the periods of (k/2, k] (16: all up to 16), whose guaranteed overlap is at
least k.  Occurrence pairs are formed inside one document, each place with the
*next* place of its k-gram: as k >= q, a nearer occurrence inside the run would
give it a smaller period, so in a run the next occurrence of every k-gram lies
exactly q words on.  A pair is a seed on the diagonal of its lag.  Seeds that
follow each other on a diagonal are one stretch; a stretch too short for a run
is no run's, the others are extended to both sides, unless the table of the
furthest place covered per lag shows that a run already holds them.

The k-grams are named exactly: names of 2k-grams are those of pairs of
k-grams.  Most texts repeat no 16-gram; a rolling hash shows that first (equal
k-grams have equal hashes).  Work is n log n for n words whatever the text,
memory in proportion to the longest text; one text is one row of one task, and
rows are not shuffled.

Defined results: a null text has no words; repeated rows give repeated
results; further input columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.llm.common import unused

LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Length of the shortest k-grams: the least overlap of any run with itself.
GRAM = 16
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
#: Rows of a batch that are Python objects at a time.
ROWS_AT_ONCE = 256


def least_length(period):
    return np.maximum(LEAST_WORDS, LEAST_PERIODS * period)


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers, equal ones alike."""
    table = dict.fromkeys(words)
    table = dict(zip(table, range(len(table))))
    return np.fromiter(map(table.__getitem__, words), np.int64, len(words))


def repeats_a_gram(x: np.ndarray) -> bool:
    """Whether the hash of a GRAM-gram occurs twice (true if a GRAM-gram does)."""
    h, width = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), 1
    h ^= h >> np.uint64(29)
    while width < GRAM:
        h = h[:-width] * np.uint64(0xD6E8FEB86659FD93) + h[width:]
        h ^= h >> np.uint64(31)
        width *= 2
    h.sort()
    return bool((h[1:] == h[:-1]).any())


def doubled(names: np.ndarray, width: int) -> np.ndarray:
    """Names of the 2 width-grams from those of the width-grams."""
    pairs = names[:-width] * (int(names.max()) + 1) + names[width:]
    return np.unique(pairs, return_inverse=True)[1]


def next_occurrence(names: np.ndarray) -> np.ndarray:
    """Distance of each place to the next place of the same name, 0 for the last."""
    order = np.argsort(names, kind="stable")
    out = np.zeros(len(names), np.int64)
    same = names[order[1:]] == names[order[:-1]]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def stretches(lags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First seed, number of seeds and lag of each row of seeds on a diagonal."""
    bounds = np.flatnonzero(np.concatenate([[True], lags[1:] != lags[:-1]]))
    sizes, lag = np.diff(np.append(bounds, len(lags))), lags[bounds]
    return bounds[lag > 0], sizes[lag > 0], lag[lag > 0]


def extended(x: np.ndarray, a: int, b: int, lag: int) -> tuple[int, int]:
    """The places from a to b, whose words equal those ``lag`` further on, with
    all neighbours of which that is true as well."""
    while a > 0 and x[a - 1] == x[a - 1 + lag]:
        a -= 1
    while b + lag < len(x) and x[b] == x[b + lag]:
        b += 1
    return a, b


def periodic_runs(x: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of numbers, by start and period."""
    n, found, covered = len(x), [], {}
    if n < LEAST_WORDS or not repeats_a_gram(x):
        return found
    names, width = x, 1
    while width < GRAM:
        names, width = doubled(names, width), width * 2
    low = 0
    while True:
        lags = next_occurrence(names)
        if not lags.any():
            break  # nor does a longer gram occur twice
        lags[(lags <= low) | (lags > width)] = 0
        starts, sizes, lag = stretches(lags)
        enough = sizes + width - 1 + lag >= least_length(lag)
        for start, size, q in zip(starts[enough].tolist(), sizes[enough].tolist(), lag[enough].tolist()):
            if start < covered.get(q, 0):
                continue
            a, b = extended(x, start, start + size + width - 1, q)
            covered[q] = b
            found.append((a, b - a + q, q))
        if LEAST_PERIODS * (width + 1) > n or 2 * width > n:
            break  # no room for three periods beyond this width
        low, names, width = width, doubled(names, width), width * 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside runs and in the first period of theirs, joined by spaces."""
    if not runs:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        depth[start + q] += 1
        depth[start + length] -= 1
    keep = np.cumsum(depth[:-1]) == 0
    return b" ".join([w for w, k in zip(words, keep.tolist()) if k])


def scan(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and the collapsed text of every row."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                sizes, runs, texts = [], [], []
                for t in part.column(1).to_pylist():
                    words = (t or b"").split()  # bytes: parts at ASCII white space
                    found = periodic_runs(numbered(words)) if len(words) >= LEAST_WORDS else []
                    sizes.append(len(words))
                    runs.append([{"start": a, "length": n, "period": q} for a, n, q in found])
                    texts.append(collapsed(words, found))
                kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    found = rows.mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: Column) -> Column:
    """The run of the greatest length / period, compared exactly; of equals the first."""
    better = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    return F.reduce(runs, F.get(runs, F.lit(0)), lambda a, b: F.when(better(a, b), b).otherwise(a))


def run_digests(documents: DataFrame) -> DataFrame:
    """Digest columns of the runs of every document."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return scan(documents).withColumn("best", strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """``documents`` in which every row whose crc32 of the id is divisible by ten
    repeats a stretch of its words to its end (a null id: left as it is)."""
    names = documents.columns
    h, w, a, p, t = unused(names, "_hash", "_words", "_from", "_period", "_planted")
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    planted = documents.withColumn(h, F.crc32(F.col("doc_id").cast("string")))
    planted = planted.withColumn(w, F.when(F.col(h) % 10 == 0, words))
    planted = planted.withColumn(a, F.when(F.size(w) > 0, F.expr(f"({h} div 10) % size({w})")))
    planted = planted.withColumn(p, F.expr(f"1 + (size({w}) - {a}) div (3 + ({h} div 10) % 8)"))
    planted = planted.withColumn(t, F.when(F.col(a).isNotNull(), F.expr(
        f"array_join(transform(sequence(0, size({w}) - 1), i -> {w}[CAST(IF(i < {a}, i, {a} + (i - {a}) % {p}) AS int)]), ' ')")))
    changed = F.coalesce(F.col(t), F.col("text"))
    return planted.select(*[changed.alias(c) if c == "text" else F.col(f"`{c}`") for c in names])
