import math
import random
from collections import Counter, defaultdict

import pytest
import xxhash

from civicflow.llm import mixing


def test_bisection_meets_the_target():
    tokens = [10_000, 3_000, 500, 20]
    shares = [t / sum(tokens) for t in tokens]
    target = (mixing.entropy(shares) + math.log(4)) / 2
    a = mixing.bisect_exponent(tokens, target_entropy=target)
    assert 0 < a < 1 and abs(mixing.entropy(mixing.temperature_weights(tokens, a)) - target) < 1e-9
    a = mixing.bisect_exponent(tokens, budget=sum(tokens), max_passes=4)
    assert abs(max(mixing.passes_of(tokens, mixing.temperature_weights(tokens, a), sum(tokens))) - 4) < 1e-6
    assert mixing.bisect_exponent([5, 5], max_passes=2) == 0  # equal already
    assert abs(mixing.bisect_exponent(tokens, budget=sum(tokens), max_passes=1) - 1) < 1e-9
    with pytest.raises(ValueError):
        mixing.bisect_exponent(tokens)


def corpus():
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), "en", "big", i) for i in range(700)]
    rows += [(1000 + i, "a b c", "en", "small", i) for i in range(12)] + [(2000 + i, None, "de", None, i) for i in range(5)]
    return rows + [(None, "x y", "en", "mid", 0)] * 3 + [(3000 + i, "tok " * rng.randint(1, 50), "en", "mid", i) for i in range(80)]


def words(t):
    return max(1, len((t or "").split()))


@pytest.mark.parametrize("more", [{"budget_ratio": 1.0, "max_passes": 4.0}, {"max_passes": 2.5}, {"budget_ratio": 0.5, "target_entropy": 1.2}])
@pytest.mark.parametrize("block_tokens", [50, 1 << 20])
def test_budgets_are_met_by_whole_passes_and_one_part(spark, docs, more, block_tokens):
    rows = corpus()
    out = mixing.mix(docs(rows), block_tokens=block_tokens, **more).collect()
    total, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        total[r[3]] += words(r[1])
        largest[r[3]] = max(largest[r[3]], words(r[1]) * (3 if r[0] is None else 1))
    names = list(total)
    tokens = [total[n] for n in names]
    budget = more["budget_ratio"] * sum(tokens) if "budget_ratio" in more else None
    a = mixing.bisect_exponent(tokens, budget, more.get("target_entropy"), more.get("max_passes"))
    passes = dict(zip(names, mixing.passes_of(tokens, mixing.temperature_weights(tokens, a), budget)))
    every = Counter((r[0], r[3], r[1]) for r in rows)
    by_epoch = defaultdict(Counter)
    for r in out:
        assert 0 <= r["mix_key"] < 1
        by_epoch[r["source"], r["epoch"]][r["doc_id"], r["source"], r["text"]] += 1
    for name in names:
        own = Counter({k: n for k, n in every.items() if k[1] == name})
        whole = int(passes[name] + 1e-9)
        for e in range(whole):
            assert by_epoch[name, e] == own
        assert by_epoch[name, whole] <= own and not by_epoch[name, whole + 1]
        shown = sum(r["tokens"] for r in out if r["source"] == name)
        assert passes[name] * total[name] - 1e-6 <= shown < passes[name] * total[name] + largest[name] + 1e-6
    if budget is None:
        assert {k for e in by_epoch.values() for k in e} == set(every)


def test_sources_interleave_and_runs_repeat(spark, docs):
    out = [sorted((r["mix_key"], r["epoch"], r["doc_id"] or -1) for r in mixing.mix(docs(corpus()).repartition(n), max_passes=2.0, block_tokens=20).collect()) for n in (2, 5)]
    assert out[0] == out[1]


def test_empty_table_and_clashes(spark, docs):
    assert mixing.mix(docs([]), max_passes=2.0).count() == 0
    from pyspark.sql import functions as F

    out = mixing.mix(docs(["a b"]).withColumn("epoch", F.lit("x")).withColumn("tokens", F.lit(None)), max_passes=2.0).collect()
    assert [(r["epoch"], r["tokens"]) for r in out] == [(0, 2)]


def test_input_columns_with_the_names_of_working_columns(spark, docs):
    from pyspark.sql import functions as F

    names = ["src", "passes", "whole", "part_tokens", "n_blocks", "limit", "last", "row", "own", "end", "start", "n", "room", "e_src", "p_src", "Whole2",
             "_doc", "_block", "_at", "_n", "_w", "_l", "_id", "_key", "_text_key"]
    plain = docs(corpus())
    more = plain.select("*", *[F.concat(F.lit(c), F.coalesce("doc_id", F.lit(-1))).alias(c) for c in names])
    out = [mixing.mix(df, budget_ratio=1.0, max_passes=3.0, block_tokens=50) for df in (plain, more)]
    assert out[1].columns == [*more.columns, "tokens", "epoch", "mix_key"]
    rows = [sorted(map(str, o.select("doc_id", "source", "tokens", "epoch", "mix_key").collect())) for o in out]
    assert rows[0] == rows[1]
    for r in out[1].collect():
        assert all(r[c] == c + str(-1 if r["doc_id"] is None else r["doc_id"]) for c in names)


def test_many_sources_are_not_collected(spark, docs, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    rows = [(i, "w " * (1 + i % 7), "en", f"host{i}" if i else None, 0) for i in range(3000)]
    collected, collect = [], DataFrame.collect
    df = docs(rows)
    monkeypatch.setattr(DataFrame, "collect", lambda self: collected.append(collect(self)) or collected[-1])
    mixed = mixing.mix(df, budget_ratio=1.0, max_passes=1.5)
    assert max(map(len, collected), default=0) <= 7
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan
    monkeypatch.undo()
    shown = Counter(r["source"] for r in mixed.collect())
    assert max(shown.values()) <= 2
    tokens = [1 + i % 7 for i in range(3000)]
    passes = mixing.passes_of(tokens, mixing.temperature_weights(tokens, mixing.bisect_exponent(tokens, sum(tokens), max_passes=1.5)), sum(tokens))
    for i, p in enumerate(passes):  # a source of one document: whole passes, and the part pass shows it if it is not empty
        assert abs(shown[f"host{i}" if i else None] - math.ceil(p - 1e-6)) <= (1 if abs(p - round(p)) < 1e-6 else 0)


def test_targets_out_of_reach_are_errors(spark, docs):
    tokens = [10_000, 3_000, 500, 20]
    natural = mixing.entropy([t / sum(tokens) for t in tokens])
    for wrong in ({"target_entropy": natural - 0.01}, {"target_entropy": math.log(4) + 0.01}, {"budget": 5 * sum(tokens), "max_passes": 4}, {"max_passes": 0.9}):
        with pytest.raises(ValueError, match="can't be met"):
            mixing.bisect_exponent(tokens, **wrong)
    assert mixing.bisect_exponent(tokens, target_entropy=math.log(4)) < 1e-6
    assert mixing.bisect_exponent(tokens, target_entropy=natural) > 1 - 1e-6
    with pytest.raises(ValueError, match="can't be met"):
        mixing.mix(docs(corpus()), budget_ratio=5, max_passes=4)


def spark_hash(*values):
    """xxhash64 over columns: each value is hashed with the hash before it as seed."""
    import struct

    h = 42
    for v in values:
        if v is None:
            continue
        data = v.encode() if isinstance(v, str) else struct.pack("<i" if isinstance(v, Int) else "<q", v)
        h = xxhash.xxh64_intdigest(data, h)
    return h - (h >> 63 << 64)


class Int(int):
    """A value of Spark's type int."""


def brute_mix(rows, block_tokens, seed, budget_ratio=None, target_entropy=None, max_passes=None):
    """All passes of all sources, a document at a time."""
    sources = defaultdict(list)
    for r in rows:
        sources[r[3]].append((spark_hash(Int(seed + 1), r[0], r[1]), words(r[1]), r))
    total = {s: sum(d[1] for d in own) for s, own in sources.items()}
    tokens = list(total.values())
    budget = None if budget_ratio is None else budget_ratio * sum(tokens)
    exponent = mixing.bisect_exponent(tokens, budget, target_entropy, max_passes)
    passes = dict(zip(total, mixing.passes_of(tokens, mixing.temperature_weights(tokens, exponent), budget)))
    uniform = lambda *v: (spark_hash(Int(seed), *v) & ((1 << 52) - 1)) / float(1 << 52)
    out = Counter()
    for source, own in sources.items():
        n_blocks = -(-total[source] // block_tokens)
        whole = int(passes[source] + 1e-9)
        room = max(0.0, passes[source] - whole) * total[source]
        placed = [(uniform(source, spark_hash(Int(seed), h) % n_blocks, Int(whole)), spark_hash(Int(seed), h) % n_blocks, h, n, r) for h, n, r in own]
        shown, before = [], 0
        for at, block, h in sorted({p[:3] for p in placed}):  # the part pass: documents in order until the room is used up
            same = [p for p in placed if p[:3] == (at, block, h)]
            if before < room:
                shown += same
            before += sum(p[3] for p in same)
        for epoch in range(whole + 1):
            for _, block, _, _, r in placed if epoch < whole else shown:
                key = min((epoch + uniform(source, block, Int(epoch))) / passes[source], 1 - 2.0**-52)
                out[r[0], r[1], r[3], epoch, round(key, 9)] += 1
    return out


@pytest.mark.parametrize("more", [{"budget_ratio": 1.0, "max_passes": 4.0}, {"max_passes": 2.5}, {"budget_ratio": 0.5, "target_entropy": 1.2}])
@pytest.mark.parametrize("block_tokens", [40, 700, 1 << 20])
def test_whole_mixture_against_brute_force(spark, docs, more, block_tokens):
    rows = corpus()
    out = mixing.mix(docs(rows), block_tokens=block_tokens, seed=5, **more).collect()
    assert Counter((r["doc_id"], r["text"], r["source"], r["epoch"], round(r["mix_key"], 9)) for r in out) == brute_mix(rows, block_tokens, 5, **more)
