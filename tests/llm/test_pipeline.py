import hashlib
from collections import Counter

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline as cp  # noqa: E402
from civicflow.llm import quality, secrets  # noqa: E402
from civicflow.session import materialize  # noqa: E402

from .test_bpe import library_ids  # noqa: E402
from .test_near_dedup import brute_classes  # noqa: E402
from .test_quality import measured  # noqa: E402


def passes(text):
    m = measured(text)
    return not any(eval(r.fails.replace("AND", "and").replace("OR", "or"), {}, m) for r in quality.RULES if r.name in quality.POLICIES["v2"])


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    columns, results = docs.columns, []
    for number, (_, stage) in enumerate(cp.STAGES):
        docs = materialize(stage(spark, docs, sf), f"test-stage{number}")
        assert number == 4 or docs.columns == columns
        results.append(docs.collect())
    kept = [r for r in rows if passes(r[1])]
    assert sorted(r["doc_id"] for r in results[0]) == sorted(r[0] for r in kept)
    heads = {int(c) for _, c in brute_classes(kept)}
    assert sorted(r["doc_id"] for r in results[1]) == sorted(heads)
    clean = {r[0]: secrets.redacted(r[1], secrets.find_spans(r[1])) for r in kept if r[0] in heads}
    assert {r["doc_id"]: r["text"] for r in results[2]} == clean and all(r["n_chars"] == len(r["text"]) for r in results[2])
    shown = Counter(r["doc_id"] for r in results[3])
    assert set(shown) == set(clean) and max(shown.values()) <= 2
    assert Counter(r["doc_id"] for r in results[4]) == shown
    for r in results[4]:
        assert bytes(r["ids"]) == library_ids(clean[r["doc_id"]])
        assert r["ids_sha256"] == hashlib.sha256(bytes(r["ids"])).hexdigest() and r["n_tokens"] == len(r["ids"]) // 4


def test_nulls_and_empty_tables_pass_every_stage(spark, docs):
    for rows in ([], [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "one two three. " * 40, None, None, None), (3, " ".join(f"w{i}" for i in range(60)), "en", "s", 0)]):
        df = docs(rows)
        for number, (_, stage) in enumerate(cp.STAGES):
            df = materialize(stage(spark, df, ""), f"test-null{number}")
        assert {r["doc_id"] for r in df.collect()} == ({3} if rows else set())
