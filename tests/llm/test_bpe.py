import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from civicflow.llm import bpe  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
VOCABULARY = bpe.ByteVocabulary(open(PATH, encoding="utf-8").read())


def library_ids(text):
    import numpy as np

    return np.array(LIBRARY.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


HARD = ["", " ", "  ", "a  b", "a \n\n b", "\n\n\nx", "don't we're #'s ''s \x07's x''ll", "a\u00a0\u00a0b", "\x1c\x1d a\x1fb",
        "é\u3000\u3000é x", "<|endoftext|>", "a <|endoftext|>b", "<|endoftext", "😀😀 tail  ", "x" * 3000, "\t\tif x:\n\t\t\treturn 1  \n",
        "ab" * 5000, "tab\tthen  two", "日本語のテキスト、です。", "1234567 89", "e\u0301 n\u0303", "\r\n\r\n", "a\x85b \x85 c"]


@pytest.mark.parametrize("text", HARD)
def test_hard_texts_as_the_library(text):
    assert VOCABULARY.encode(text) == library_ids(text)
    assert VOCABULARY.decode(VOCABULARY.encode(text)) == LIBRARY.decode(
        LIBRARY.encode(text, add_special_tokens=False).ids, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(list("aeTs're'dvml 0129.,#$\n\t  \u00a0é日\x07\x1c'\"-")), max_size=40))
def test_random_texts_as_the_library(text):
    assert VOCABULARY.encode(text) == library_ids(text)


def test_fragments_restore_the_text_and_cut_only_certain_pairs():
    raw = " ".join(random.Random(1).choices(HARD, k=50)).encode()
    parts = bpe.split_at(raw, VOCABULARY.text_cuts)
    assert b"".join(parts) == raw and len(parts) > 50
    tokens = set(VOCABULARY.bytes_of)
    pairs = {t[i:i + 2] for t in tokens if t != b"<|endoftext|>" for i in range(len(t) - 1)}
    for a, b in zip(parts, parts[1:]):
        assert a[-1:] + b[:1] not in pairs


def test_memo_is_only_a_memo(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 2)
    small = bpe.ByteVocabulary(open(PATH, encoding="utf-8").read())
    text = " ".join(HARD)
    assert small.encode(text) == VOCABULARY.encode(text)


def test_frame_round_trip_with_nulls_repeats_and_clashes(spark, docs):
    df = docs([*HARD, None, "same", "same", (None, "no id", None, None, None), (7, "again", "en", None, 5)])
    df = df.withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1))
    op = bpe.ByteBPE(spark, PATH)
    rows = op.unpack(op.decode(op.encode(df))).collect()
    assert len(rows) == df.count()
    for r in rows:
        assert bytes(r["ids"]) == library_ids(r["text"])
        assert r["decoded"] == (r["text"] or "")
        assert r["token_ids"] == LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids


def test_query_against_the_library(spark, sf):
    from civicflow.llm.catalog import QUERIES

    got = {r["doc_id"]: r for r in QUERIES["op1_bpe"](spark, sf).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        ids = library_ids(text)
        assert got[i]["n_tokens"] == len(ids) // 4
        assert got[i]["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_empty_table(spark, docs):
    assert bpe.token_digests(spark, docs([]), PATH).count() == 0


def test_round_trip_is_encode_and_decode_in_one_worker(spark, docs):
    df = docs([*HARD, None, "same", "same"]).withColumn("ids", F.lit("clash"))
    op = bpe.ByteBPE(spark, PATH)
    both = op.round_trip(df)
    assert sorted(map(tuple, both.collect()), key=repr) == sorted(map(tuple, op.decode(op.encode(df)).collect()), key=repr)
    plan = bpe.token_digests(spark, df, PATH)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("round_trip(") == 1
