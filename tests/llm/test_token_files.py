import heapq
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from civicflow.llm import token_files as tf  # noqa: E402
from civicflow.session import scratch_path  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = tf.WordEncoder(open(PATH, encoding="utf-8").read())
HARD = ["", " ", "It's  <|endoftext|> don't", "É́ é ñ", "ΟΔΟΣ ΣΑΣ", "a\x1cb\x1d c", "x" * 4000, "word " * 3000, "日本 語",
        " 　 a\x85b", "1234 a1b2", "İstanbul ŒUVRE", "<|startoftext|>a"]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]


def test_words_as_the_library():
    enc = tf.WordEncoder(open(PATH, encoding="utf-8").read())
    for text in [*HARD, " ".join(HARD), None]:
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == library_ids(text)[:-1]


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from(list("aTs're'dvmlß ÉéñİŸ\u0301\u0300Ως 0129.,#$²½\n\u00a0日\x07\x85'\"-<|>")), max_size=30))
def test_random_texts_as_the_library(text):
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == library_ids(text)[:-1]


def huffman_cost(counts):
    heap, total = [int(c) for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        s = heapq.heappop(heap) + heapq.heappop(heap)
        total += s
        heapq.heappush(heap, s)
    return total


def test_code_lengths_are_complete_limited_and_optimal_where_the_limit_is_slack():
    rng = np.random.default_rng(0)
    for n, limit in ((2, 16), (5, 3), (300, 9), (40, 16), (1000, 16)):
        counts = rng.integers(1, 50, n)
        lengths = tf.code_lengths(counts, limit)
        assert lengths.min() >= 1 and lengths.max() <= limit
        assert np.sum(2.0 ** -lengths.astype(float)) == 1
        if limit == 16:
            assert int((counts * lengths).sum()) == huffman_cost(counts)
    fibonacci = [1, 1]
    while len(fibonacci) < 30:
        fibonacci.append(sum(fibonacci[-2:]))
    lengths = tf.code_lengths(np.array(fibonacci), 16)
    assert lengths.max() == 16 and np.sum(2.0 ** -lengths.astype(float)) == 1
    assert tf.code_lengths(np.array([0, 7, 0])).tolist() == [0, 1, 0]


def test_pack_and_unpack_from_any_checkpoint():
    rng = np.random.default_rng(1)
    counts = (rng.pareto(0.6, 5000) * 10).astype(int)
    ids = rng.choice(np.flatnonzero(counts), 3000)
    lengths = tf.code_lengths(counts)
    codes, table = tf.canonical_codes(lengths), tf.decode_table(lengths)
    data, bits = tf.pack(ids, codes, lengths)
    assert len(data) == (bits + 7) // 8
    starts = np.concatenate([[0], np.cumsum(lengths[ids].astype(int))])
    marks = np.array([0, 100, 128, 2500, 2999])
    sizes = np.array([100, 28, 2372, 499, 1])
    assert tf.unpack(data, starts[marks], sizes, table).tolist() == ids.tolist()


@pytest.mark.parametrize("file_ids", [200, 10**6])
def test_files_hold_all_documents_in_order(spark, docs, file_ids):
    df = docs([*HARD, None, "same", "same", (None, "first", None, None, None), (3, "again", "x", None, 1), (3, "again", "x", None, 1)])
    manifest = tf.write(df, PATH, scratch_path(spark, "t"), file_ids=file_ids)
    got = sorted(tf.read(manifest).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in df.collect()), key=lambda i: (i is not None, i))
    at = 0
    texts = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, library_ids(r["text"])) for r in df.collect()))
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == texts


def test_query_against_the_library(spark, sf):
    from civicflow.llm.catalog import QUERIES

    got = {r["doc_id"]: r for r in QUERIES["op2_token_files"](spark, sf).collect()}
    rows = sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda r: r["doc_id"])
    assert len(got) == len(rows)
    at = 0
    for r in rows:
        ids = library_ids(r["text"])
        assert (got[r["doc_id"]]["start"], got[r["doc_id"]]["n_tokens"]) == (at, len(ids))
        assert got[r["doc_id"]]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_empty_table_and_damage(spark, docs):
    assert tf.file_digests(spark, docs([]), PATH).count() == 0
    lengths = tf.code_lengths(np.array([3, 2, 1]))
    block, _ = tf.block_bytes([(1, np.array([0, 1, 2]))], 0, tf.canonical_codes(lengths), lengths)
    with pytest.raises(ValueError):
        list(tf.read_block(block[:40] + b"\xff" + block[41:], tf.decode_table(lengths)))


def test_every_token_and_its_neighbours_as_the_library():
    """Words that are tokens, tokens without an end, and pairs of tokens joined."""
    import random

    to_byte = tf.byte_of_char()
    words = set()
    for token in LIBRARY.get_vocab():
        raw = bytes(to_byte.get(c, 0) for c in token.removesuffix("</w>")).decode(errors="ignore").lower()
        if raw.isalpha():
            words.add(raw)
    rng = random.Random(3)
    words = sorted(words)
    some = words + ["".join(rng.choice(words) for _ in range(rng.randint(2, 5))) for _ in range(20_000)]
    some += ["".join(rng.choice("etaoinshrdluéñß") for _ in range(rng.randint(1, 14))) for _ in range(20_000)]
    for a in range(0, len(some), 500):
        text = " ".join(some[a:a + 500])
        assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == library_ids(text)[:-1]


def test_more_ids_than_sixteen_bits_can_tell_apart():
    rng = np.random.default_rng(1)
    counts = rng.integers(1, 9, 70_001)
    lengths = tf.code_lengths(counts)
    assert 16 < lengths.max() <= 17 and np.sum(2.0 ** -lengths.astype(float)) == 1
    ids = rng.integers(0, 70_001, 5000)
    data, _ = tf.pack(ids, tf.canonical_codes(lengths), lengths)
    starts = np.concatenate([[0], np.cumsum(lengths[ids].astype(np.int64))])[:-1]
    assert (tf.unpack(data, starts[::100], np.full(50, 100), tf.decode_table(lengths)) == ids).all()
