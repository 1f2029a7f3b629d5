"""Byte-level BPE encoding and decoding with forced-boundary splitting.

A merge can only build tokens of the vocabulary.  A pair of neighbouring bytes
that stands inside no token is therefore never bridged by a merge: between
them there is a certain cut.  The encoder looks up every byte pair of a text
in a 65,536-entry table, cuts at the certain places, encodes every fragment by
itself (memoised) and concatenates the ids.

A byte-level pre-tokeniser splits the text first, and a cut may not change
what it sees.  Cuts in the text are hence taken only where its splitting on
both sides is as in the whole text (``text_cuts``); the other certain places,
also those inside a character, cut the pre-tokens.

Defined results: a null text is encoded as the empty text (no ids); special
tokens in a text become their ids, as in the library's default; a repeated row
gives a repeated result; an input column with the name of a result column is
replaced.
"""

from __future__ import annotations

import json
import struct

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.llm.common import BoundedMemo, per_process

#: Fixed values of the byte-level format: the pre-token pattern (with Unicode's
#: White_Space for \s) and the printable stand-ins of the bytes.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRETOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

#: Fragments kept by a worker process.
MEMO_ENTRIES = 100_000
#: Pre-tokens of more bytes are cut at their certain places too (in shorter
#: ones the cuts would cost more than they save; the ids are the same).
LONG_WORD = 48


def byte_of_char() -> dict[str, int]:
    """Stand-in character -> byte: printable bytes stand for themselves, the
    others for the characters from U+0100 on, in order."""
    others = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteVocabulary:
    """Tables of one byte-level BPE vocabulary (tokenizer JSON text)."""

    def __init__(self, text: str):
        spec = json.loads(text)
        to_byte = byte_of_char()
        ranks = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        merged = [ranks[bytes(to_byte[c] for c in a + b)] for a, b in spec["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError("ids of merged tokens must ascend with the rank of their merge")
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        of = {i: b for b, i in ranks.items()} | {i: s.encode() for s, i in self.specials.items()}
        self.bytes_of = [of.get(i, b"") for i in range(max(of) + 1)]
        self.never = self._never_inside(ranks)
        self.text_cuts = self.never & self._splits_alike()
        self._pieces = tiktoken.Encoding("fragments", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={})
        self._pretoken = regex.compile(PRETOKEN)
        self._special = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        self.fragment_ids = BoundedMemo(self._encode_fragment, MEMO_ENTRIES).__getitem__

    @staticmethod
    def _never_inside(tokens) -> np.ndarray:
        inside = np.zeros(65536, bool)
        for t in tokens:
            b = np.frombuffer(t, np.uint8).astype(np.int64)
            inside[b[:-1] * 256 + b[1:]] = True
        return ~inside

    @staticmethod
    def _splits_alike() -> np.ndarray:
        """Byte pairs (left, right) between which the text may be cut without
        changing the pre-tokens on either side, whatever stands around them.

        Before white space: always.  White space before a visible character
        may belong to a longer run whose last character is split off, and an
        apostrophe may begin a contraction: never.  After a character of
        several bytes only before white space, as it may be white space itself.
        """
        b = np.arange(256)
        space = (b == 0x20) | ((b >= 0x09) & (b <= 0x0D))
        visible = (b < 0x80) & ~space & (b != 0x27)
        begins = visible | (b >= 0xC2)
        return (space[None, :] | (visible[:, None] & begins[None, :])).ravel()

    def _encode_fragment(self, fragment: bytes) -> bytes:
        if fragment.isalpha() or fragment[:1] == b" " and fragment[1:].isalpha():  # one pre-token
            words = [fragment]
        else:
            words = [w.encode() for w in self._pretoken.findall(fragment.decode())]
        ids: list[int] = []
        for word in words:
            for piece in split_at(word, self.never) if len(word) > LONG_WORD else [word]:
                ids += self._pieces._encode_single_piece(piece)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode_plain(self, raw: bytes) -> bytes:
        return b"".join(map(self.fragment_ids, split_at(raw, self.text_cuts)))

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self._special is None or not self._special.search(text):
            return self._encode_plain(text.encode())
        out, at = [], 0
        for m in self._special.finditer(text):
            out += [self._encode_plain(text[at:m.start()].encode()), np.array([self.specials[m[0]]], "<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self._encode_plain(text[at:].encode())])

    def decode(self, ids: bytes | None) -> str:
        known = np.frombuffer(ids or b"", "<u4")
        known = known[known < len(self.bytes_of)]
        return b"".join(map(self.bytes_of.__getitem__, known.tolist())).decode(errors="replace")


def split_at(raw: bytes, cuts: np.ndarray) -> list[bytes]:
    """``raw`` cut between the byte pairs marked in ``cuts``; empty for no bytes."""
    b = np.frombuffer(raw, np.uint8)
    if len(b) < 2:
        return [raw] if raw else []
    pairs = b[:-1].astype(np.uint16) << 8 | b[1:]
    ends = (np.flatnonzero(cuts[pairs]) + 1).tolist()
    return [raw[i:j] for i, j in zip([0, *ends], [*ends, len(raw)])]


def few_at_once(texts: pa.Array, n: int = 256):
    """The texts of a batch, of which only ``n`` are Python strings at a time."""
    for a in range(0, len(texts), n):
        yield from texts.slice(a, n).to_pylist()


def vocabulary(shared) -> ByteVocabulary:
    return per_process(("byte bpe", hash(shared.value)), lambda: ByteVocabulary(shared.value))


class ByteBPE:
    """Encode and decode columns with one vocabulary.

    The tokenizer file is read on the driver and its text broadcast (its size
    is that of the vocabulary, whatever the data).
    """

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as f:
            shared = spark.sparkContext.broadcast(f.read())

        def encode(texts: pa.Array) -> pa.Array:
            v = vocabulary(shared)
            return pa.array([v.encode(t) for t in few_at_once(texts)], pa.binary())

        def decode(ids: pa.Array) -> pa.Array:
            v = vocabulary(shared)
            return pa.array([v.decode(i) for i in ids.to_pylist()], pa.string())

        def round_trip(texts: pa.Array) -> pa.Array:
            v = vocabulary(shared)
            ids = [v.encode(t) for t in few_at_once(texts)]
            decoded = pa.array(map(v.decode, ids), pa.string())
            return pa.StructArray.from_arrays([pa.array(ids, pa.binary()), decoded], ["ids", "decoded"])

        def unpack(ids: pa.Array) -> pa.Array:
            return pa.array([np.frombuffer(i or b"", "<u4").astype(np.int32) for i in ids.to_pylist()], pa.list_(pa.int32()))

        self.encode_column = F.arrow_udf(encode, "binary").asNondeterministic()
        self.decode_column = F.arrow_udf(decode, "string").asNondeterministic()
        self.round_trip_column = F.arrow_udf(round_trip, "ids binary, decoded string").asNondeterministic()
        self.unpack_column = F.arrow_udf(unpack, "array<int>").asNondeterministic()

    def encode(self, df: DataFrame, text: str = "text", ids: str = "ids") -> DataFrame:
        """``df`` with ``ids``: binary, little-endian unsigned 32-bit integers."""
        return df.withColumn(ids, self.encode_column(F.col(text)))

    def decode(self, df: DataFrame, ids: str = "ids", text: str = "decoded") -> DataFrame:
        """``df`` with the text of ``ids``; ids outside the vocabulary are skipped."""
        return df.withColumn(text, self.decode_column(F.col(ids)))

    def round_trip(self, df: DataFrame, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
        """``encode`` and ``decode`` in one pass: the columns of both from one
        Python worker a task, where two UDFs one after the other hold two, each
        with its own vocabulary and memo."""
        both = df.withColumn("__round_trip", self.round_trip_column(F.col(text)))
        return both.withColumns({ids: F.col("__round_trip.ids"), decoded: F.col("__round_trip.decoded")}).drop("__round_trip")

    def unpack(self, df: DataFrame, ids: str = "ids", into: str = "token_ids") -> DataFrame:
        """``df`` with the ids as an array of integers."""
        return df.withColumn(into, self.unpack_column(F.col(ids)))


def n_tokens(ids: Column) -> Column:
    return F.octet_length(ids).cast("long") / F.lit(4)


def token_digests(spark: SparkSession, documents: DataFrame, path: str) -> DataFrame:
    """Digest columns of the round trip: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    bpe = ByteBPE(spark, path)
    tokens = bpe.round_trip(documents.select("doc_id", "text"))
    return tokens.select(
        "doc_id",
        n_tokens(F.col("ids")).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
