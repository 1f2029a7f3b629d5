"""Token-id files coded with canonical length-limited Huffman codes.

``encode_words`` turns texts into ids, ``write`` codes them into files in
ascending document order and ``read`` decodes the files again.

Code.  Global counts of all ids (one row per id, so at most the vocabulary)
give code lengths by the package-merge method under a limit; the canonical
code follows from the lengths alone, so a file stores only these.  With the
limit of 16 bits one table of 65,536 entries decodes any symbol; more than
65,536 ids in use raise the limit to what their number needs.

File.  Magic, zlib-compressed code lengths, blocks, and nothing else: the
manifest (a Parquet table) lists each block's place.  A block holds whole
documents and decodes by itself.  Its header has the document ids, their id
counts and the file position of the first id; every ``CHECKPOINT`` ids of a
document there is a checkpoint with the bit offset where decoding can start,
and all checkpoints of a block are decoded side by side with array operations.

Order and recovery.  Documents go through one range exchange by document id
(ties by content, then by a row number fixed in a written table) and each task
writes one file.  A file's name has the task attempt in it and only the
manifest makes it count, so repeated or lost attempts change nothing.

Defined results: a null text is an empty one (only the end id is written);
null document ids come first; repeated rows are kept, one by one; an empty
table gives an empty manifest; further columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import struct
import unicodedata
import zlib
from array import array

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from civicflow.llm.bpe import byte_of_char, few_at_once
from civicflow.llm.common import BoundedMemo, per_process, read_range, shared_uri, write_file
from civicflow.session import scratch_path

#: Fixed values of the word tokenizer's format: what a pre-token is, and the
#: normaliser for which words are split here.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}

MAGIC = b"CFHUF1\n"
MAX_BITS = 16
CHECKPOINT = 128
#: Ids in a block, unless one document has more.
BLOCK_IDS = 65_536
#: Ids in a file; their number follows the data.
FILE_IDS = 4_000_000
#: Words kept by a worker process (some 200 bytes each).
MEMO_ENTRIES = 1_200_000
#: White space for str.split but not in Unicode's White_Space.
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")

MANIFEST_SCHEMA = "file string, file_no int, offset long, length long, n_docs long, n_ids long"


# ---------------------------------------------------------------- tokens

class MarkedPieces:
    """Byte-level BPE whose last symbol carries a suffix, on a ranked byte-pair merger.

    The merger knows bytes only, so a piece is closed with the byte 0xFF, which
    UTF-8 never has: the pairs (byte, 0xFF) have the lowest ranks and are joined
    first, and the tokens with the suffix are the byte strings that end with it.
    """

    def __init__(self, model: dict, extra_ids: int):
        to_byte, suffix, vocab = byte_of_char(), model["end_of_word_suffix"], model["vocab"]
        stand_in = {b: c for c, b in to_byte.items()}

        def raw(token: str) -> bytes:
            end = b"\xff" if token.endswith(suffix) else b""
            return bytes(to_byte[c] for c in token[:len(token) - len(suffix) * len(end)]) + end

        symbols = [stand_in[b] for b in range(256)] + [stand_in[b] + suffix for b in range(256)] + [a + b for a, b in model["merges"]]
        ranks = {bytes([b]): b for b in range(256)} | {bytes([b, 255]): 256 + b for b in range(256)}
        ranks |= {raw(s): 512 + i for i, s in enumerate(symbols[512:])}
        if len(ranks) != len(symbols):
            raise ValueError("two merges give the same token")
        #: Id of every rank; ids that no merge makes (special tokens) follow.
        made = [vocab[s] for s in symbols]
        self.ids = np.array(made + sorted(set(range(max(made) + extra_ids + 1)) - set(made)), "<u4")
        self.rank_of = np.argsort(self.ids).astype(np.uint32)
        self._merge = tiktoken.Encoding("pieces", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    @staticmethod
    def fits(model: dict) -> bool:
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
        return model.get("type") == "BPE" and plain and bool(model.get("end_of_word_suffix"))

    def ranks(self, piece: bytes) -> bytes:
        """Ranks (unsigned 32-bit integers) of the tokens of a piece."""
        return array("I", self._merge(piece + b"\xff")).tobytes()


class WordEncoder:
    """A tokenizer whose pre-tokens never contain white space, memoised by the
    words of ``str.split``.

    Words of letters below U+0250 are lower-cased and split here and their
    pre-tokens merged here (``MarkedPieces``; tests hold it to the library); all
    other words, and texts in which ``str.split`` is not the tokenizer's own, go to
    the tokenizer whole.
    """

    def __init__(self, text: str):
        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(text)
        self.pretoken = regex.compile(PRETOKEN)
        self.known = spec["normalizer"] == NORMALIZER and MarkedPieces.fits(spec["model"])
        # What the memos hold are ranks then, which become ids text by text.
        self.pieces = MarkedPieces(spec["model"], len(spec["added_tokens"])) if self.known else None
        self.word_ids = BoundedMemo(self._word, MEMO_ENTRIES).__getitem__

    def _whole(self, text: str) -> bytes:
        ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return (self.pieces.rank_of[ids] if self.known else ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        return self.pieces.ranks(piece.encode())

    def _word(self, word: str) -> bytes:
        if not self.known or "<|" in word:
            return self._whole(word)
        if not word.isascii():
            if max(word) >= "\u0250":
                return self._whole(word)
            word = unicodedata.normalize("NFC", word)
        word = word.lower()
        if word.isalpha():  # letters only: one pre-token
            return self._piece(word)
        if word[:-1].isalpha() and word[-1].isascii() and not word[-1].isalnum():  # and a sign at the end: two
            return self._piece(word[:-1]) + self._piece(word[-1])
        return b"".join(map(self._piece, self.pretoken.findall(word)))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(s in text for s in SEPARATORS):
            found = self._whole(text)
        else:
            found = b"".join(map(self.word_ids, text.split()))
        found = np.frombuffer(found, np.uint32)
        return (self.pieces.ids[found] if self.known else found.astype("<u4")).tobytes()


def encode_words(documents: DataFrame, path: str, end_id: int, narrow: bool) -> DataFrame:
    """doc_id, ids (little-endian, with the end id appended; 16-bit if ``narrow``)
    and ``tie``, a row number that a written copy of the result fixes."""
    spark = documents.sparkSession
    with open(path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()

    def encode(texts: pa.Array) -> pa.Array:
        words = per_process(("words", hash(shared.value)), lambda: WordEncoder(shared.value))
        ids = (words.encode(t) + end for t in few_at_once(texts))
        if narrow:
            ids = (np.frombuffer(i, "<u4").astype("<u2").tobytes() for i in ids)
        return pa.array(ids, pa.binary())

    column = F.arrow_udf(encode, "binary")(F.col("text"))
    return documents.select("doc_id", column.alias("ids"), F.monotonically_increasing_id().alias("tie"))


# ---------------------------------------------------------------- code

def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Length-limited Huffman code lengths by package-merge; 0 for unused ids.  The
    limit is ``max_bits``, or what the number of ids in use needs."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    max_bits = max(max_bits, (len(used) - 1).bit_length())
    if len(used) == 1:
        lengths[used] = 1
    if len(used) < 2:
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64).tolist()
    # Each level's list, as the number of leaves in any of its prefixes.
    level, leaves_in_prefix = [(w, 1) for w in weights], []
    leaves = [(w, 1) for w in weights]
    for _ in range(max_bits):
        flags = [leaf for _, leaf in level]
        leaves_in_prefix.append(np.concatenate([[0], np.cumsum(flags)]))
        packages = [(level[i][0] + level[i + 1][0], 0) for i in range(0, len(level) - 1, 2)]
        level = list(heapq.merge(leaves, packages, key=lambda x: x[0]))
    take = 2 * len(used) - 2
    for prefix in reversed(leaves_in_prefix):  # the last list is the outermost
        n = int(prefix[take])
        lengths[order[:n]] += 1
        take = 2 * (take - n)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The canonical code: shorter first, then by id."""
    codes = np.zeros(len(lengths), np.uint32)
    used = np.flatnonzero(lengths)
    code, last = 0, 0
    for i in used[np.lexsort((used, lengths[used]))].tolist():
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and length for every window of as many bits as the longest code has."""
    max_bits = max(MAX_BITS, int(lengths.max(initial=0)))
    symbols, widths = np.zeros(1 << max_bits, np.uint32), np.zeros(1 << max_bits, np.uint8)
    codes = canonical_codes(lengths)
    for i in np.flatnonzero(lengths).tolist():
        n = int(lengths[i])
        at = int(codes[i]) << (max_bits - n)
        symbols[at:at + (1 << (max_bits - n))] = i
        widths[at:at + (1 << (max_bits - n))] = n
    return symbols, widths


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, int]:
    """The codes of ``ids`` one after the other, most significant bit first."""
    n = lengths[ids].astype(np.int64)
    ends = np.cumsum(n)
    bits = int(ends[-1]) if len(ends) else 0
    starts = ends - n
    word = starts >> 5
    value = codes[ids].astype(np.uint64) << (64 - (starts & 31) - n).astype(np.uint64)
    size = (bits >> 5) + 2
    # The bits of different codes never overlap, so sums (exact below 2^53) join them.
    joined = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), size)
    joined += np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), size)
    return joined.astype(np.uint64).astype(">u4").tobytes()[: (bits + 7) // 8], bits


def unpack(data: bytes, starts: np.ndarray, counts: np.ndarray, table) -> np.ndarray:
    """Ids of all lanes in order; lane k begins at bit ``starts[k]`` and has ``counts[k]`` ids."""
    symbols, widths = table
    max_bits = len(symbols).bit_length() - 1
    raw = np.frombuffer(data + b"\0" * 8, np.uint8).astype(np.uint32)
    windows = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]  # 32 bits from each byte on
    out = np.empty(int(counts.sum()), np.uint32)
    at = starts.astype(np.int64)
    to = np.cumsum(counts) - counts
    by_size = np.argsort(-counts, kind="stable")
    at, to, left = at[by_size], to[by_size].astype(np.int64), counts[by_size]
    for step in range(int(left[0]) if len(left) else 0):
        alive = int(np.searchsorted(-left, -step, side="left"))
        here = at[:alive]
        window = (windows[here >> 3] << (here & 7).astype(np.uint32)) >> np.uint32(32 - max_bits)
        out[to[:alive] + step] = symbols[window]
        at[:alive] = here + widths[window]
    return out


# ---------------------------------------------------------------- files

def block_bytes(docs: list[tuple], first: int, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, int]:
    """One block of (doc_id, ids); ``first``: the file position of its first id."""
    ids = np.concatenate([d[1] for d in docs])
    data, _ = pack(ids, codes, lengths)
    sizes = np.array([len(d[1]) for d in docs], "<u8")
    bit = np.concatenate([[0], np.cumsum(lengths[ids].astype(np.int64))])
    marks = lane_starts(sizes)[0]
    known = np.array([d[0] is not None for d in docs], np.uint8)
    head = b"".join([
        np.array([d[0] or 0 for d in docs], "<i8").tobytes(), known.tobytes(), sizes.tobytes(), bit[marks].astype("<u8").tobytes(),
    ])
    body = struct.pack("<QQQQ", len(docs), first, len(marks), len(data)) + head + data
    return body + struct.pack("<I", zlib.crc32(body)), len(ids)


def lane_starts(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position in the block and id count of each checkpoint."""
    sizes = sizes.astype(np.int64)
    lanes = -(-sizes // CHECKPOINT)
    doc = np.repeat(np.arange(len(sizes)), lanes)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    base = np.cumsum(sizes) - sizes
    return base[doc] + k * CHECKPOINT, np.minimum(CHECKPOINT, sizes[doc] - k * CHECKPOINT)


def read_block(block: bytes, table):
    """(doc_id, position of its first id in the file, ids) of a block's documents."""
    if zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("damaged block")
    n, first, n_marks, n_data = struct.unpack_from("<QQQQ", block)
    at = 32
    doc_ids = np.frombuffer(block, "<i8", n, at)
    known = np.frombuffer(block, np.uint8, n, at + 8 * n)
    sizes = np.frombuffer(block, "<u8", n, at + 9 * n).astype(np.int64)
    bits = np.frombuffer(block, "<u8", n_marks, at + 17 * n)
    data = block[at + 17 * n + 8 * n_marks:][:n_data]
    ids = unpack(data, bits, lane_starts(sizes)[1], table)
    ends = np.cumsum(sizes)
    for i in range(n):
        a, b = int(ends[i] - sizes[i]), int(ends[i])
        yield (int(doc_ids[i]) if known[i] else None), int(first) + a, ids[a:b]


def write(documents: DataFrame, path: str, folder: str, end_id: int = 1, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode ``documents`` (doc_id, text) with the tokenizer at ``path`` and write
    their ids to files in ``folder``, a shared place; the manifest, written too."""
    spark = documents.sparkSession
    with open(path, encoding="utf-8") as f:
        n_symbols = max(Tokenizer.from_str(f.read()).get_vocab_size(), end_id + 1)
    narrow = n_symbols <= 65_536
    kind = "<u2" if narrow else "<u4"
    folder = shared_uri(spark, folder)
    staged = f"{folder}/ids"
    encode_words(documents, path, end_id, narrow).write.option("compression", "zstd").parquet(staged)
    tokens = spark.read.parquet(staged)

    def count(batches):
        total = np.zeros(n_symbols, np.int64)
        for b in batches:
            for i in b.column(0).to_pylist():
                total += np.bincount(np.frombuffer(i, kind), minlength=n_symbols)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["id", "n"])

    # One row per id: bounded by the vocabulary, whatever the data.
    rows = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(n_symbols, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    code = spark.sparkContext.broadcast((canonical_codes(lengths), lengths))
    n_files = max(1, -(-int(counts.sum()) // file_ids))

    def write_files(batches):
        codes, lengths = code.value
        task = TaskContext.get()
        name = f"{folder}/files/{task.partitionId():06d}-{task.taskAttemptId()}.huf"
        found, state = [], {"at": 0, "first": 0}

        def parts():
            table = zlib.compress(lengths.tobytes())
            yield from started(MAGIC + struct.pack("<II", len(lengths), len(table)) + table)
            docs, n = [], 0
            for b in batches:
                for doc_id, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    ids = np.frombuffer(raw, kind).astype(np.int64)
                    if docs and n + len(ids) > BLOCK_IDS:
                        yield from flush(docs)
                        docs, n = [], 0
                    docs.append((doc_id, ids))
                    n += len(ids)
            if docs:
                yield from flush(docs)

        def started(head):
            state["at"] += len(head)
            yield head

        def flush(docs):
            data, n = block_bytes(docs, state["first"], codes, lengths)
            found.append((name, task.partitionId(), state["at"], len(data), len(docs), n))
            state["first"] += n
            state["at"] += len(data)
            yield data

        write_file(name, parts())
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[i] for f in found], t) for i, t in enumerate(
                (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))],
            ["file", "file_no", "offset", "length", "n_docs", "n_ids"])

    order = ["doc_id", F.xxhash64("ids"), "tie"]
    manifest = tokens.repartitionByRange(n_files, *order).sortWithinPartitions(*order).select("doc_id", "ids").mapInArrow(write_files, MANIFEST_SCHEMA)
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read(manifest: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before
    it), n_tokens, ids (little-endian unsigned 32-bit integers)."""
    files = manifest.groupBy("file", "file_no").agg(F.sum("n_ids").alias("n"))  # one row per file
    before = F.sum("n").over(W.orderBy("file_no").rowsBetween(W.unboundedPreceding, -1))
    bases = files.select("file", F.coalesce(before, F.lit(0)).alias("base"))

    def decode(batches):
        tables = {}
        for b in batches:
            for file, base, offset, length in zip(*(b.column(i).to_pylist() for i in range(4))):
                if file not in tables:
                    tables = {file: decode_table(read_lengths(file))}  # rows come file by file
                docs = list(read_block(read_range(file, offset, length), tables[file]))
                yield pa.RecordBatch.from_arrays([
                    pa.array([d[0] for d in docs], pa.int64()),
                    pa.array([d[1] + base for d in docs], pa.int64()),
                    pa.array([len(d[2]) for d in docs], pa.int64()),
                    pa.array([d[2].astype("<u4").tobytes() for d in docs], pa.binary()),
                ], ["doc_id", "start", "n_tokens", "ids"])

    blocks = manifest.join(bases, "file").select("file", "base", "offset", "length")
    # The rows are narrow, so by their bytes all would go to one task.
    n_files = max(1, manifest.select("file").distinct().count())
    return blocks.repartition(n_files, "file").sortWithinPartitions("file", "offset").mapInArrow(
        decode, "doc_id long, start long, n_tokens long, ids binary")


def read_lengths(file: str) -> np.ndarray:
    head = read_range(file, 0, len(MAGIC) + 8)
    if head[: len(MAGIC)] != MAGIC:
        raise ValueError(f"not a token file: {file}")
    _, size = struct.unpack_from("<II", head, len(MAGIC))
    return np.frombuffer(zlib.decompress(read_range(file, len(MAGIC) + 8, size)), np.uint8)


def file_digests(spark: SparkSession, documents: DataFrame, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    manifest = write(documents, path, scratch_path(spark, "token-files"))
    return read(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
