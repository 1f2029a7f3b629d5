"""Near-duplicate classes by Order MinHash.

Words are the white-space parts of a text in lower case, without punctuation
at their ends; a k-mer is a run of five words.  Equal k-mers of a text are
told apart by their occurrence number.  Each of the sketch's tables picks the
``PICKED`` labelled k-mers with the least hash and keeps them *in the order of
the text*; two texts are candidates if a table has the same ordered picks in
both, which is the likelier the fewer edits lie between them.

Similarity.  Two texts are aligned word by word within a band: the longest
common subsequence of their words, L of n and m, gives L / (n + m - L), an
ordered form of the share of common words that counts every edit once (a share
of k-mers counts one changed word five times).  0.8 or more is a link.  The
band is as wide as the threshold allows, so no link is lost by it.

Recall.  A pair is found if a table has the same picks in both.  From the
shares of common k-mers of the given documents' pairs with 90 % of their words
in common order, 97 % of them are expected to be candidates; a test on the
1,000 documents of the small table holds the classes to 0.9 or more.

Work.  Equal word sequences are first collapsed to one representative.  In
every bucket (a table's value) the members are checked against one of them,
the smallest; linked texts form components.  A bucket whose members are then
still in different components is compared in full: its members are dealt into
blocks of bounded size, every pair of blocks is one unit of work, and a unit
counts the common words of all its pairs by matrix products and aligns those
that could be similar, unless they got linked meanwhile.  It emits links, not
pairs.  So every pair of candidates is either compared or already in one
class, nothing is capped, and copies of one text cost a row each.  Components
come from label propagation with pointer jumping, in written tables; nothing
but counts is collected.

Defined results: texts without words (also null) are classes of their own;
texts of fewer than five words have one k-mer, of all their words; the class
id is the smallest document id in it; rows with a null id take part (a class
of only such rows has a null class id); repeated rows are members like others;
further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.llm.common import BoundedMemo, per_process, unused
from civicflow.session import materialize

WORDS = 5
SIMILARITY = (4, 5)
#: Tables, and picks of each.  One word in twenty changed leaves about 0.7 of the
#: k-mers: such a pair is missed by all tables with probability (1 - 0.7^4)^24 = 0.2 %;
#: at 0.5 it is 21 %.
TABLES, PICKED = 24, 4
#: Texts with fewer k-mers than SHORT pick few in tables of their own; those
#: with LONG and more pick PICKED.  Between the two they do both, and LONG is
#: at most 0.8 SHORT, so similar texts always have tables in common.
SHORT, LONG, SHORT_PICKED, SHORT_TABLES = 32, 25, 2, 16
MEMO_ENTRIES = 300_000
#: Hashes in memory at once when a long text is sketched.
CHUNK = 1 << 20
#: Members and words of a block, and columns of an incidence slice.
UNIT_ROWS, UNIT_WORDS, SLICE = 512, 1_000_000, 8192

SKETCH_SCHEMA = "doc_id long, uid long, text_key string, digest binary, n long, words binary, sketch array<long>"


# ---------------------------------------------------------------- sketch

def word_hash(word: str) -> int:
    """Hash of the normalised word; 0 for a part without letters or digits."""
    word = word.lower()
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return (xxhash.xxh3_64_intdigest(word[a:b]) | 1) if a < b else 0


def word_hashes(text: str | None, memo=None) -> np.ndarray:
    parts = (text or "").split()
    found = np.fromiter(map(memo or word_hash, parts), np.uint64, len(parts))
    return found[found != 0]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def kmers(words: np.ndarray) -> np.ndarray:
    """Hash of every run of five words; of all words if there are fewer."""
    words = words.astype(np.uint64)
    if not len(words):
        return words
    width = min(WORDS, len(words))
    out = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        out = mixed(out + words[i:len(words) - width + 1 + i])
    return out


def labelled(found: np.ndarray) -> np.ndarray:
    """k-mers with their occurrence number hashed in."""
    order = np.argsort(found, kind="stable")
    ranked = found[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    number = np.arange(len(found)) - np.repeat(starts, np.diff(np.append(starts, len(found))))
    out = np.empty_like(found)
    out[order] = mixed(ranked + number.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return out


def picks(labels: np.ndarray, tables: int, picked: int, salt: int) -> np.ndarray:
    """One value per table: the least ``picked`` labels, in text order."""
    seeds = mixed(np.arange(1, tables + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F) + np.uint64(salt)) | np.uint64(1)
    values = np.empty(tables, np.uint64)
    picked = min(picked, len(labels))
    step = max(1, CHUNK // len(labels))
    for a in range(0, tables, step):
        hashes = (labels[None, :] ^ seeds[a:a + step, None]) * seeds[a:a + step, None]
        hashes ^= hashes >> np.uint64(32)
        at = np.argpartition(hashes, picked - 1, axis=1)[:, :picked] if picked < len(labels) else np.tile(np.arange(len(labels)), (len(hashes), 1))
        at.sort(axis=1)
        value = seeds[a:a + step].copy()
        for i in range(picked):
            value = mixed(value + labels[at[:, i]])
        values[a:a + step] = value
    return values


def sketch(words: np.ndarray) -> np.ndarray:
    found = kmers(words)
    if len(found) < 2:  # similar texts of one k-mer are equal
        return np.empty(0, np.int64)
    labels = labelled(found)
    out = [picks(labels, SHORT_TABLES, SHORT_PICKED, 1)] if len(found) < SHORT else []
    out += [picks(labels, TABLES, PICKED, 2)] if len(found) >= LONG else []
    return np.concatenate(out).view(np.int64)


def text_key(text: str):
    """Tells the exact texts of equal document ids apart."""
    return F.coalesce(F.md5(F.col(text)), F.lit(""))


def sketches(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, uid (a row number), text_key, digest of the words (null: none), n (words),
    words (32-bit hashes) and sketch of every row."""

    def run(batches):
        memo = per_process("near words", lambda: BoundedMemo(word_hash, MEMO_ENTRIES)).__getitem__
        for b in batches:
            for a in range(0, b.num_rows, 1000):
                part = b.slice(a, 1000)
                hashes = [word_hashes(t, memo) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), part.column(3),
                    pa.array([hashlib.md5(h.tobytes()).digest() if len(h) else None for h in hashes], pa.binary()),
                    pa.array([len(h) for h in hashes], pa.int64()),
                    pa.array([h.astype(np.uint32).tobytes() for h in hashes], pa.binary()),
                    pa.array([sketch(h) for h in hashes], pa.list_(pa.int64())),
                ], ["doc_id", "uid", "text_key", "digest", "n", "words", "sketch"])

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("uid"), F.col(text).alias("text"), text_key(text).alias("text_key"))
    return rows.mapInArrow(run, SKETCH_SCHEMA)


# ---------------------------------------------------------------- alignment

def least_common(n: int, m: int) -> int:
    """The least L with L / (n + m - L) at the threshold or above."""
    a, b = SIMILARITY
    return -(-a * (n + m) // (a + b))


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Banded alignment of two word sequences."""
    need = least_common(len(x), len(y))
    if not len(x) or not len(y) or min(len(x), len(y)) < need:
        return False
    if common_bound(x, y) < need:
        return False
    skip, short = len(x) - need, min(len(x), len(y))
    differ = np.flatnonzero(x[:short] != y[:short])
    head = int(differ[0]) if len(differ) else short
    short -= head
    differ = np.flatnonzero(x[len(x) - short:][::-1] != y[len(y) - short:][::-1])
    tail = int(differ[0]) if len(differ) else short
    if head + tail >= need:
        return True
    x, y = x[head:len(x) - tail], y[head:len(y) - tail]
    need -= head + tail
    extra = len(y) - need  # words of either side that may stay unmatched
    row = np.zeros(len(y) + 1, np.int32)
    for i in range(len(x)):
        lo, hi = max(0, i - skip), min(len(y), i + extra + 1)
        if lo >= hi:
            break
        best = np.maximum(row[lo:hi] + (y[lo:hi] == x[i]), row[lo + 1:hi + 1])
        best[0] = max(best[0], row[lo])
        np.maximum.accumulate(best, out=row[lo + 1:hi + 1])
        if row[hi] >= need:
            return True
        if row[hi] + len(x) - 1 - i < need:
            return False
    return bool(row.max() >= need)


def common_bound(x: np.ndarray, y: np.ndarray) -> int:
    """Words in common whatever their order: no alignment has more."""
    u, nu = np.unique(x, return_counts=True)
    v, nv = np.unique(y, return_counts=True)
    _, i, j = np.intersect1d(u, v, assume_unique=True, return_indices=True)
    return int(np.minimum(nu[i], nv[j]).sum())


def hub_blocks(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs (hub a, member b) dealt into blocks of about UNIT_ROWS members of a
    hub, and the blocks (a, block) of every hub; hubs of one block need no count."""
    large = pairs.groupBy("a").agg(F.count("*").alias("k")).where(F.col("k") > UNIT_ROWS)
    large = materialize(large.select("a", F.ceil(F.col("k") / UNIT_ROWS).alias("blocks")), "near-hubs")  # few rows: one per UNIT_ROWS pairs at most
    n = F.coalesce("blocks", F.lit(1).cast("long"))
    dealt = pairs.join(large, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), n).alias("block"))
    hubs = pairs.select("a").distinct().join(large, "a", "left").select("a", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("block"))
    return dealt, hubs


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts (uid, words) are similar.  A hub's words are
    sent once for each block of its members, not to every member."""
    dealt, hubs = hub_blocks(materialize(pairs, "near-pairs"))
    members = dealt.join(texts.select(F.col("uid").alias("b"), F.col("words").alias("wb")), "b")
    heads = hubs.join(texts.select(F.col("uid").alias("a"), F.col("words").alias("wa")), "a")
    both = members.join(heads, ["a", "block"]).select("a", "b", "wa", "wb")

    def check(batches):
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            keep = [similar(np.frombuffer(a[i].as_py(), np.uint32), np.frombuffer(b[i].as_py(), np.uint32)) for i in range(batch.num_rows)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(check, "a long, b long")


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Number of common elements of each pair of sets, by products of slices of
    their incidence matrix (elements of one set only are left out)."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, element, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[element] > 1
    owner, element = owner[shared], element[shared]
    element = np.unique(element, return_inverse=True)[1]
    counts = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(element, kind="stable")
    owner, element = owner[order], element[order]
    for a in range(0, int(element[-1]) + 1 if len(element) else 0, SLICE):
        at, to = np.searchsorted(element, (a, a + SLICE))
        x = np.zeros((len(sets), min(SLICE, int(element[-1]) + 1 - a)), np.float32)
        x[owner[at:to], element[at:to] - a] = 1
        counts += x @ x.T
    return counts


def unit_links(bucket: int, i: int, j: int, rows: list[tuple]) -> list[tuple[int, int]]:
    """Links among the members of a unit, rows (block, uid, label, words, sketch),
    that join different components; a spanning set of them.  A pair that shares
    several buckets is compared in the first."""
    block = np.array([r[0] for r in rows])
    label = np.array([r[2] for r in rows])
    words = [np.frombuffer(r[3], np.uint32) for r in rows]
    n = np.array([len(w) for w in words])
    open_pairs = (label[:, None] != label[None, :]) & np.triu(np.ones((len(rows), len(rows)), bool), 1)
    if i != j:
        open_pairs &= block[:, None] != block[None, :]
    a, b = SIMILARITY
    open_pairs &= np.minimum.outer(n, n) * b >= np.maximum.outer(n, n) * a
    need = -(-a * np.add.outer(n, n) // (a + b))
    if open_pairs.any():
        open_pairs &= common_counts([labelled(w.astype(np.uint64)) for w in words]) >= need
    parent = {int(x): int(x) for x in label}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    links = []
    for x, y in zip(*map(np.ndarray.tolist, np.nonzero(open_pairs))):
        one, two = root(int(label[x])), root(int(label[y]))
        if one != two and first_common(rows[x][4], rows[y][4]) == bucket and similar(words[x], words[y]):
            parent[one] = two
            links.append((rows[x][1], rows[y][1]))
    return links


def first_common(one, two) -> int | None:
    other = set(two)
    return next((v for v in one if v in other), None)


def compared(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) among the members (bucket, uid, n, label) of open buckets."""
    stats = members.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("k"), F.sum("n").alias("s"))
    stats = stats.where("x <> y").select("bucket", F.ceil(F.greatest(F.col("k") / UNIT_ROWS, F.col("s") / UNIT_WORDS)).alias("blocks"))
    dealt = members.join(stats, "bucket").withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")))
    sent = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "uid", "label")
    units = sent.join(texts.select("uid", "words", "sketch"), "uid").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def run(batches):
        key, held, out = None, [], []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("bucket", "i", "j", "block", "uid", "label", "words", "sketch")]
            for bucket, i, j, *row in zip(*columns):
                if (bucket, i, j) != key:
                    out += unit_links(*key, held) if held else []
                    key, held = (bucket, i, j), []
                held.append(tuple(row))
        out += unit_links(*key, held) if held else []
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return units.select("bucket", "i", "j", "block", "uid", "label", "words", "sketch").mapInArrow(run, "a long, b long")


# ---------------------------------------------------------------- components

def components(edges: DataFrame) -> DataFrame:
    """(node, label) with the smallest node of its component, for linked nodes."""
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "near-links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "near-labels")
    while True:
        told = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("heard"))
        lower = labels.join(told, labels["node"] == told["a"]).select("node", F.col("label").alias("was"), F.least("label", "heard").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        after = materialize(lower.join(up, "label").select("node", "was", F.least("label", "above").alias("label")), "near-labels")
        if after.where("label <> was").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")


# ---------------------------------------------------------------- classes

def in_length(n: str, m: str):
    """Texts of n and m words can be similar."""
    a, b = SIMILARITY
    return F.least(n, m) * b >= F.greatest(n, m) * a


def links(rows: DataFrame, representatives: DataFrame) -> DataFrame:
    """Component of every representative (uid) that has a link: (node, label)."""
    distinct = rows.select("uid", "n", "sketch").join(representatives, "uid", "left_semi")
    members = materialize(distinct.select("uid", "n", F.explode("sketch").alias("bucket")), "near-buckets")
    hubs = members.groupBy("bucket").agg(F.min(F.struct("uid", "n")).alias("hub"), F.count("*").alias("size")).where("size > 1")
    shared = materialize(members.join(hubs, "bucket").select("bucket", "uid", "n", F.col("hub.uid").alias("hub"), F.col("hub.n").alias("hub_n")), "near-shared")
    # The words and sketches of texts that share a bucket, from here on the only ones in use.
    texts = materialize(rows.select("uid", "words", "sketch").join(shared.select("uid").distinct(), "uid", "left_semi"), "near-texts")
    pairs = shared.where((F.col("uid") != F.col("hub")) & in_length("n", "hub_n")).select(F.col("hub").alias("a"), F.col("uid").alias("b")).distinct()
    found = materialize(verified(pairs, texts), "near-found")
    labels = components(found).withColumnRenamed("node", "uid")
    members = shared.join(labels, "uid", "left").select("bucket", "uid", "n", F.coalesce("label", "uid").alias("label"))
    return components(found.union(materialize(compared(members, texts), "near-found")))


def classes(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, uid (a number of the row), text_key, class_id and class_uid (uid of
    the class's first document) of every row."""
    rows = materialize(sketches(documents, doc_id, text), "near-sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "uid"))
    same = materialize(rows.where("digest IS NOT NULL").groupBy("digest").agg(first.alias("first")), "near-same")
    representatives = same.select(F.col("first.uid").alias("uid"))
    labels = links(rows, representatives).withColumnRenamed("node", "uid")
    # One row per distinct text, then one per row of the input.
    labelled = same.select("digest", "first", F.col("first.uid").alias("uid")).join(labels, "uid", "left").withColumn("label", F.coalesce("label", "uid"))
    heads = labelled.groupBy("label").agg(F.min("first").alias("head"))
    by_digest = labelled.join(heads, "label").select("digest", "head")
    return rows.select("doc_id", "uid", "text_key", "digest").join(by_digest, "digest", "left").select(
        "doc_id", "uid", "text_key",
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.coalesce("head.uid", "uid").alias("class_uid"))


def one_of_each(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The first document (smallest id) of every class, with all its columns;
    of rows with that id and text, one."""
    kept_id, kept_key, own_key = unused(documents.columns, "_id", "_key", "_text_key")
    kept = materialize(classes(documents, doc_id, text).where("uid = class_uid").select(
        F.col("doc_id").alias(kept_id), F.col("text_key").alias(kept_key)).distinct(), "near-kept")
    keyed = documents.withColumn(own_key, text_key(text))
    same = F.col(doc_id).cast("long").eqNullSafe(F.col(kept_id)) & (F.col(own_key) == F.col(kept_key))
    return keyed.join(kept, same).dropDuplicates([kept_id, kept_key]).select(*documents.columns)
