"""Ranked lexical search by presence-mask grouping.

Terms are runs of ASCII letters and digits and of all other than ASCII
characters, A-Z in lower case.  The score of a document for a query is a sum
of whole numbers over the query's terms: weight of the term (rare terms weigh
more) times its saturated count in the document (long documents count less).

Method.  One pass counts the query terms of every document into a narrow
written table; corpus size, length and document frequencies come from it.  In
the second pass each block of documents is searched for every query: bit
operations give each document the mask of the query's terms it holds, equal
masks form a group, and a group's highest possible score is the sum of its
terms' greatest shares in the block.  Groups are scored in descending order of
that bound until the bound is below the score of the k-th best document found
by the task so far; the rest of the block can't enter the list.  The lists of
the tasks are merged in two steps, k rows of a task and query each.

Work.  No pairs leave a task but the best k of a query.  The queries are taken
in blocks of at most ``BLOCK_TERMS`` different terms, each one pass over the
documents; what is sent to the tasks is a block's terms and weights, whatever
the number of documents or queries.  Rows are not shuffled before the merge.

Defined results: null texts, texts without a term and empty tables give no
rows and count nowhere; every query row is a query of its own (queries of one
id give their lists one after the other, ranks from 1 each); a repeated
document takes a rank for every row; a null doc_id comes last among equal
scores; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from civicflow.session import materialize

BEST = 20
#: Different terms, and queries, of a block of queries.
BLOCK_TERMS, BLOCK_QUERIES = 200_000, 5_000
#: Documents searched at a time, and scored before the bound is looked at again.
BLOCK_DOCS, FIRST_SCORED = 4096, 64
#: Fixed values of the score: 0.75 + 0.25 of the relative length, in percent.
SHORT, SLOPE, SCALE = 75, 25, 1_000_000_000
BETWEEN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

COUNTED = "uid long, doc_id long, n long, terms binary, times binary"
LISTS = "query int, score long, doc_id long, uid long"


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8 (the lower case of bytes is that of A-Z)."""
    return (text or b"").lower().translate(BETWEEN).split()


def query_blocks(items: DataFrame, item_id: str, text: str):
    """The queries, in blocks of bounded size: lists of (item_id, {term: times})."""
    block, seen = [], set()
    for row in items.select(item_id, F.col(text).cast("binary")).toLocalIterator():
        found = Counter(terms(bytes(row[1]) if row[1] is not None else None))
        if block and (len(seen | found.keys()) > BLOCK_TERMS or len(block) >= BLOCK_QUERIES):
            yield block
            block, seen = [], set()
        block.append((row[0], found))
        seen |= found.keys()
    if block:
        yield block


def counted(documents: DataFrame, vocabulary: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """Rows of documents with a term: number of terms, and the numbers of the
    vocabulary's terms they hold (ascending) with their counts."""

    def run(batches):
        number = vocabulary.get
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sizes, held, times = [], [], []
                for t in part.column(2).to_pylist():
                    words = terms(t)
                    known = np.fromiter(filter(None, map(number, words)), np.int32)  # numbers from 1
                    known, often = np.unique(known, return_counts=True)
                    sizes.append(len(words))
                    held.append(known.tobytes())
                    times.append(often.astype(np.int32).tobytes())
                out = pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(held, pa.binary()), pa.array(times, pa.binary())],
                                                 ["uid", "doc_id", "n", "terms", "times"])
                yield out.filter(pa.array([n > 0 for n in sizes], pa.bool_()))

    rows = documents.select(F.monotonically_increasing_id().alias("uid"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, COUNTED)


def document_frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary (one number per term is collected)."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["term", "df"])

    out = np.zeros(size, np.int64)
    for term, df in rows.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df")).collect():
        out[term] = df
    return out


class Best:
    """The k best rows of one query so far, best first."""

    def __init__(self, k: int):
        self.k, self.rows = k, np.empty((4, 0), np.int64)  # score, id is null, id, uid

    def floor(self) -> int:
        """A document needs at least this score to enter."""
        return int(self.rows[0, -1]) if self.rows.shape[1] == self.k else 1

    def add(self, rows: np.ndarray) -> None:
        both = np.concatenate([self.rows, rows[:, rows[0] >= self.floor()]], axis=1)
        order = np.lexsort((both[3], both[2], both[1], -both[0]))[:self.k]
        self.rows = both[:, order]


class Block:
    """Counted documents, entries by document and by term."""

    def __init__(self, uid, doc_id, no_id, n, held, times, docs: int, length: int):
        self.uid, self.doc_id, self.no_id = uid, doc_id, no_id
        self.term = np.frombuffer(b"".join(held), np.int32)
        often = np.frombuffer(b"".join(times), np.int32).astype(np.int64)
        sizes = np.array([len(h) // 4 for h in held], np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.doc = np.repeat(np.arange(len(held)), sizes)
        m = SHORT + SLOPE * n * docs // length
        #: Share of an entry: its saturated count, before the weight.
        self.share = SCALE * often // (1000 * often + 12 * m[self.doc])
        order = np.argsort(self.term, kind="stable")
        self.names, starts = np.unique(self.term[order], return_index=True)
        self.docs_of = dict(zip(self.names.tolist(), np.split(self.doc[order], starts[1:])))
        self.top_of = dict(zip(self.names.tolist(), np.maximum.reduceat(self.share[order], starts).tolist() if len(starts) else []))

    def masks(self, held: list[int]) -> np.ndarray:
        """Per document the presence bits of the terms ``held``, 64 a word: one column a document."""
        out = np.zeros((len(held) // 64 + 1, len(self.uid)), np.uint64)
        for j, t in enumerate(held):
            out[j >> 6, self.docs_of[t]] |= np.uint64(1 << (j & 63))
        return out

    def search(self, weights: dict[int, int], best: Best, dense: np.ndarray) -> None:
        """Enter the documents of the block into ``best``; ``dense`` is a zero per term."""
        held = [t for t in weights if t in self.docs_of]
        if not held:
            return
        masks = self.masks(held)
        if len(masks) == 1:
            distinct, group = np.unique(masks[0], return_inverse=True)
            distinct = distinct[None, :]
        else:
            distinct, group = np.unique(masks, axis=1, return_inverse=True)
        bound = np.zeros(distinct.shape[1], np.int64)
        for j, t in enumerate(held):
            present = (distinct[j >> 6] >> np.uint64(j & 63)) & np.uint64(1)
            bound += present.astype(np.int64) * (weights[t] * self.top_of[t])
        by_bound = np.argsort(-bound, kind="stable")
        place = np.empty_like(by_bound)
        place[by_bound] = np.arange(len(by_bound))
        rank = place[group.ravel()]
        docs = np.argsort(rank, kind="stable")  # documents, group by group
        ends = np.cumsum(np.bincount(rank, minlength=len(by_bound)))
        dense[list(weights)] = list(weights.values())
        at, next_group, step = 0, 0, FIRST_SCORED
        while next_group < len(by_bound) and bound[by_bound[next_group]] >= best.floor():
            next_group = max(next_group + 1, int(np.searchsorted(ends, at + step, "right")))  # whole groups, about ``step`` documents
            some, at, step = docs[at:ends[next_group - 1]], int(ends[next_group - 1]), step * 2
            best.add(np.stack([self.scores(some, dense), self.no_id[some], self.doc_id[some], self.uid[some]]))
        dense[list(weights)] = 0

    def scores(self, docs: np.ndarray, dense: np.ndarray) -> np.ndarray:
        first, sizes = self.first[docs], self.first[docs + 1] - self.first[docs]
        ends = np.cumsum(sizes)
        entries = np.arange(ends[-1]) + np.repeat(first - (ends - sizes), sizes)
        sums = np.concatenate([[0], np.cumsum(dense[self.term[entries]] * self.share[entries])])
        return sums[ends] - sums[ends - sizes]


def best_lists(rows: DataFrame, weights: list[dict[int, int]], size: int, docs: int, length: int, k: int) -> DataFrame:
    """The best k documents of every task and query."""

    def run(batches):
        best, dense = {}, np.zeros(size, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_DOCS):
                part = batch.slice(at, BLOCK_DOCS)
                ids = part.column(1)
                block = Block(
                    part.column(0).to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64),
                    part.column(2).to_numpy(zero_copy_only=False), part.column(3).to_pylist(), part.column(4).to_pylist(), docs, length)
                for q, w in enumerate(weights):
                    block.search(w, best.setdefault(q, Best(k)), dense)
        for q, found in best.items():
            score, no_id, doc_id, uid = found.rows
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), q, np.int32)), pa.array(score), pa.array(doc_id, mask=no_id == 1), pa.array(uid)], ["query", "score", "doc_id", "uid"])

    return rows.select("uid", "doc_id", "n", "terms", "times").mapInArrow(run, LISTS)


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def search_block(spark: SparkSession, documents: DataFrame, queries: list, doc_id: str, text: str, k: int) -> DataFrame | None:
    names = {t: i for i, t in enumerate(sorted(set().union(*(found for _, found in queries))), 1)}
    if not names:
        return None
    rows = materialize(counted(documents, names, doc_id, text), "lexical-counts")
    docs, length = rows.agg(F.count("*"), F.sum("n")).first()
    if not docs:
        return None
    dfs = document_frequencies(rows, len(names) + 1)
    weights = [{names[t]: times * weight(docs, int(dfs[names[t]])) for t, times in found.items() if dfs[names[t]]} for _, found in queries]
    weights = [{t: w for t, w in found.items() if w} for found in weights]
    lists = best_lists(rows, weights, len(names) + 1, docs, length, k).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), "uid"]
    for keys in (["query", "part"], ["query"]):  # lists of tasks, then of parts
        lists = lists.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return lists


def search(documents: DataFrame, items: DataFrame, item_id: str = "item_id", item_text: str = "text", doc_id: str = "doc_id", text: str = "text", k: int = BEST) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the k best documents of every item."""
    spark, out = documents.sparkSession, None
    id_type = items.schema[item_id].dataType
    for queries in query_blocks(items, item_id, item_text):
        lists = search_block(spark, documents, queries, doc_id, text, k)
        if lists is None:
            continue
        table = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(queries)], "query int, item_id " + id_type.simpleString())
        found = lists.join(table, "query").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "item_id " + id_type.simpleString() + ", rank int, doc_id long, score long")
    return out
