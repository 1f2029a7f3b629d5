"""Exact top-k inner-product search by tiled matrix products.

Vectors are packed into tiles, which tasks append to files in the shared
folder; a narrow manifest says where each tile lies.  Queries form groups of
as many tiles as a task may hold, candidates form shards of tiles, and every
(group, shard) pair is one unit of work.  Only units, which name their tiles,
are shuffled: a unit reads its query tiles, then one candidate tile after the
other, multiplies, and keeps each query's k best (partial selection), so it
holds a query group, a tile and the lists.  The lists of a query are then
merged in a tree of fixed fan-in.

A candidate is read once per query group, from the file it was written to.
The number of groups follows the queries and the bytes a group may take; the
number of shards follows the candidates up to ``max_shards``, beyond which
shards grow instead, so there are at most ``max_shards * k`` list rows a query.

Scores are integers.  A product whose partial sums stay below 2^53 runs in
double precision, which is exact; below 2^63 in 64-bit integers; otherwise in
Python integers, saturated to the range of a long in the result.

Defined results: vectors that are null, or have a null or non-finite
component, or a null id take no part; only vectors of equal length meet; ties
go to the smaller id; rows with equal ids are different rows, of which each is
a candidate of the other and, as a query, has its own list; fewer candidates
than k give shorter lists; other columns are ignored.

A file bears its task attempt's name and the manifest is a written table, so a
lost or repeated attempt leaves at most an unused file.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from civicflow.llm.common import open_store, read_range, shared_uri
from civicflow.session import materialize, scratch_path

TILE_ROWS = 1024
#: Bytes of a group's query vectors in a task, as doubles.
GROUP_BYTES = 64 << 20
#: Least candidate tiles of a shard, and most shards of the candidates.
SHARD_TILES = 16
MAX_SHARDS = 1024
FAN_IN = 8
#: Tasks of the products; beyond it a task takes several units.
MAX_TASKS = 100_000
LONG = 2**63 - 1

TILE_SCHEMA = "dim int, is_query boolean, part int, serial long, name string, offset long, length long, n int, wide boolean"
LIST_SCHEMA = "uid long, query_id long, shard long, score long, vec_id long, cand_uid long"


class Tile(NamedTuple):
    """Vectors of one length as rows of a matrix, with their ids and row numbers."""
    ids: np.ndarray
    uids: np.ndarray
    matrix: np.ndarray


def quantise(values: np.ndarray) -> np.ndarray:
    """floor(256 x), x as double: floats that hold whole numbers."""
    return np.floor(256.0 * values)


def tiles(df: DataFrame, folder: str, vec_id: str, vector: str, query_every: int, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Manifest of the tiles written to ``folder``: candidate tiles of all valid
    rows, and query tiles of those whose id is divisible by ``query_every``.
    Rows of a tile are sorted by (id, row number); ``serial`` numbers the tiles
    of one length and kind within their task (``part``)."""

    def pack(batches):
        task = TaskContext.get()
        part, row, end, n_held = task.partitionId(), 0, 0, 0
        name = f"{part}-{task.taskAttemptId()}"
        held: dict[tuple, list] = {}
        serials: dict[tuple, int] = {}
        store, path = open_store(f"{folder}/{name}")
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)

        def flush(key, out):
            nonlocal end, n_held
            dim, is_query = key
            rows = sorted(held.pop(key), key=lambda r: (r[0], r[1]))
            n_held -= len(rows)
            matrix = np.array([r[2] for r in rows], np.float64).reshape(len(rows), dim)
            wide = bool(len(matrix) and np.abs(matrix).max(initial=0) >= 2**31)
            data = b"".join((np.array([r[0] for r in rows], "<i8").tobytes(), np.array([r[1] for r in rows], "<i8").tobytes(),
                             (matrix if wide else matrix.astype("<i4")).tobytes()))
            out.write(data)
            serial = serials[key] = serials.get(key, -1) + 1
            end += len(data)
            return (dim, is_query, part, serial, name, end - len(data), len(data), len(rows), wide)

        def record(found):
            kinds = (pa.int32(), pa.bool_(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_())
            names = [x.split()[0] for x in TILE_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(kinds)], names)

        with store.open_output_stream(path, compression=None) as out:
            for b in batches:
                ids, vectors = b.column(0).to_pylist(), b.column(1)
                flat = vectors.flatten()
                values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
                lengths = np.array([0 if v is None else v for v in vectors.value_lengths().to_pylist()])
                ends = np.cumsum(lengths)
                valid = np.asarray(vectors.is_valid())
                full = []
                for i, vid in enumerate(ids):
                    uid = (part << 32) + row
                    row += 1
                    x = values[ends[i] - lengths[i]:ends[i]]
                    if vid is None or not valid[i] or not np.isfinite(x).all() or not np.isfinite(x * 256.0).all():
                        continue
                    for is_query in (False, True) if vid % query_every == 0 else (False,):
                        key = (int(lengths[i]), is_query)
                        held.setdefault(key, []).append((vid, uid, quantise(x)))
                        n_held += 1
                        if len(held[key]) >= tile_rows:
                            full.append(flush(key, out))
                    if n_held >= 8 * tile_rows:  # vectors of many lengths
                        full += [flush(key, out) for key in list(held)]
                if full:
                    yield record(full)
            last = [flush(key, out) for key in list(held)]
        if last:
            yield record(last)

    return df.select(F.col(vec_id).cast("long"), F.col(vector).cast("array<double>")).mapInArrow(pack, TILE_SCHEMA)


def read_tile(folder: str, dim: int, ref: dict) -> Tile:
    data, n = read_range(f"{folder}/{ref['name']}", ref["offset"], ref["length"]), ref["n"]
    matrix = np.frombuffer(data, "<f8" if ref["wide"] else "<i4", offset=16 * n).astype(np.float64).reshape(n, dim)
    return Tile(np.frombuffer(data, "<i8", n), np.frombuffer(data, "<i8", n, 8 * n), matrix)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of whole numbers, exactly."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < 2**53:
        return a @ b.T
    if top < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = [[int(x) for x in r] for r in a], [[int(x) for x in r] for r in b]
    out = np.empty((len(a), len(b)), object)
    for i, x in enumerate(whole[0]):
        for j, y in enumerate(whole[1]):
            out[i, j] = sum(p * q for p, q in zip(x, y))
    return out


def select_best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the columns of the k highest scores, first column first among
    equals, and which of these are real (-inf marks what takes no part)."""
    left, best, real, rows = scores.copy(), [], [], np.arange(len(scores))
    for _ in range(min(k, scores.shape[1])):
        at = left.argmax(axis=1)
        best.append(at)
        real.append(left[rows, at] != -np.inf)  # else nothing is left, and ``at`` is any column
        left[rows, at] = -np.inf
    if not best:
        return np.empty((len(scores), 0), np.int64), np.empty((len(scores), 0), bool)
    return np.stack(best, axis=1), np.stack(real, axis=1)


def best_of_tile(q: Tile, c: Tile, k: int) -> tuple[np.ndarray, ...]:
    """Per query the k best of one candidate tile: found, score, id and row number,
    arrays of a row per query."""
    exact = product(q.matrix, c.matrix)
    if exact.dtype == object:
        order = {v: i for i, v in enumerate(sorted(set(exact.ravel())))}
        scores = np.array([[order[v] for v in r] for r in exact], np.float64).reshape(exact.shape)
    elif exact.dtype == np.int64:  # rank whole numbers that doubles can't tell apart
        scores = np.unique(exact, return_inverse=True)[1].reshape(exact.shape).astype(np.float64)
    else:
        scores = exact.copy()
    scores[q.uids[:, None] == c.uids[None, :]] = -np.inf
    cols, real = select_best(scores, k)
    values = np.take_along_axis(exact, cols, axis=1)
    if values.dtype == object:
        values = np.clip(values, -LONG - 1, LONG)
    return real, values.astype(np.int64), c.ids[cols], c.uids[cols]


def merged_lists(held: tuple, more: tuple, k: int) -> tuple[np.ndarray, ...]:
    """The k best of two sets of lists, row by row."""
    both = [np.concatenate(x, axis=1) for x in zip(held, more)]
    real, score, ids, uids = both
    order = np.lexsort((uids, ids, ~score, ~real), axis=1)[:, :k]  # ~score falls as the score grows, and never overflows
    return tuple(np.take_along_axis(x, order, axis=1) for x in both)


def search_unit(queries: list[Tile], candidates, k: int):
    """Best k of all ``candidates`` (an iterator of tiles) for every query: per
    query tile its uid, query_id, score, vec_id and cand_uid columns."""
    lists: list = [None] * len(queries)
    for c in candidates:
        for i, q in enumerate(queries):
            found = best_of_tile(q, c, k)
            lists[i] = found if lists[i] is None else merged_lists(lists[i], found, k)
    for q, found in zip(queries, lists):
        if found is not None:
            real, score, ids, uids = found
            at, rank = np.nonzero(real)
            yield q.uids[at], q.ids[at], score[at, rank], ids[at, rank], uids[at, rank]


def units(manifest: DataFrame, tile_rows: int = TILE_ROWS, query_tiles: int | None = None, shard_tiles: int = SHARD_TILES,
          max_shards: int = MAX_SHARDS) -> DataFrame:
    """dim, grp, shard with the places of the query tiles (q) and candidate tiles (c)."""
    kind = ["dim", "is_query"]
    parts = manifest.groupBy(*kind, "part").agg(F.count("*").alias("k"))  # one row per length, kind and task
    before = W.partitionBy(*kind).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(*kind, "part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("base"))
    numbered = manifest.join(parts, [*kind, "part"]).withColumn("number", F.col("base") + F.col("serial"))
    in_group = F.lit(query_tiles) if query_tiles else F.greatest(F.lit(1), F.floor(F.lit(GROUP_BYTES) / (8 * tile_rows * F.greatest("dim", F.lit(1)))))
    layout = manifest.groupBy("dim").agg(F.count_if("is_query").alias("n_q"), F.count_if(~F.col("is_query")).alias("n_c"))  # one row per length
    layout = layout.where("n_q > 0").select(
        "dim", "n_q", "n_c", in_group.cast("long").alias("in_group"), F.greatest(F.lit(shard_tiles), F.ceil(F.col("n_c") / max_shards)).cast("long").alias("in_shard"))
    ref = F.struct("name", "offset", "length", "n", "wide")

    def listed(tiles_of_kind: DataFrame, size: str, part: str, name: str) -> DataFrame:
        """One row per group or shard, with the places of its tiles."""
        return tiles_of_kind.join(layout, "dim").groupBy("dim", F.floor(F.col("number") / F.col(size)).alias(part)).agg(F.collect_list(ref).alias(name))

    def upto(n: str, size: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / F.col(size))))

    pairs = layout.withColumn("grp", upto("n_q", "in_group")).withColumn("shard", upto("n_c", "in_shard")).select("dim", "grp", "shard")
    groups = listed(numbered.where("is_query"), "in_group", "grp", "q")
    shards = listed(numbered.where("NOT is_query"), "in_shard", "shard", "c")
    return pairs.join(groups, ["dim", "grp"]).join(shards, ["dim", "shard"])


def shard_lists(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", query_every: int = 50, k: int = 5,
                tile_rows: int = TILE_ROWS, query_tiles: int | None = None, shard_tiles: int = SHARD_TILES, max_shards: int = MAX_SHARDS) -> DataFrame:
    """The k best of every query in every shard of the candidates, as a written table."""
    spark = df.sparkSession
    folder = shared_uri(spark, scratch_path(spark, "tile-files"))
    manifest = materialize(tiles(df, folder, vec_id, vector, query_every, tile_rows), "tiles")
    work = materialize(units(manifest, tile_rows, query_tiles, shard_tiles, max_shards), "units")

    def run(batches):
        names = [x.split()[0] for x in LIST_SCHEMA.split(", ")]
        for b in batches:
            for i in range(b.num_rows):
                dim, shard, q, c = (b.column(x)[i].as_py() for x in ("dim", "shard", "q", "c"))
                queries = [read_tile(folder, dim, ref) for ref in q]
                for uid, qid, score, vid, cand in search_unit(queries, (read_tile(folder, dim, ref) for ref in c), k):
                    columns = (uid, qid, np.full(len(uid), shard), score, vid, cand)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names)

    # A given number of tasks: by their few bytes all units would be put into one.
    n_tasks = max(1, min(MAX_TASKS, work.count()))
    return materialize(work.repartition(n_tasks).mapInArrow(run, LIST_SCHEMA), "top-lists")


def search(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", query_every: int = 50, k: int = 5, tile_rows: int = TILE_ROWS,
           query_tiles: int | None = None, shard_tiles: int = SHARD_TILES, max_shards: int = MAX_SHARDS, fan_in: int = FAN_IN) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of each query."""
    lists = shard_lists(df, vec_id, vector, query_every, k, tile_rows, query_tiles, shard_tiles, max_shards)
    n_shards = lists.agg(F.max("shard")).first()[0]
    best = [F.desc("score"), "vec_id", "cand_uid"]
    left = 0 if n_shards is None else n_shards + 1
    while left > 1:  # tree merge: the lists of fan_in neighbouring shards become one
        lists = lists.withColumn("shard", F.floor(F.col("shard") / fan_in))
        lists = lists.withColumn("r", F.row_number().over(W.partitionBy("uid", "shard").orderBy(*best))).where(F.col("r") <= k).drop("r")
        left = -(-left // fan_in)
    return lists.select("query_id", F.row_number().over(W.partitionBy("uid").orderBy(*best)).cast("int").alias("rank"), "vec_id", "score")
