"""Sharding by sampled splitters: shards of near equal bytes.

Rows are ordered by (hash of the group, document id, row number), so equal
texts stand together and a group is only cut where a shard ends.

1. A size-weighted sample of the keys is drawn: a row is in it with
   probability size * m / total.  Its expected number of rows is at most
   ``m`` (``ranges_per_shard * n_shards * SAMPLES_PER_RANGE``), however large
   the data, so the driver may hold it.
2. Quantiles of the sample are the splitters of ranges of near equal bytes.
3. Ranges that still hold too much (a hot key, or bad luck) are subdivided
   by further splitters on the full key.
4. Within each range running sums are exact; with the totals of the ranges
   before it every row knows the bytes before it, and its shard is the one in
   which its middle byte falls.  Shards differ by the size of a row at most.

Built-in column functions only; each task sorts one range of narrow rows, and
the texts take no part.  The row number is fixed in a written table.

Defined results: a null text has no bytes and counts its 8 bytes of overhead;
rows with null or equal ids are placed one by one; repeated rows are different
rows; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from civicflow.session import materialize

SAMPLES_PER_RANGE = 32
OVERFULL = 1.5
LEAST_LONG = -(2**63)

KEY = ("_group", "_id", "_row")


def _sampled(rows: DataFrame, rate: float, seed: int) -> DataFrame:
    """Rows drawn with probability size * rate; ``_weight`` is what each stands for."""
    u = F.xxhash64(F.lit(seed), "_group", "_row").bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52)
    return rows.where(u < F.col("_size") * rate).withColumn("_weight", F.greatest(F.col("_size"), F.lit(1.0 / rate)))


def _quantiles(sample: list[tuple], n: int) -> list:
    """n - 1 keys that cut (key, weight), sorted by key, into parts of near equal weight."""
    total, run, cuts = sum(w for _, w in sample), 0.0, []
    for key, weight in sample:
        run += weight
        while len(cuts) < n - 1 and run >= total * (len(cuts) + 1) / n:
            cuts.append(key)
    return sorted(set(cuts))


def _index(key: Column, cuts: list[int], base: int = 0) -> Column:
    """Number of cuts at or below ``key``, by a balanced tree of comparisons."""
    if not cuts:
        return F.lit(base)
    mid = len(cuts) // 2
    return F.when(key < F.lit(cuts[mid]), _index(key, cuts[:mid], base)).otherwise(_index(key, cuts[mid + 1:], base + mid + 1))


def place(rows: DataFrame, n_shards: int, size: str, group: str, row_id: str, ranges_per_shard: int = 8, seed: int = 7) -> DataFrame:
    """``rows`` (narrow: what it has is carried along) with ``shard`` and ``slot``.

    ``size``: a positive long; ``group``: rows of equal value stand together.
    """
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    keyed = rows.select(
        *names,
        F.col(size).alias("_size"), F.xxhash64(group).alias("_group"),
        F.coalesce(F.col(row_id).cast("long"), F.lit(LEAST_LONG)).alias("_id"), F.monotonically_increasing_id().alias("_row"),
    )
    fixed = materialize(keyed, "shard-rows")
    total, = fixed.agg(F.sum("_size")).first()
    if not total:
        return fixed.select(*names, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")).limit(0)
    n_ranges = ranges_per_shard * n_shards

    rate = n_ranges * SAMPLES_PER_RANGE / total
    sample = sorted((r[0], r[1]) for r in _sampled(fixed, rate, seed).select("_group", "_weight").collect())
    ranged = fixed.withColumn("_range", _index(F.col("_group"), _quantiles(sample, n_ranges)))

    # One row per range; those with too much are subdivided by the full key.
    mean = total / n_ranges
    overfull = ranged.groupBy("_range").agg(F.sum("_size").alias("n")).where(F.col("n") > OVERFULL * mean).collect()
    sub = F.lit(0)
    if overfull:
        parts = {r["_range"]: -(-int(r["n"]) // int(mean + 1)) for r in overfull}
        drawn: dict[int, list] = {}
        for r in _sampled(ranged.where(F.col("_range").isin(list(parts))), rate, seed + 1).select("_range", *KEY, "_weight").collect():
            drawn.setdefault(r["_range"], []).append(((r["_group"], r["_id"], r["_row"]), r["_weight"]))
        key = F.struct(*KEY)
        for number, found in drawn.items():
            cuts = F.array(*[F.struct(*[F.lit(x).cast("long").alias(c) for x, c in zip(cut, KEY)]) for cut in _quantiles(sorted(found), parts[number])])
            sub = F.when(F.col("_range") == number, F.size(F.filter(cuts, lambda c: c <= key))).otherwise(sub)
    ranged = ranged.withColumn("_sub", sub)

    totals = ranged.groupBy("_range", "_sub").agg(F.sum("_size").alias("n"), F.count("*").alias("k"))  # one row per range
    before = W.orderBy("_range", "_sub").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select(
        "_range", "_sub", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_bytes_before"), F.coalesce(F.sum("k").over(before), F.lit(0)).alias("_rows_before"))
    inside = W.partitionBy("_range", "_sub").orderBy(*KEY)
    running = inside.rowsBetween(W.unboundedPreceding, -1)
    counted = ranged.select(
        "*", F.coalesce(F.sum("_size").over(running), F.lit(0)).alias("_sum"), F.row_number().over(inside).alias("_n"))
    middle = 2 * (F.col("_bytes_before") + F.col("_sum")) + F.col("_size")
    placed = counted.join(F.broadcast(bases), ["_range", "_sub"]).select(
        *names,
        F.least(F.lit(n_shards - 1), F.floor(middle.cast("decimal(38,0)") * n_shards / F.lit(2 * total).cast("decimal(20,0)"))).cast("int").alias("shard"),
        (F.col("_rows_before") + F.col("_n")).alias("_at"),
    )
    first = placed.groupBy("shard").agg(F.min("_at").alias("_first"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(*names, "shard", (F.col("_at") - F.col("_first")).cast("long").alias("slot"))


def shard_documents(documents: DataFrame, n_shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = documents.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))
    placed = place(narrow, n_shards, "size", "text_hash", "doc_id")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
