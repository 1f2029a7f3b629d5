"""Chains of deadlines, split exactly over time.

A row of a group that starts a watch holds it until its deadline; the next
watch starts at the first row of the group after that deadline, and so on.
Read row by row this is a sequential scan of the whole group.  But the next
start depends on the current one only, so the rows form a graph with one edge a
row, and the wanted starts are the path from the group's first row.  The path
is found in blocks:

1. a group's rows are cut into blocks of ``BLOCK_REACHES`` times the longest
   reach (deadline minus position) of any row.  A chain that comes from an
   earlier block can enter a block only within one reach of its beginning: for
   each such entry row a task lists the starts inside the block and the deadline
   with which the chain leaves it;
2. an exit is linked to the first entry row after its deadline, which lies in
   the block of the deadline or is the first row of the next one that has rows;
3. the links of a group are composed by pointer doubling, and the entries
   reached from the group's first row are marked: about log2(blocks) joins of
   narrow tables, and none if every group lies in one block;
4. the starts of the marked entries are the result.

So one group that spans the whole input runs over as many tasks as it has
blocks.  Only the table of a group's blocks (a row each) is ordered as a whole.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.operators.sequence import floor_div
from civicflow.session import materialize

#: Length of a block, in longest reaches.
BLOCK_REACHES = 16
NEVER = 2**62  # deadline of a watch that no row can outlive

START = T.StructType([T.StructField(c, T.LongType()) for c in ("at", "seq", "due", "mark")])


def _entry_schema(keys: list[T.StructField]) -> T.StructType:
    longs = ["block", "e_at", "e_seq", "exit_due", "tail_at", "tail_seq", "tail_next"]
    return T.StructType([*keys, *[T.StructField(c, T.LongType()) for c in longs], T.StructField("starts", T.ArrayType(START))])


def block_entries(at, seq, due, mark, last_entry: int) -> list[tuple]:
    """(at, seq, exit_due, starts) of the rows through which a chain may enter a
    block: the first one, and those behind a row before ``last_entry``."""
    after = np.searchsorted(at, due, side="right")  # first row behind each deadline
    n, out = len(at), []
    for i in range(min(int(np.searchsorted(at, last_entry, side="left")) + 1, n)):
        starts, j = [], i
        while j < n:
            last = j
            starts.append((int(at[j]), int(seq[j]), int(due[j]), int(mark[j])))
            j = int(after[j])
        out.append((int(at[i]), int(seq[i]), int(due[last]), starts))
    return out


def _scan(keys: list[str], reach: int, block: int):
    columns = [*keys, "block", "e_at", "e_seq", "exit_due", "tail_at", "tail_seq", "tail_next", "starts"]

    def close(key, parts) -> list[tuple]:
        at, seq, due, mark, next_at = (np.concatenate(x) for x in zip(*parts))
        tail = (int(at[-1]), int(seq[-1]), int(next_at[-1]))
        found = block_entries(at, seq, due, mark, key[-1] * block + reach)
        return [(*key, a, s, d, *tail, starts) for a, s, d, starts in found]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, out = None, [], []
        for pdf in batches:
            if not len(pdf):
                continue
            ids = [pdf[c].to_numpy() for c in (*keys, "block")]
            values = [pdf[c].to_numpy(np.int64) for c in ("at", "seq", "due", "mark", "next_at")]
            changed = np.any([x[1:] != x[:-1] for x in ids], axis=0)
            bounds = [0, *np.flatnonzero(changed) + 1, len(pdf)]
            for a, b in zip(bounds, bounds[1:]):
                own = tuple(x[a] for x in ids)
                if own != key:
                    out += close(key, held) if held else []
                    key, held = own, []
                held.append([x[a:b] for x in values])
            if len(out) > 5_000:
                yield pd.DataFrame(out, columns=columns)
                out = []
        out += close(key, held) if held else []
        yield pd.DataFrame(out, columns=columns)

    return run


def _next_entries(entries: DataFrame, keys: list[str], block: int) -> DataFrame:
    """The entries with (n_at, n_seq), the entry their chain goes on to (null: none)."""
    asked = entries.where(F.col("exit_due") < NEVER).select(*keys, F.col("exit_due").alias("at")).distinct()
    place = F.struct(F.col("e_at").alias("at"), F.col("e_seq").alias("seq"))
    both = entries.select(*keys, F.col("e_at").alias("at"), F.col("e_seq").alias("seq"), place.alias("entry")).unionByName(
        asked.select(*keys, "at", F.lit(None).cast("long").alias("seq"), F.lit(None).cast("struct<at:bigint,seq:bigint>").alias("entry")))
    both = both.withColumn("block", floor_div(F.col("at"), block))
    # Going down in time, the last entry seen before a deadline is the first one after it.
    down = Window.partitionBy(*keys, "block").orderBy(F.desc("at"), F.col("entry").isNotNull(), F.desc("seq"))
    inside = both.withColumn("found", F.last("entry", ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, 0)))
    blocks = both.groupBy(*keys, "block").agg(F.min("entry").alias("first"))
    later = Window.partitionBy(*keys).orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*keys, "block", F.last("first", ignorenulls=True).over(later).alias("next_first"))
    found = inside.where("entry IS NULL").join(blocks, [*keys, "block"]).select(
        *keys, F.col("at").alias("exit_due"), F.coalesce("found", "next_first").alias("_n"))
    return entries.join(found, [*keys, "exit_due"], "left").withColumns({"n_at": F.col("_n.at"), "n_seq": F.col("_n.seq")}).drop("_n")


def _reached(links: DataFrame, heads: DataFrame, keys: list[str], most_blocks: int) -> DataFrame:
    """The entries (keys, at, seq) on the chains from ``heads``, by pointer doubling
    over ``links`` (keys, at, seq, n_at, n_seq)."""
    node, hops, steps = [*keys, "at", "seq"], [links], 1
    while 2 * steps < most_blocks:
        ahead = hops[-1].select(*keys, F.col("at").alias("n_at"), F.col("seq").alias("n_seq"), F.col("n_at").alias("nn_at"), F.col("n_seq").alias("nn_seq"))
        double = hops[-1].join(ahead, [*keys, "n_at", "n_seq"]).select(*node, F.col("nn_at").alias("n_at"), F.col("nn_seq").alias("n_seq"))
        hops.append(materialize(double, "chain-hops"))
        steps *= 2
    marked = heads
    for hop in reversed(hops):
        reached = marked.join(hop, node).select(*keys, F.col("n_at").alias("at"), F.col("n_seq").alias("seq"))
        marked = materialize(marked.unionByName(reached), "chain-marks")
    return marked


def chain_starts(rows: DataFrame, keys: list[str], reach: int | None = None) -> DataFrame:
    """The watch starts of every group.

    ``rows``: ``keys``, the position ``at`` and ``seq`` that order a group, the
    position ``due`` up to which a watch started there lasts (``NEVER``: to the
    end; at least ``at``, and at most ``reach`` more, which is looked up if it is
    not given), a number ``mark`` carried along, and ``next_at``, the
    position of the observation after the row.  Result: keys, at, seq, due, mark
    of the starts, ``last`` (no start follows in the group) and ``tail_next``, the
    ``next_at`` of the group's last row.
    """
    if reach is None:
        reach = rows.where(F.col("due") < NEVER).agg(F.max(F.col("due") - F.col("at"))).first()[0]
    reach = max(int(reach or 0), 1)
    block = BLOCK_REACHES * reach
    schema = _entry_schema([rows.schema[k] for k in keys])
    placed = rows.withColumn("block", floor_div(F.col("at"), block))
    ordered = placed.repartition(*keys, "block").sortWithinPartitions(*keys, "block", "at", "seq")
    entries = materialize(ordered.select(*keys, "block", "at", "seq", "due", "mark", "next_at").mapInPandas(_scan(keys, reach, block), schema), "chain-entries")
    groups = entries.groupBy(*keys).agg(
        F.min(F.struct("e_at", "e_seq")).alias("head"), F.max(F.struct("tail_at", "tail_seq", "tail_next")).alias("tail"),
        F.count_distinct("block").alias("blocks"))
    groups = materialize(groups, "chain-groups")
    tail = groups.select(*keys, F.col("tail.tail_next").alias("tail_next"), F.col("head.e_at").alias("h_at"), F.col("head.e_seq").alias("h_seq"))
    most = groups.agg(F.max("blocks")).first()[0] or 0
    is_head = (F.col("e_at") == F.col("h_at")) & (F.col("e_seq") == F.col("h_seq"))
    short = groups.where("blocks = 1").select(*keys)
    marked = entries.join(short, keys, "left_semi").drop("tail_next").join(tail, keys).where(is_head).withColumn("ends", F.lit(True))
    if most > 1:
        long = materialize(_next_entries(entries.join(groups.where("blocks > 1").select(*keys), keys, "left_semi").drop("tail_next"), keys, block), "chain-links")
        links = long.where("n_at IS NOT NULL").select(*keys, F.col("e_at").alias("at"), F.col("e_seq").alias("seq"), "n_at", "n_seq")
        heads = groups.where("blocks > 1").select(*keys, F.col("head.e_at").alias("at"), F.col("head.e_seq").alias("seq"))
        path = _reached(links, heads, keys, most).withColumnsRenamed({"at": "e_at", "seq": "e_seq"})
        on_path = long.join(path, [*keys, "e_at", "e_seq"], "left_semi").join(tail, keys).withColumn("ends", F.col("n_at").isNull())
        marked = marked.select(*keys, "starts", "tail_next", "ends").unionByName(on_path.select(*keys, "starts", "tail_next", "ends"))
    listed = marked.select(*keys, "tail_next", "ends", F.size("starts").alias("_n"), F.posexplode("starts").alias("_i", "_s"))
    return listed.select(*keys, "_s.at", "_s.seq", "_s.due", "_s.mark", (F.col("ends") & (F.col("_i") == F.col("_n") - 1)).alias("last"), "tail_next")
