"""Keyed process functions: a user's logic over rows and timers of a key.

A ``KeyedProcess`` has state (one typed record per key), ``on_row`` and
``on_timer``.  The same object runs over a stream (``process_stream``, with
``transformWithState``) and over a table (``process_batch``, a scan of sorted
partitions with a timer heap):

* the rows of a key come in (event time, arrival) order;
* a timer set for ``T`` runs after the rows up to ``T`` and before all later
  ones; setting it twice is setting it once;
* a timer set in the past runs before the next row.

With ``delay`` the stream holds rows back until the watermark (greatest event
time - delay) reaches them, and runs timers it has passed; rows behind it are
dropped by Spark.  Without ``delay`` rows are applied batch by batch, nothing
is dropped, and timers are not available.  ``process_batch`` over the same rows
gives what the stream has emitted (``end="open"``: rows and timers up to the
watermark), or the result of finished input (``end="closed"``: all of them).

A key is sequential by nature: its rows are one task's, read one by one in
constant memory.  A detector that need not be sequential per key should be an
operator of its own (``runs``, ``chains``, ``cells``).
"""

from __future__ import annotations

import heapq
import sys
from typing import Any, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class KeyedProcess:
    """Subclass this.  ``state``: fields of the state record as DDL, all null for a
    new key; ``output``: columns of the emitted rows as DDL (the key columns are
    put before them)."""

    state = "unused int"
    output = "value string"

    def on_row(self, row: Any, ctx: Context) -> None:
        """``row`` has the input columns as attributes."""

    def on_timer(self, t_ms: int, ctx: Context) -> None:
        """A timer set for ``t_ms`` is due."""


class Context:
    """What a process may touch while it handles a row or timer of one key."""

    def __init__(self, key: tuple, state: dict, timers: list[int], timed: bool):
        self.key, self.state, self.timed = key, state, timed
        self.timers = sorted(set(timers))  # a sorted list is a heap
        self.emitted: list[tuple] = []

    def emit(self, *values) -> None:
        self.emitted.append((*self.key, *values))

    def set_timer(self, t_ms: int) -> None:
        if not self.timed:
            raise ValueError("timers need a delay (a watermark)")
        if t_ms not in self.timers:
            heapq.heappush(self.timers, int(t_ms))

    def delete_timer(self, t_ms: int) -> None:
        if t_ms in self.timers:
            self.timers.remove(t_ms)
            heapq.heapify(self.timers)


def advance(process: KeyedProcess, ctx: Context, before: float) -> None:
    """Run the timers set for times below ``before``."""
    while ctx.timers and ctx.timers[0] < before:
        process.on_timer(heapq.heappop(ctx.timers), ctx)


def ship(process: KeyedProcess) -> None:
    """Send the module of a user's class to the executors with its code."""
    module = sys.modules[type(process).__module__]
    if module.__name__ != "__main__":  # whose classes go by value anyway
        cloudpickle.register_pickle_by_value(module)


def fields(ddl: str) -> list[T.StructField]:
    return T._parse_datatype_string(ddl).fields


class _Runner(StatefulProcessor):
    def __init__(self, process: KeyedProcess, names: list[str], out: list[str], t: str, seq: str, timed: bool):
        self.process, self.names, self.out, self.t, self.seq, self.timed = process, names, out, t, seq, timed
        self.state_names = [f.name for f in fields(process.state)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.record = handle.getValueState("record", self.process.state)
        self.timers = handle.getListState("timers", "t long")
        self.alarm = handle.getValueState("alarm", "t long")
        self.waiting = handle.getListState("waiting", self.waiting_schema) if self.timed else None

    def _step(self, key, rows: pd.DataFrame | None, wm: float) -> pd.DataFrame:
        held = [tuple(r) for r in self.waiting.get()] if self.timed and self.waiting.exists() else []
        new = list(rows.itertuples(index=False, name=None)) if rows is not None else []
        at, nth = self.names.index(self.t), self.names.index(self.seq)
        everything = sorted(held + [tuple(None if v is pd.NaT or v != v else v for v in r) for r in new], key=lambda r: (r[at], r[nth]))
        ready = [r for r in everything if r[at] <= wm]
        later = [r for r in everything if r[at] > wm]
        record = self.record.get() if self.record.exists() else [None] * len(self.state_names)
        was = [x[0] for x in self.timers.get()] if self.timed and self.timers.exists() else []
        ctx = Context(tuple(key), dict(zip(self.state_names, record)), was, self.timed)
        for row in pd.DataFrame(ready, columns=self.names, dtype=object).itertuples(index=False) if ready else ():
            advance(self.process, ctx, getattr(row, self.t))
            self.process.on_row(row, ctx)
        if self.timed:
            advance(self.process, ctx, wm)
            self._keep(later, sorted(ctx.timers), was)
            # Timers below the watermark fire: a row is due when the watermark
            # reaches it, a timer of the user when it is passed.
            self._wake(min([r[at] - 1 for r in later[:1]] + sorted(ctx.timers)[:1], default=None))
        self.record.update(tuple(ctx.state[n] for n in self.state_names))
        return pd.DataFrame(ctx.emitted, columns=self.out)

    def _keep(self, later, timers, was) -> None:
        self.waiting.clear()
        if later:
            self.waiting.put(later)
        if timers != sorted(was):
            self.timers.clear()
            if timers:
                self.timers.put([(x,) for x in timers])

    def _wake(self, due: int | None) -> None:
        before = self.alarm.get()[0] if self.alarm.exists() else None
        if due == before:
            return
        if before is not None:
            self.handle.deleteTimer(before)
        self.alarm.clear()
        if due is not None:
            self.handle.registerTimer(due)
            self.alarm.update((due,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = [r[self.names] for r in rows if len(r)]
        pdf = pd.concat(parts, ignore_index=True).astype(object) if parts else None
        yield self._step(key, pdf, timerValues.getCurrentWatermarkInMs() if self.timed else float("inf"))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.alarm.clear()
        yield self._step(key, None, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def _usable(df: DataFrame, keys: list[str], columns: list[str], t: str, seq: str) -> tuple[DataFrame, list[str]]:
    names = list(dict.fromkeys([*keys, *columns, t, seq]))
    present = F.col(t).isNotNull()
    for k in keys:
        present = present & F.col(k).isNotNull()
    return df.where(present), names


def _out_schema(df: DataFrame, keys: list[str], process: KeyedProcess) -> T.StructType:
    return T.StructType([df.schema[k] for k in keys] + fields(process.output))


def process_stream(df: DataFrame, keys: list[str], process: KeyedProcess, columns: list[str], delay: str | None = None,
                   t: str = "t_ms", seq: str = "seq", event_time: str = "event_time") -> DataFrame:
    """Run ``process`` over a stream.  ``columns``: what ``on_row`` reads."""
    ship(process)
    rows, names = _usable(df, keys, columns, t, seq)
    out = _out_schema(df, keys, process)
    runner = _Runner(process, names, out.fieldNames(), t, seq, delay is not None)
    runner.waiting_schema = T.StructType([df.schema[n] for n in names])
    if delay is None:
        return rows.select(*names).groupBy(*keys).transformWithStateInPandas(
            statefulProcessor=runner, outputStructType=out, outputMode="Append", timeMode="None")
    return rows.select(*names, event_time).withWatermark(event_time, delay).groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=runner, outputStructType=out, outputMode="Append", timeMode="EventTime")


def process_batch(df: DataFrame, keys: list[str], process: KeyedProcess, columns: list[str], delay_ms: int | None = None,
                  end: str = "closed", t: str = "t_ms", seq: str = "seq") -> DataFrame:
    """Run ``process`` over a table: the rows the stream emits (``end="open"``), or
    those of finished input (``end="closed"``)."""
    if end not in ("open", "closed"):
        raise ValueError(f"end is 'open' or 'closed', not {end!r}")
    ship(process)
    rows, names = _usable(df, keys, columns, t, seq)
    out = _out_schema(df, keys, process)
    until, timed = float("inf"), delay_ms is not None
    if timed and end == "open":
        top = rows.agg(F.max(t)).first()[0]
        until = top - delay_ms if top is not None else 0
        rows = rows.where(F.col(t) <= until)
    state_names = [f.name for f in fields(process.state)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ctx = None
        for pdf in batches:
            emitted = []
            for row in pdf.astype(object).where(pdf.notna(), None).itertuples(index=False):
                key = tuple(getattr(row, k) for k in keys)
                if ctx is None or key != ctx.key:
                    if ctx is not None:
                        advance(process, ctx, until)
                        emitted += ctx.emitted
                    ctx = Context(key, dict.fromkeys(state_names), [], timed)
                advance(process, ctx, getattr(row, t))
                process.on_row(row, ctx)
                if ctx.emitted:
                    emitted += ctx.emitted
                    ctx.emitted = []
            yield pd.DataFrame(emitted, columns=out.fieldNames())
        if ctx is not None:
            advance(process, ctx, until)
            yield pd.DataFrame(ctx.emitted, columns=out.fieldNames())

    return rows.select(*names).repartition(*keys).sortWithinPartitions(*keys, t, seq).mapInPandas(run, out)


class Silence(KeyedProcess):
    """A key that sends nothing for ``quiet_ms`` after a row: (last row's time, end of
    the silence's allowance).  One timer per key, moved with every row."""

    state = "last long"
    output = "last_t_ms long, due_t_ms long"

    def __init__(self, quiet_ms: int):
        self.quiet_ms = quiet_ms

    def on_row(self, row, ctx):
        if ctx.state["last"] is not None:
            ctx.delete_timer(ctx.state["last"] + self.quiet_ms)
        ctx.state["last"] = int(row.t_ms)
        ctx.set_timer(ctx.state["last"] + self.quiet_ms)

    def on_timer(self, t_ms, ctx):
        ctx.emit(ctx.state["last"], t_ms)


class Gridlock(KeyedProcess):
    """The run counter as a process function (``operators.runs`` is the form that
    splits a hot junction)."""

    state = "n int"
    output = "zone string, avg_wait_sec double, timestamp string, t_ms long, seq long"

    def __init__(self, threshold: float, cycles: int):
        self.threshold, self.cycles = threshold, cycles

    def on_row(self, row, ctx):
        n = (ctx.state["n"] or 0) + 1 if (row.avg_wait_sec or 0.0) > self.threshold else 0
        ctx.state["n"] = n
        if n == self.cycles:
            ctx.emit(row.zone, row.avg_wait_sec, row.timestamp, int(row.t_ms), int(row.seq))
