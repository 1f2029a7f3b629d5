"""Stateful stream detectors (``transformWithStateInPandas``).

Both processors sort each key's rows of a micro-batch by ``(t_ms, seq)``
before applying them (Spark gives no order inside a group), so for input that
arrives in time order they produce exactly the batch forms' alerts.

* consecutive runs (gridlock): one integer per key (the current run length),
  no timers; late rows are not dropped (no watermark), as in the reference;
* bunching: rows are applied in event order once the watermark reaches them,
  and alerts are emitted once the watermark (max event time - delay) passes
  their deadline.  Rows behind the watermark are dropped by Spark (documented
  difference).  By default it runs by grid cell (``cells``), so a hot route is
  many tasks; ``keyed_by="route"`` is the reference's keying, one processor
  with all state of a route, which position expiry and unbuffered processing
  need.
"""

from __future__ import annotations

import math
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from civicflow.functions import alerts as A
from civicflow.functions.geo import EARTH_RADIUS_M
from civicflow.operators.proximity import BUNCHING_HOLD_MS, BUNCHING_RADIUS_M
from civicflow.operators.runs import GRIDLOCK_CYCLES, GRIDLOCK_WAIT_SEC, gridlock_breach
from civicflow.streaming.cells import watches_by_cell


def _sorted(rows: Iterator[pd.DataFrame], by: tuple[str, ...] = ("t_ms", "seq")) -> pd.DataFrame:
    frames = [r for r in rows if len(r)]
    if not frames:
        return pd.DataFrame()
    return pd.concat(frames, ignore_index=True).sort_values(list(by), kind="stable")


# -- consecutive runs (gridlock) -------------------------------------------------


class RunProcessor(StatefulProcessor):
    """Run length per key: +1 on a breaching row, reset otherwise; a row is
    emitted when the run reaches exactly ``n``."""

    def __init__(self, n: int, columns: list[str], ttl_ms: int | None = None,
                 order: tuple[str, ...] = ("t_ms", "seq")):
        self.n, self.columns, self.ttl_ms, self.order = n, columns, ttl_ms, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", "n int", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, self.order)
        n = self.run.get()[0] if self.run.exists() else 0
        hit = []
        if len(pdf):
            for i, breach in enumerate(pdf["breach_flag"].tolist()):
                if breach is True or breach == 1:
                    n += 1
                    if n == self.n:
                        hit.append(i)
                else:
                    n = 0
        self.run.update((n,))
        yield pdf.iloc[hit][self.columns] if hit else pd.DataFrame([], columns=self.columns)

    def close(self) -> None:
        pass


def consecutive_runs_stream(df: DataFrame, key: str, breach: Column, n: int,
                            keep: list[str], ttl_ms: int | None = None,
                            order: str = "event_time") -> DataFrame:
    """Streaming form of ``operators.runs.consecutive_runs``: the rows that
    complete a run of exactly ``n`` breaches of their key (``breach`` null =
    no breach).  ``keep`` are the output columns (``t_ms`` and ``seq`` order
    the rows of a micro-batch; ``order='arrival'`` uses ``seq`` alone).  No
    watermark: late rows are not dropped."""
    cols = list(dict.fromkeys([key, *keep, "t_ms", "seq"]))
    usable = df.filter(F.col("t_ms").isNotNull() & F.col(key).isNotNull())
    src = usable.select(*cols, F.coalesce(breach, F.lit(False)).alias("breach_flag"))
    out_schema = T.StructType([src.schema[c] for c in cols])
    return src.groupBy(key).transformWithStateInPandas(
        statefulProcessor=RunProcessor(n, cols, ttl_ms, ("seq",) if order == "arrival" else ("t_ms", "seq")),
        outputStructType=out_schema, outputMode="Append", timeMode="None",
    )


def gridlock_stream(traffic: DataFrame, threshold: float = GRIDLOCK_WAIT_SEC,
                    cycles: int = GRIDLOCK_CYCLES, detected_at: Column | None = None,
                    ttl_ms: int | None = None, order: str = "event_time") -> DataFrame:
    """Streaming gridlock alerts from a typed traffic stream.

    ``ttl_ms`` (processing time) bounds how long an idle junction's run
    length is kept; by default it never expires, as in the reference."""
    fired = consecutive_runs_stream(
        traffic, "junction_id", gridlock_breach("avg_wait_sec", threshold), cycles,
        keep=["zone", "avg_wait_sec", "timestamp"], ttl_ms=ttl_ms, order=order,
    )
    desc = F.format_string(A.GRIDLOCK_TEMPLATE, F.col("junction_id"), F.col("avg_wait_sec"),
                           F.lit(int(threshold)), F.lit(cycles), F.col("zone"))
    return fired.select(
        *A.alert_columns(A.GRIDLOCK, F.col("junction_id"), F.col("zone"), desc, F.col("timestamp"), detected_at),
        "t_ms", "seq",
    )


# -- bus bunching -----------------------------------------------------------------

BUNCHING_OUT = T.StructType([
    T.StructField("route_id", T.StringType()),
    T.StructField("lo", T.StringType()),
    T.StructField("hi", T.StringType()),
    T.StructField("deadline", T.LongType()),
    T.StructField("source_ts", T.StringType()),
    T.StructField("distance", T.DoubleType()),
])


def haversine(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    """Same formula as the column version; an out-of-range term gives NaN."""
    r = math.radians
    a = math.sin(r(lat2 - lat1) / 2) ** 2 + math.cos(r(lat1)) * math.cos(r(lat2)) * math.sin(r(lon2 - lon1) / 2) ** 2
    if not (0.0 <= a <= 1.0):
        return float("nan")
    return EARTH_RADIUS_M * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


class BunchingProcessor(StatefulProcessor):
    """Per-route state machine of the bunching detector.

    Rows are buffered and applied in ``(t, seq)`` order once the watermark
    has reached them: a later micro-batch can then only bring rows above the
    watermark (Spark drops the rest), so out-of-order arrival within the
    delay does not change the result.  One event-time timer per route wakes
    the processor for the earliest buffered row or deadline.
    """

    def __init__(self, radius_m: float = BUNCHING_RADIUS_M, hold_ms: int = BUNCHING_HOLD_MS,
                 position_ttl_ms: int | None = None, once_per_episode: bool = False,
                 buffer_until_watermark: bool = True):
        self.radius_m, self.hold_ms, self.position_ttl_ms = radius_m, hold_ms, position_ttl_ms
        self.once, self.buffered = once_per_episode, buffer_until_watermark

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getListState(
            "buffer", "bus string, lat double, lon double, t long, seq long, ts string")
        self.positions = handle.getMapState(
            "positions", "bus string", "lat double, lon double, t long, seq long, ts string",
            self.position_ttl_ms)
        self.watches = handle.getMapState("watches", "lo string, hi string", "deadline long")
        self.decided = handle.getMapState(
            "decided", "lo string, hi string, deadline long", "ts string, dist double")
        # once_per_episode: pairs that alerted and have not been seen apart since.
        self.quiet = handle.getMapState("quiet", "lo string, hi string", "q boolean")
        self.timer = handle.getValueState("timer", "expiry long")

    def _reschedule(self, due) -> None:
        cur = self.timer.get()[0] if self.timer.exists() else None
        if due == cur:
            return
        if cur is not None:
            self.handle.deleteTimer(cur)
        if due is None:
            self.timer.clear()
        else:
            self.handle.registerTimer(due)
            self.timer.update((due,))

    def _apply(self, recs: list[tuple]) -> None:
        """Apply pings (bus, lat, lon, t, seq, ts) in order.  The route's state
        is read once and only changed entries are written back."""
        pos = {k[0]: tuple(v) for k, v in self.positions.iterator()}
        watches = {tuple(k): v[0] for k, v in self.watches.iterator()}
        orig_watches = dict(watches)
        quiet = {tuple(k) for k, _ in self.quiet.iterator()} if self.once else set()
        orig_quiet = set(quiet)
        moved, decided = set(), {}
        radius, hold = self.radius_m, self.hold_ms
        for bus, lat, lon, t, sq, ts in recs:
            prev = pos.get(bus)
            pos[bus] = (lat, lon, t, sq, ts)
            moved.add(bus)
            for other, (olat, olon, _ot, _os, ots) in pos.items():
                if other == bus:
                    continue
                pair = (bus, other) if bus < other else (other, bus)
                deadline = watches.get(pair)
                if deadline is not None and t > deadline:
                    # The watch outlived its deadline: decided, with the positions as of then.
                    ts_lo = prev[4] if pair[0] == bus else ots
                    decided[(*pair, deadline)] = (ts_lo, haversine(prev[0], prev[1], olat, olon))
                    del watches[pair]
                    deadline = None
                    if self.once:
                        quiet.add(pair)
                if not (haversine(lat, lon, olat, olon) < radius):
                    watches.pop(pair, None)
                    quiet.discard(pair)
                elif deadline is None and pair not in quiet:
                    watches[pair] = t + hold
        for bus in moved:
            self.positions.updateValue((bus,), pos[bus])
        for pair in orig_watches.keys() - watches.keys():
            self.watches.removeKey(pair)
        for pair, dl in watches.items():
            if orig_watches.get(pair) != dl:
                self.watches.updateValue(pair, (dl,))
        for k, v in decided.items():
            self.decided.updateValue(k, v)
        for pair in orig_quiet - quiet:
            self.quiet.removeKey(pair)
        for pair in quiet - orig_quiet:
            self.quiet.updateValue(pair, (True,))

    def _emit_due(self, route: str, wm: int) -> tuple[list, list]:
        """Alerts whose deadline the watermark has passed (deadline + 1 <=
        watermark): decided ones with their stored positions, open ones with
        the current positions (no observation of the pair came after the
        deadline, or it would have been decided).  Returns (alerts, remaining
        deadlines)."""
        out, remaining = [], []
        for k, (ts, dist) in list(self.decided.iterator()):
            lo, hi, dl = k
            if dl + 1 <= wm:
                out.append((route, lo, hi, dl, ts, dist))
                self.decided.removeKey((lo, hi, dl))
            else:
                remaining.append(dl)
        pos = None
        for k, v in list(self.watches.iterator()):
            (lo, hi), dl = tuple(k), v[0]
            if dl + 1 <= wm:
                if pos is None:
                    pos = {p[0]: tuple(q) for p, q in self.positions.iterator()}
                a, b = pos[lo], pos[hi]
                out.append((route, lo, hi, dl, a[4], haversine(a[0], a[1], b[0], b[1])))
                self.watches.removeKey((lo, hi))
                if self.once:
                    self.quiet.updateValue((lo, hi), (True,))
            else:
                remaining.append(dl)
        return out, remaining

    def _step(self, route: str, new: list[tuple], wm: int) -> pd.DataFrame:
        rows = ([tuple(r) for r in self.buffer.get()] if self.buffer.exists() else []) + new
        limit = wm if self.buffered else float("inf")
        ready = sorted((r for r in rows if r[3] <= limit), key=lambda r: (r[3], r[4]))
        keep = [r for r in rows if r[3] > limit]
        if ready:
            self._apply(ready)
        if ready or new:
            self.buffer.clear()
            if keep:
                self.buffer.put(keep)
        out, remaining = self._emit_due(route, wm)
        dues = remaining + ([min(r[3] for r in keep) - 1] if keep else [])  # timers below the watermark fire
        self._reschedule(min(dues) if dues else None)
        return pd.DataFrame(out, columns=BUNCHING_OUT.fieldNames())

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        (route,) = key
        pdf = _sorted(rows)
        new = []
        for rec in pdf.itertuples(index=False):
            lat = 0.0 if rec.lat is None or rec.lat != rec.lat else float(rec.lat)
            lon = 0.0 if rec.lon is None or rec.lon != rec.lon else float(rec.lon)
            new.append((rec.bus_id, lat, lon, int(rec.t_ms), int(rec.seq), rec.timestamp))
        yield self._step(route, new, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        (route,) = key
        self.timer.clear()
        yield self._step(route, [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def bunching_stream(bus: DataFrame, radius_m: float = BUNCHING_RADIUS_M, hold_ms: int = BUNCHING_HOLD_MS,
                    delay: str = "10 seconds", detected_at: Column | None = None,
                    position_ttl_ms: int | None = None, once_per_episode: bool = False,
                    buffer_until_watermark: bool = True, keyed_by: str | None = None,
                    expire_ms: int | None = None) -> DataFrame:
    """Streaming bus-bunching alerts from a typed bus stream (event-time timers).

    ``keyed_by``: ``cell`` (default) or ``route``; ``position_ttl_ms`` and
    ``buffer_until_watermark=False`` need ``route`` and choose it.

    ``expire_ms`` (event time, with ``cell``) forgets a bus so long after its
    last ping, as the option of the batch form does.

    ``position_ttl_ms`` (processing time) forgets buses that stopped
    reporting; by default positions never expire, as in the reference.
    ``buffer_until_watermark=False`` applies each micro-batch's rows at once
    (one batch less latency and state traffic; exact only for in-order input)."""
    src = bus.select("route_id", "bus_id", "lat", "lon", "timestamp", "t_ms", "seq", "event_time").filter(
        F.col("t_ms").isNotNull() & F.col("bus_id").isNotNull()
    )
    needs_route = position_ttl_ms is not None or not buffer_until_watermark
    keyed_by = keyed_by or ("route" if needs_route else "cell")
    if keyed_by not in ("cell", "route") or (keyed_by == "cell" and needs_route):
        raise ValueError("keyed_by is 'cell' or 'route'; position_ttl_ms and buffer_until_watermark=False need 'route'")
    if expire_ms is not None and (keyed_by == "route" or expire_ms <= 0):
        raise ValueError("expire_ms is a positive time and needs keyed_by='cell'")
    if keyed_by == "cell":
        fired = watches_by_cell(src, BUNCHING_OUT, radius_m, hold_ms, delay, once_per_episode, expire_ms)
    else:
        fired = src.withWatermark("event_time", delay).groupBy("route_id").transformWithStateInPandas(
            statefulProcessor=BunchingProcessor(radius_m, hold_ms, position_ttl_ms, once_per_episode,
                                                buffer_until_watermark),
            outputStructType=BUNCHING_OUT, outputMode="Append", timeMode="EventTime",
        )
    desc = F.format_string(A.BUNCHING_TEMPLATE, F.col("lo"), F.col("hi"), F.col("route_id"), F.col("distance"))
    return fired.select(
        *A.alert_columns(A.BUS_BUNCHING, F.concat_ws(":", "lo", "hi"), F.lit(""), desc,
                         F.col("source_ts"), detected_at),
        F.col("deadline").alias("t_ms"), F.lit(None).cast("long").alias("seq"),
    )
