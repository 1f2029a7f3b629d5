"""Streaming bus bunching by grid cell.

Three chained stateful operators, so that no route, however many buses it has,
is one task:

1. by bus: pings are applied in event order once the watermark reaches them;
   each one is sent to the cell it lies in (its home) and to the seven cells
   from which a bus could be within the radius of it; cells that the bus leaves
   get a row that says so, as do all of them when its position expires;
2. by (route, cell): the buses in and around the cell.  The home cell of a
   pair's first bus owns the pair: it sends an observation for every ping of
   either bus while they are near, and one when they no longer are (also when
   it ceases to own the pair; if they are still near, the new owner says so
   for the same ping);
3. by pair: one watch with a deadline, and one event-time timer.

Operators 2 and 3 get all rows up to the watermark in one micro-batch (the
first one holds them back until then), sort them by (event time, arrival) and
apply them at once.  A ping costs as many distances as there are buses in its
eight cells.  What one bus sends to a cell, and a cell about a pair, travels as
arrays of up to ``PIECE`` entries a row, and is worked on in array operations
over blocks of bounded size.

Memory: a bus holds its waiting pings (in its state as Arrow blocks) and last
position, a cell the buses in and around it, a pair a few numbers while it is
near.  A worker holds the columns of one key's rows of a micro-batch.
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from civicflow.functions.geo import EARTH_RADIUS_M, chord_cell_size
from civicflow.operators.proximity import EXPIRY_SEQ


def _arrays(**types: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, T.ArrayType(t)) for name, t in types.items()]


CELL_ROWS = T.StructType([
    T.StructField("route_id", T.StringType()), T.StructField("cx", T.LongType()), T.StructField("cy", T.LongType()),
    T.StructField("cz", T.LongType()), T.StructField("bus_id", T.StringType()),
    *_arrays(kind=T.IntegerType(), lat=T.DoubleType(), lon=T.DoubleType(), t=T.LongType(), seq=T.LongType(), ts=T.StringType()),
    T.StructField("event_time", T.TimestampType()),
])
PAIR_ROWS = T.StructType([
    T.StructField("route_id", T.StringType()), T.StructField("lo", T.StringType()), T.StructField("hi", T.StringType()),
    *_arrays(t=T.LongType(), seq=T.LongType(), near=T.BooleanType(), ts=T.StringType(), distance=T.DoubleType()),
    T.StructField("event_time", T.TimestampType()),
])
LEFT, AROUND, HOME = 0, 1, 2
#: Entries of a row's arrays, so that an Arrow batch of rows stays small.
PIECE = 32
#: Pings placed on the grid at once, and kept in one block of a bus's state.
PINGS = 4096
#: Entries of the (row, bus) matrices of a cell that are held at once.
MATRIX = 250_000
#: NumPy types of the columns of rows; ``ts`` stays an Arrow column.
NUMBERS = {"kind": np.int8, "lat": np.float64, "lon": np.float64, "t": np.int64, "seq": np.int64, "near": np.bool_,
           "distance": np.float64, "who": np.int32}


def pieces(*keys: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of up to ``PIECE`` sorted rows with equal keys."""
    n = len(keys[0])
    if not n:
        return []
    new = np.ones(n, bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    starts = np.flatnonzero(new).tolist()
    return [(i, min(i + PIECE, end)) for a, end in zip(starts, [*starts[1:], n]) for i in range(a, end, PIECE)]


def frame(rows: list[tuple], schema: T.StructType) -> pd.DataFrame:
    """Rows without their event time, which is that of their first entry."""
    pdf = pd.DataFrame(rows, columns=[n for n in schema.fieldNames() if n != "event_time"])
    pdf["event_time"] = pd.to_datetime([int(t[0]) for t in pdf["t"]], unit="ms")
    return pdf[schema.fieldNames()]


def unpacked(rows: Iterator[pd.DataFrame], columns: list[str], bus_codes: dict | None = None) -> dict:
    """The entries of rows of arrays as columns, unsorted; with ``bus_codes`` also
    ``who``, a number a bus (new ones are added)."""
    parts = {c: [] for c in (*columns, "ts", *(["who"] if bus_codes is not None else []))}
    for pdf in rows:
        if not len(pdf):
            continue
        for c in columns:
            parts[c].append(np.concatenate([np.asarray(v, NUMBERS[c]) for v in pdf[c]]))
        parts["ts"].append(pa.array(np.concatenate([np.asarray(v, object) for v in pdf["ts"]]), pa.string(), from_pandas=True))
        if bus_codes is not None:
            codes = [bus_codes.setdefault(b, len(bus_codes)) for b in pdf["bus_id"]]
            parts["who"].append(np.repeat(np.array(codes, np.int32), [len(v) for v in pdf["t"]]))
    ts = pa.chunked_array(parts.pop("ts"), pa.string())
    return {"ts": ts} | {c: np.concatenate(parts.pop(c)) if parts[c] else np.zeros(0, NUMBERS[c]) for c in list(parts)}


def strings(column: pa.ChunkedArray, at: np.ndarray) -> np.ndarray:
    """Entries of an Arrow column of strings at places; a negative place gives none."""
    return column.take(pa.array(at, mask=at < 0)).to_numpy()


def grid(lat: np.ndarray, lon: np.ndarray, edge: float) -> np.ndarray:
    """The cell of each position and, behind it, the other seven within half an edge."""
    a, b = np.radians(lat), np.radians(lon)
    q = np.stack([np.cos(a) * np.cos(b), np.cos(a) * np.sin(b), np.sin(a)], axis=1) / edge
    base = np.floor(q)
    side = np.where(q - base < 0.5, -1, 1)
    corner = np.array([[i >> k & 1 for k in range(3)] for i in range(8)])
    return base.astype(np.int64)[:, None, :] + side[:, None, :] * corner[None, :, :]


def cells_of(lat: float, lon: float, edge: float) -> list[tuple[int, int, int]]:
    """``grid`` of one position."""
    return [tuple(c) for c in grid(np.array([lat]), np.array([lon]), edge)[0].tolist()]


def distance_m(lat, lon, lat2, lon2) -> np.ndarray:
    """Great-circle distances; an out-of-range term gives NaN."""
    r = np.radians
    a = np.sin(r(lat2 - lat) / 2) ** 2 + np.cos(r(lat)) * np.cos(r(lat2)) * np.sin(r(lon2 - lon) / 2) ** 2
    a = np.where((a >= 0) & (a <= 1), a, np.nan)
    return EARTH_RADIUS_M * 2 * np.arctan2(np.sqrt(a), np.sqrt(1 - a))


PINGS_OF_A_BUS = pa.schema([("lat", pa.float64()), ("lon", pa.float64()), ("t", pa.int64()), ("seq", pa.int64()), ("ts", pa.string())])


def to_block(pings: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pings.schema) as writer:
        writer.write_table(pings)
    return sink.getvalue().to_pybytes()


class BusCells(StatefulProcessor):
    """Pings of one bus -> rows for the cells in and around which it is."""

    def __init__(self, edge: float, expire_ms: int | None = None):
        self.edge, self.expire_ms = edge, expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "pings binary")
        self.last = handle.getValueState("last", "lat double, lon double, t long")
        self.timer = handle.getValueState("timer", "expiry long")

    def _step(self, key, new: list[pa.Table], wm: int) -> Iterator[pd.DataFrame]:
        held = [pa.ipc.open_stream(bytes(b)).read_all() for (b,) in self.waiting.get()] if self.waiting.exists() else []
        rows = pa.concat_tables([PINGS_OF_A_BUS.empty_table(), *held, *new]).combine_chunks()
        t, seq = rows["t"].to_numpy(), rows["seq"].to_numpy()
        keep, ready = np.flatnonzero(t > wm), np.flatnonzero(t <= wm)
        ready = ready[np.lexsort((seq[ready], t[ready]))]
        if held:
            self.waiting.clear()
        for i in range(0, len(keep), PINGS):
            self.waiting.appendValue((to_block(rows.take(keep[i:i + PINGS])),))
        before = self.last.get() if self.last.exists() else None
        now = before
        if len(ready):
            now = tuple(rows[c][int(ready[-1])].as_py() for c in ("lat", "lon", "t"))
        if now is not None and self.expire_ms is not None and now[2] + self.expire_ms <= wm:
            self.last.clear()
            dues = []
        else:
            if len(ready):
                self.last.update(now)
            dues = [now[2] + self.expire_ms] if now is not None and self.expire_ms is not None else []
        if len(keep):
            dues.append(int(t[keep].min()))
        # Timers below the watermark fire, and what is due at the watermark must
        # leave now: with the next one it may be late for the operators behind.
        due = min(dues) - 1 if dues else None
        was = self.timer.get()[0] if self.timer.exists() else None
        if due != was:
            if was is not None:
                self.handle.deleteTimer(was)
            self.timer.clear()
            if due is not None:
                self.handle.registerTimer(due)
                self.timer.update((due,))
        yield from self._moves(*key, rows, ready, before, wm)

    def _moves(self, route: str, bus: str, rows: pa.Table, ready: np.ndarray, last: tuple | None, wm: int) -> Iterator[pd.DataFrame]:
        """Rows for the cells of the pings in ``ready``, and of positions that expire up to ``wm``."""
        for start in range(0, len(ready), PINGS):
            some = rows.take(ready[start:start + PINGS])
            lat, lon, t, seq = (some[c].to_numpy() for c in ("lat", "lon", "t", "seq"))
            n = len(t)
            cells = grid(lat, lon, self.edge)
            # The cells and the time of the ping before; the first of all has none.
            first = 0 if last is not None else 1
            old = np.concatenate([cells[:1] if last is None else grid(np.array(last[:1]), np.array(last[1:2]), self.edge), cells[:-1]])
            old_t = np.concatenate([t[:1] if last is None else np.array(last[2:], np.int64), t[:-1]])
            gone = np.zeros(n, bool) if self.expire_ms is None else old_t + self.expire_ms <= t
            gone[:first] = False
            moved = np.flatnonzero((cells != old).any(axis=(1, 2)) & ~gone)
            moved = moved[moved >= first]
            out_of = ~(old[moved][:, :, None, :] == cells[moved][:, None, :, :]).all(-1).any(-1)
            left_i, left_c = moved[np.nonzero(out_of)[0]], old[moved][out_of]
            gone = np.flatnonzero(gone)
            gone_i, gone_c = np.repeat(gone, 8), old[gone].reshape(-1, 3)
            here = np.repeat(np.arange(n), 8)
            i = np.concatenate([gone_i, left_i, here])
            cell = np.concatenate([gone_c, left_c, cells.reshape(-1, 3)])
            kind = np.concatenate([np.full(len(gone_i) + len(left_i), LEFT, np.int32), np.tile(np.array([HOME] + [AROUND] * 7, np.int32), n)])
            expired = np.arange(len(i)) < len(gone_i)
            at = np.lexsort((~expired, i, cell[:, 2], cell[:, 1], cell[:, 0]))
            i, cell, kind, expired = i[at], cell[at], kind[at], expired[at]
            when = t[i]
            if len(gone):
                when = np.where(expired, old_t[i] + self.expire_ms, when)
            number = np.where(expired, EXPIRY_SEQ, seq[i])
            # A pair's time is that of its first bus, which is at home: no other is sent.
            ts = strings(some["ts"], np.where(expired | (kind == AROUND), -1, i))
            yield frame([(route, *cell[a].tolist(), bus, kind[a:b], lat[i[a:b]], lon[i[a:b]], when[a:b], number[a:b], ts[a:b])
                         for a, b in pieces(*cell.T)], CELL_ROWS)
            last = (float(lat[-1]), float(lon[-1]), int(t[-1]))
        if last is not None and self.expire_ms is not None and last[2] + self.expire_ms <= wm:
            yield frame([(route, *c, bus, [LEFT], [0.0], [0.0], [last[2] + self.expire_ms], [EXPIRY_SEQ], [None])
                         for c in cells_of(*last[:2], self.edge)], CELL_ROWS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = [pa.table([pdf["lat"].astype(float), pdf["lon"].astype(float), pdf["t_ms"].astype(np.int64), pdf["seq"].astype(np.int64),
                         pa.array(pdf["timestamp"], pa.string(), from_pandas=True)], schema=PINGS_OF_A_BUS) for pdf in rows if len(pdf)]
        yield from self._step(key, new, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        yield from self._step(key, [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


class Roster:
    """The buses in and around a cell, as columns."""

    def __init__(self, rows):
        self.names, self.ts, at = [], [], []
        for name, (home, lat, lon, ts) in rows:
            self.names.append(name)
            self.ts.append(ts)
            at.append((lat, lon, home))
        self.at = np.array(at, np.float64).reshape(-1, 3)
        self.place = {n: i for i, n in enumerate(self.names)}

    def put(self, bus: str, lat: float, lon: float, home: bool, ts: str) -> int:
        i = self.place.get(bus)
        if i is None:
            i = self.place[bus] = len(self.names)
            self.names.append(bus)
            self.ts.append(ts)
            if i == len(self.at):
                self.at = np.concatenate([self.at, np.zeros((max(8, i), 3))])
        self.ts[i] = ts
        self.at[i] = lat, lon, home
        return i

    def drop(self, bus: str) -> None:
        i = self.place.pop(bus, None)
        if i is not None:
            last = len(self.names) - 1
            if i != last:
                self.names[i], self.ts[i] = self.names[last], self.ts[last]
                self.at[i] = self.at[last]
                self.place[self.names[i]] = i
            self.names.pop()
            self.ts.pop()

    def distances(self, lat: float, lon: float) -> np.ndarray:
        """Great-circle distances of the buses; an out-of-range term gives NaN."""
        b_lat, b_lon = self.at[:len(self.names), 0], self.at[:len(self.names), 1]
        return distance_m(lat, lon, b_lat, b_lon)


class CellPairs(StatefulProcessor):
    """Rows of one cell -> observations of the pairs it owns."""

    def __init__(self, radius_m: float):
        self.radius_m = radius_m

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buses = handle.getMapState("buses", "bus string", "home boolean, lat double, lon double, ts string")
        self.near = handle.getMapState("near", "lo string, hi string", "near boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        roster = Roster((k[0], tuple(v)) for k, v in self.buses.iterator())
        before = {tuple(k) for k, _ in self.near.iterator()}
        codes = dict(roster.place)
        c = unpacked(rows, ["kind", "lat", "lon", "t", "seq"], codes)
        watch = CellWatch(roster, codes, before, self.radius_m)
        order = np.lexsort((c["seq"], c["t"]))
        if watch.home.any() or (c["kind"] == HOME).any():
            step = max(1, MATRIX // len(codes))
        else:  # without a bus at home the cell owns no pair: only the last row of each bus counts
            ends = watch.ends(c["who"][order])
            order, step = order[np.sort(ends[ends >= 0])], max(1, MATRIX // len(codes))
        for i in range(0, len(order), step):
            rows_at = order[i:i + step]
            found = watch.apply({k: v[rows_at] for k, v in c.items() if k != "ts"}, strings(c["ts"], rows_at))
            yield frame([(key[0], *r) for r in found], PAIR_ROWS)
        for bus in np.unique(c["who"]).tolist():
            name = watch.names[bus]
            if watch.present[bus]:
                i = roster.put(name, watch.lat[bus], watch.lon[bus], watch.home[bus], watch.ts[bus])
                self.buses.updateValue((name,), (bool(roster.at[i, 2]), float(roster.at[i, 0]), float(roster.at[i, 1]), roster.ts[i]))
            elif self.buses.containsKey((name,)):
                self.buses.removeKey((name,))
        near = watch.near_pairs()
        for pair in before - near:
            self.near.removeKey(pair)
        for pair in near - before:
            self.near.updateValue(pair, (True,))

    def close(self) -> None:
        pass


class CellWatch:
    """The buses of a cell by number, and its near pairs, while rows in order are
    applied block by block."""

    def __init__(self, roster: Roster, codes: dict, near: set, radius_m: float):
        self.names, self.radius_m, n = list(codes), radius_m, len(roster.names)
        size = len(codes)
        self.lat, self.lon, self.home, self.present = np.zeros(size), np.zeros(size), np.zeros(size, bool), np.zeros(size, bool)
        self.lat[:n], self.lon[:n], self.home[:n], self.present[:n] = roster.at[:n, 0], roster.at[:n, 1], roster.at[:n, 2] > 0, True
        self.ts = np.full(size, None, object)
        self.ts[:n] = roster.ts
        self.rank = np.empty(size, np.int64)
        self.rank[sorted(range(size), key=self.names.__getitem__)] = np.arange(size)
        self.lo = np.array([codes[lo] for lo, _ in near], np.int64)
        self.hi = np.array([codes[hi] for _, hi in near], np.int64)

    def near_pairs(self) -> set:
        return {(self.names[lo], self.names[hi]) for lo, hi in zip(self.lo.tolist(), self.hi.tolist())}

    def ends(self, who: np.ndarray) -> np.ndarray:
        """The last row of each bus, or -1."""
        ends = np.full(len(self.names), -1, np.int64)
        np.maximum.at(ends, who, np.arange(len(who)))
        return ends

    def move(self, c: dict, ts: np.ndarray, ends: np.ndarray) -> None:
        """Let each bus be where its last row says."""
        bus = np.flatnonzero(ends >= 0)
        row = ends[bus]
        self.lat[bus], self.lon[bus], self.ts[bus] = c["lat"][row], c["lon"][row], ts[row]
        self.home[bus], self.present[bus] = c["kind"][row] == HOME, c["kind"][row] != LEFT

    def apply(self, c: dict, ts: np.ndarray) -> list[tuple]:
        """Observations of pairs (lo, hi, t, seq, near, ts, distance) after each row."""
        who, kind, n, size = c["who"], c["kind"], len(c["who"]), len(self.names)
        row = np.arange(n)
        # Per row and bus the bus's last row up to it, or none in this block.
        upto = np.full((n, size), -1, np.int64)
        upto[row, who] = row
        upto = np.maximum.accumulate(upto, axis=0)
        prior = np.concatenate([np.full((1, size), -1, np.int64), upto[:-1]])
        place = np.where(upto >= 0, upto + size, np.arange(size))
        lat, lon = np.concatenate([self.lat, c["lat"]]), np.concatenate([self.lon, c["lon"]])
        home, present = np.concatenate([self.home, kind == HOME]), np.concatenate([self.present, kind != LEFT])
        all_ts = np.concatenate([self.ts, ts])
        # Pairs are owned where the first bus is at home.
        first = self.rank[who][:, None] < self.rank
        owned = np.where(first, (kind == HOME)[:, None], home[place]) & present[place] & (kind != LEFT)[:, None]
        owned[row, who] = False
        r, b = np.nonzero(owned)
        distance = distance_m(c["lat"][r], c["lon"][r], lat[place[r, b]], lon[place[r, b]])
        close = distance < self.radius_m
        r, b, distance = r[close], b[close], distance[close]
        near = np.zeros((n, size), bool)
        near[r, b] = True
        # Whether the pair of a row's bus and another was near: after the later of
        # their rows before, or before the block if this is their first.
        own = prior[row, who][:, None]
        was = np.where(own > prior, near[own[:, 0]], near[prior, who[:, None]]) & (np.maximum(own, prior) >= 0)
        starts = np.full(size, n, np.int64)
        np.minimum.at(starts, who, row)
        begin = np.minimum(starts[self.lo], starts[self.hi])
        met = begin < n
        begin, lo, hi = begin[met], self.lo[met], self.hi[met]
        was[begin, np.where(who[begin] == lo, hi, lo)] = True
        apart_r, apart_b = np.nonzero(was & ~near)
        ends = upto[-1]
        last = r == np.maximum(ends[who[r]], ends[b])
        a, z = who[r[last]], b[last]
        swap = self.rank[a] > self.rank[z]
        self.lo = np.concatenate([self.lo[~met], np.where(swap, z, a)])
        self.hi = np.concatenate([self.hi[~met], np.where(swap, a, z)])
        self.move(c, ts, ends)
        is_near = np.arange(len(r) + len(apart_r)) < len(r)
        r, b = np.concatenate([r, apart_r]), np.concatenate([b, apart_b])
        distance = np.concatenate([distance, np.full(len(apart_r), np.nan)])
        own_first = first[r, b]
        lo, hi = np.where(own_first, who[r], b), np.where(own_first, b, who[r])
        stamp = all_ts[np.where(own_first, r + size, place[r, b])]
        stamp[~is_near] = None
        at = np.lexsort((r, hi, lo))
        r, lo, hi, is_near, stamp, distance = r[at], lo[at], hi[at], is_near[at], stamp[at], distance[at]
        return [(self.names[lo[i]], self.names[hi[i]], c["t"][r[i:j]], c["seq"][r[i:j]], is_near[i:j], stamp[i:j], distance[i:j])
                for i, j in pieces(lo, hi)]


class PairWatch(StatefulProcessor):
    """Observations of one pair -> alerts at deadlines the watermark has passed."""

    def __init__(self, hold_ms: int, once: bool, columns: list[str]):
        self.hold_ms, self.once, self.columns = hold_ms, once, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # deadline null and quiet: alerted, and not seen apart since.
        self.watch = handle.getValueState("watch", "deadline long, quiet boolean, ts_lo string, distance double")

    def _step(self, key, c: dict | None, wm: int) -> pd.DataFrame:
        out, was = [], self.watch.get() if self.watch.exists() else (None, False, None, None)
        deadline, quiet, ts_lo, distance = was
        if c is not None:
            # The owner before says apart, the new one near for the same ping: near comes first.
            at = np.lexsort((~c["near"], c["seq"], c["t"]))
            t, seq = c["t"][at], c["seq"][at]
            told = np.zeros(len(at), bool)
            told[1:] = (t[1:] == t[:-1]) & (seq[1:] == seq[:-1])
            at, t = at[~told], t[~told]
            near = c["near"][at]
            nears, aparts, n = np.flatnonzero(near), np.flatnonzero(~near), len(t)

            def after(places, i):
                j = np.searchsorted(places, i)
                return int(places[j]) if j < len(places) else n

            def seen(i):
                return c["ts"][int(at[i])].as_py(), float(c["distance"][at[i]])

            # From one change of the watch to the next.
            i = 0
            while i < n:
                if deadline is not None:
                    over, apart = max(i, int(np.searchsorted(t, deadline, "right"))), after(aparts, i)
                    end = min(over, apart)
                    if end > i:
                        ts_lo, distance = seen(end - 1)
                    if over < n and over <= apart:
                        out.append((*key, deadline, ts_lo, distance))
                        deadline, quiet, i = None, self.once, over
                    elif apart < n:
                        deadline, quiet, i = None, False, apart + 1
                    else:
                        i = n
                elif quiet:
                    i = after(aparts, i) + 1
                    quiet = i > n
                else:
                    i = after(nears, i)
                    if i < n:
                        deadline, (ts_lo, distance) = int(t[i]) + self.hold_ms, seen(i)
                        i += 1
        if deadline is not None and deadline < wm:
            out.append((*key, deadline, ts_lo, distance))
            deadline, quiet = None, self.once
        if deadline != was[0]:
            if was[0] is not None:
                self.handle.deleteTimer(was[0])
            if deadline is not None:
                self.handle.registerTimer(deadline)
        if deadline is None and not quiet:
            self.watch.clear()
        else:
            self.watch.update((deadline, quiet, ts_lo, distance))
        return pd.DataFrame(out, columns=self.columns)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = unpacked(rows, ["t", "seq", "near", "distance"])
        yield self._step(key, found, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._step(key, None, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def watches_by_cell(pings: DataFrame, out: T.StructType, radius_m: float, hold_ms: int, delay: str, once: bool,
                    expire_ms: int | None = None) -> DataFrame:
    """Fired watches (``out``: route_id, lo, hi, deadline, source_ts, distance) of a
    stream of pings (route_id, bus_id, lat, lon, timestamp, t_ms, seq, event_time)."""
    edge = 2 * chord_cell_size(radius_m)
    placed = pings.fillna(0.0, subset=["lat", "lon"]).withWatermark("event_time", delay).groupBy("route_id", "bus_id").transformWithStateInPandas(
        statefulProcessor=BusCells(edge, expire_ms), outputStructType=CELL_ROWS, outputMode="Append", timeMode="EventTime", eventTimeColumnName="event_time")
    seen = placed.groupBy("route_id", "cx", "cy", "cz").transformWithStateInPandas(
        statefulProcessor=CellPairs(radius_m), outputStructType=PAIR_ROWS, outputMode="Append", timeMode="EventTime", eventTimeColumnName="event_time")
    return seen.groupBy("route_id", "lo", "hi").transformWithStateInPandas(
        statefulProcessor=PairWatch(hold_ms, once, out.fieldNames()), outputStructType=out, outputMode="Append", timeMode="EventTime")
