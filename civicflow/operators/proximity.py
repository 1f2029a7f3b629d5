"""Sustained proximity (bus bunching) as a batch Spark job.

Semantics (per route; the reference keys its state by route):

* every ping of bus ``a`` is compared with the *latest known position* of
  every other bus ``b`` of the route seen so far: one *observation* of the
  unordered pair ``(lo, hi)`` with its haversine distance;
* scanning a pair's observations in ``(t, seq)`` order with one ``deadline``:
  an observation with ``t > deadline`` first fires the pending alert at the
  deadline; a far observation (``dist >= radius``) clears the watch; a near
  one with no watch starts ``deadline = t + hold``;
* a deadline fires only once the watermark passes it, i.e. iff
  ``deadline <= max(t) - delay - 1`` over the whole bus stream;
* the alert reports the positions as of the deadline.

Plan (no route-wide pairing, no unbounded group):

1. *segments*: each ping opens the interval during which it is its bus's
   latest position (exact skew-safe look-ahead);
2. *near observations*: pings meet the segments of other buses through an
   equi-join on (route, 3-D grid cell, time bucket); the grid is on the unit
   sphere and sized by the chord bound of the radius, which is exact;
3. *next observation*: the observation after a near one is the earlier of the
   two buses' next pings (their segment ends); when it is not the pair's next
   near observation it is a far one.  Far observations therefore never have to
   be produced: the near set alone is the pair's complete event sequence;
4. *chains*: near observations are tagged with their island (the stretch
   between two far observations, after which a pair starts afresh); the watch
   starts of an island are a chain of deadlines, split over blocks of time
   (``chains``): a hot route is spread over its pairs, a hot pair over its
   episodes and an endless episode over its blocks;
5. *positions*: a watch that fires has no far observation up to its deadline,
   so the pair's last near observation until then carries both positions.  It is
   at most ``hold`` old, hence found by (pair, bucket of ``hold``), and the pings
   are not searched again.

``order="arrival"`` follows the reference to the letter: rows are applied in
arrival order, and a watch fires at the arrival whose event time lets the
watermark (greatest event time so far - delay - 1) reach its deadline.  Until
and including that row a far ping cancels, later near pings start the next
watch, and the alert carries the positions as of that row.  The steps above run
on the axis of arrival numbers then; the row that a deadline waits for is
looked up in ``arrival``, and as it may be any number of rows later, positions are
looked up in the segments.  A watch whose deadline the watermark has passed
already when it starts (a ping later than hold and delay) fires with its own row.

``expire_ms`` (event time) forgets a bus so long after its last ping: its segment
ends there, and for its pairs this counts as an observation apart (it ends their
watches, a deadline at that very instant included).  A ping of the same instant
comes after the expiry.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.functions import alerts as A
from civicflow.functions.geo import chord_cell_size, haversine_m, unit_vector
from civicflow.operators.arrival import passing_arrivals
from civicflow.operators.chains import NEVER, chain_starts
from civicflow.operators.sequence import floor_div, with_lookahead, with_lookback
from civicflow.session import materialize

# Bunching radius, hold time and the detectors' watermark delay.
BUNCHING_RADIUS_M = 200.0
BUNCHING_HOLD_MS = 5 * 60 * 1000
WATERMARK_DELAY_MS = 10_000
OPEN_END = 2**62  # end of the last segment of a bus, unless positions expire
EXPIRY_SEQ = -(2**62)  # a position expires before any ping of that instant is applied
# Time granularity of the segment index.  A ping meets the segments of its
# bucket only, so the finest bucket should be a few ping intervals long.  Longer
# segments are indexed on coarser levels, each LEVEL_FACTOR times the one below,
# so a segment has LEVEL_FACTOR + 1 copies at most, whatever time it spans.
LOOKUP_BUCKET_MS = 30_000
LEVEL_FACTOR = 16
LEVELS = 12  # 30 s * 16^12 is beyond the range of a long in milliseconds


def prepare_pings(bus: DataFrame, missing: str = "zero") -> DataFrame:
    """(route_id, bus_id, t_ms, seq, lat, lon, timestamp) with the reference's
    null handling: a missing coordinate reads as 0.0 (``missing='zero'``) or
    the ping is dropped (``missing='drop'``)."""
    if missing not in ("zero", "drop"):
        raise ValueError(f"missing is 'zero' or 'drop', not {missing!r}")
    cols = ["route_id", "bus_id", "t_ms", "seq", "lat", "lon", "timestamp"]
    p = bus.select(*cols).filter(F.col("t_ms").isNotNull() & F.col("bus_id").isNotNull())
    if missing == "zero":
        return p.fillna(0.0, subset=["lat", "lon"])
    return p.dropna(subset=["lat", "lon"])


def segments(pings: DataFrame, bucket_ms: int = BUNCHING_HOLD_MS, expire_ms: int | None = None) -> DataFrame:
    """One row per ping: the interval ``[(t, seq), (t_next, seq_next))`` in which it
    is the latest position of its bus on its route, cut ``expire_ms`` after it."""
    nxt = with_lookahead(pings, ["route_id", "bus_id"], "t_ms", "seq", ["t_ms", "seq"],
                         bucket_ms=bucket_ms * 12)
    e_t = F.coalesce(F.col("t_ms_next"), F.lit(OPEN_END))
    e_seq = F.coalesce(F.col("seq_next"), F.lit(OPEN_END))
    if expire_ms is not None:
        expiry = F.col("t_ms") + F.lit(int(expire_ms))
        e_t, e_seq = F.least(e_t, expiry), F.when(expiry <= e_t, F.lit(EXPIRY_SEQ)).otherwise(e_seq)
    return nxt.select(
        "route_id", "bus_id", "lat", "lon", "timestamp",
        F.col("t_ms").alias("s_t"), F.col("seq").alias("s_seq"), e_t.alias("e_t"), e_seq.alias("e_seq"),
    )


def _cell_cols(lat: str, lon: str, cell: float) -> list:
    x, y, z = unit_vector(lat, lon)
    return [F.floor(c / F.lit(cell)).cast("long").alias(n) for c, n in ((x, "cx"), (y, "cy"), (z, "cz"))]


def _probe_cells(lat: str, lon: str, cell: float):
    """Array of the 8 cells a probe must look in.

    Per axis: the probe's own cell and the one neighbour on the side of the
    half-cell it lies in.  With an edge of twice the distance bound a nearer
    point can only be there, so 2 x 2 x 2 cells are enough (exact)."""
    base, side = [], []
    for c in unit_vector(lat, lon):
        q = c / F.lit(cell)
        fq = F.floor(q)
        base.append(fq.cast("long"))
        side.append(F.when(q - fq < F.lit(0.5), F.lit(-1)).otherwise(F.lit(1)).cast("long"))
    cells = []
    for i in range(8):
        cells.append(F.struct(*[
            (base[a] + side[a] if (i >> a) & 1 else base[a]).alias(n)
            for a, n in enumerate(("cx", "cy", "cz"))
        ]))
    return F.array(*cells)


def _level(s_t: str, e_t: str, max_t: int, bucket_ms: int):
    """Index level of a segment: the finest whose buckets it spans at most
    LEVEL_FACTOR of (open ends stop at the end of the data)."""
    span = F.least(F.col(e_t), F.lit(int(max_t))) - F.col(s_t)
    level = F.lit(LEVELS - 1)
    for k in reversed(range(LEVELS - 1)):
        level = F.when(span <= F.lit(bucket_ms * LEVEL_FACTOR ** (k + 1)), F.lit(k)).otherwise(level)
    return level


def used_levels(seg: DataFrame, max_t: int, bucket_ms: int = LOOKUP_BUCKET_MS) -> list[int]:
    """Levels that hold a segment (one number is collected)."""
    bits = seg.agg(F.bit_or(F.call_function("shiftleft", F.lit(1), _level("s_t", "e_t", max_t, bucket_ms)))).first()[0] or 0
    return [k for k in range(LEVELS) if bits >> k & 1]


def _bucket_of(t, level: int, bucket_ms: int):
    return floor_div(t, bucket_ms * LEVEL_FACTOR ** level)


def _replicate_by_bucket(seg: DataFrame, bucket_ms: int, max_t: int, levels: list[int],
                         s_t: str = "o_s_t", e_t: str = "o_e_t") -> DataFrame:
    """One copy of each segment per bucket of its level that it overlaps, as (lv, tb)."""
    end = F.least(F.col(e_t), F.lit(int(max_t)))

    def buckets(k: int):
        b0, b1 = (_bucket_of(c, k, bucket_ms) for c in (F.col(s_t), end))
        return F.sequence(b0, F.greatest(b0, b1))

    placed = seg.withColumn("lv", _level(s_t, e_t, max_t, bucket_ms))
    covered = F.lit(None).cast("array<bigint>")
    for k in levels:
        covered = F.when(F.col("lv") == k, buckets(k)).otherwise(covered)
    return placed.withColumn("tb", F.explode(covered))


def _probe_buckets(t: str, levels: list[int], bucket_ms: int):
    """The bucket of an instant on every level in use, to be inlined as (lv, tb)."""
    return F.inline(F.array(*[
        F.struct(F.lit(k).alias("lv"), _bucket_of(F.col(t), k, bucket_ms).alias("tb")) for k in levels or [0]
    ]))


def _other_side(seg: DataFrame, *extra) -> DataFrame:
    """Segments renamed as "the other bus" of an observation."""
    return seg.select(
        "route_id", F.col("bus_id").alias("o_bus"), F.col("lat").alias("o_lat"),
        F.col("lon").alias("o_lon"), *[F.col(c).alias("o_" + c) for c in ("s_t", "s_seq", "e_t", "e_seq")],
        *extra,
    )


def _covers(seg_prefix: str, t: str, seq: str):
    """Segment (s, e) covers the instant (t, seq): s < (t, seq) < e, in (t, seq) order."""
    s_t, s_seq = F.col(f"{seg_prefix}s_t"), F.col(f"{seg_prefix}s_seq")
    e_t, e_seq = F.col(f"{seg_prefix}e_t"), F.col(f"{seg_prefix}e_seq")
    tt, ss = F.col(t), F.col(seq)
    after_start = (s_t < tt) | ((s_t == tt) & (s_seq <= ss))
    before_end = (tt < e_t) | ((tt == e_t) & (ss < e_seq))
    return after_start & before_end


def _pair_cols(a: str, b: str) -> list:
    return [F.least(F.col(a), F.col(b)).alias("lo"), F.greatest(F.col(a), F.col(b)).alias("hi")]


def near_observations(
    seg: DataFrame,
    radius_m: float = BUNCHING_RADIUS_M,
    max_t: int = 0,
    bucket_ms: int = LOOKUP_BUCKET_MS,
) -> DataFrame:
    """Observations with ``distance < radius``, found through the grid join,
    each with the pair's *next* observation ``(next_t, next_seq)``.

    Every ping (= the start of its own segment) probes 8 cells of its
    neighbourhood on every time level in use; the other buses' segments are
    indexed in their cell and in every bucket of their level they overlap.  Exact: the grid edge is twice the chord
    bound of ``radius`` (see ``_probe_cells``).  The next observation of the
    pair is the earlier of the two buses' next pings (segment ends).  Rows carry
    the positions of both buses, and when that of ``lo`` was reported (``lo_t``).
    """
    cell = 2 * chord_cell_size(radius_m)
    levels = used_levels(seg, max_t, bucket_ms)
    probe = seg.select(
        "route_id", "bus_id", F.col("s_t").alias("t_ms"), F.col("s_seq").alias("seq"),
        "e_t", "e_seq", "lat", "lon",
        F.inline(_probe_cells("lat", "lon", cell)),
    ).select("*", _probe_buckets("t_ms", levels, bucket_ms))
    idx = _replicate_by_bucket(_other_side(seg, *_cell_cols("lat", "lon", cell)), bucket_ms, max_t, levels)
    # Both sides are replicated (8 cells / time buckets), which the planner's
    # size estimate does not see: never let it broadcast them.
    j = probe.hint("merge").join(idx.hint("merge"), ["route_id", "cx", "cy", "cz", "lv", "tb"]).filter(
        F.col("bus_id") != F.col("o_bus")
    )
    j = j.filter(_covers("o_", "t_ms", "seq"))
    own_first = (F.col("e_t") < F.col("o_e_t")) | ((F.col("e_t") == F.col("o_e_t")) & (F.col("e_seq") < F.col("o_e_seq")))
    own_is_lo = F.col("bus_id") < F.col("o_bus")
    return (
        j.withColumn("distance", haversine_m("lat", "lon", "o_lat", "o_lon"))
        .filter(F.col("distance") < F.lit(radius_m))
        .select(
            "route_id", *_pair_cols("bus_id", "o_bus"), "t_ms", "seq", "distance",
            F.when(own_first, F.col("e_t")).otherwise(F.col("o_e_t")).alias("next_t"),
            F.when(own_first, F.col("e_seq")).otherwise(F.col("o_e_seq")).alias("next_seq"),
            *[F.when(own_is_lo, F.col(own)).otherwise(F.col(other)).alias(name) for name, own, other in (
                ("lo_t", "t_ms", "o_s_t"), ("a_lat", "lat", "o_lat"), ("a_lon", "lon", "o_lon"),
                ("b_lat", "o_lat", "lat"), ("b_lon", "o_lon", "lon"))],
        )
    )


def with_islands(near: DataFrame, bucket_ms: int = 24 * 3_600_000) -> DataFrame:
    """Tag each near observation with its island: the (t, seq) of the first
    near observation after the pair's last far one.

    A far observation resets a pair completely, so islands can be scanned
    independently; a pair that is near for many separate episodes is spread
    over tasks instead of being scanned in one.  The island start is the row
    whose previous near observation's next observation is not this row (exact
    skew-safe look-back), carried forward within (pair, day) and across days
    through a small per-day table.
    """
    keys = ["route_id", "lo", "hi"]
    prev = with_lookback(near, keys, "t_ms", "seq", ["next_t", "next_seq"], 1, bucket_ms)
    starts = ~F.col("_has_lag1") | (F.col("next_t_lag1") != F.col("t_ms")) | (F.col("next_seq_lag1") != F.col("seq"))
    tagged = prev.withColumn("_start", F.when(starts, F.struct(F.col("t_ms").alias("t"), F.col("seq").alias("s")))) \
        .withColumn("_day", floor_div(F.col("t_ms"), bucket_ms))
    upto = Window.partitionBy(*keys, "_day").orderBy("t_ms", "seq").rowsBetween(Window.unboundedPreceding, 0)
    local = tagged.withColumn("_in_day", F.max("_start").over(upto))
    days = tagged.groupBy(*keys, "_day").agg(F.max("_start").alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carry = days.select(*keys, "_day", F.max("_last").over(before).alias("_carry"))
    island = F.coalesce(F.col("_in_day"), F.col("_carry"))
    out = local.join(carry, [*keys, "_day"], "left").withColumn("_island", island)
    return out.select(
        *near.columns, F.col("_island.t").alias("island_t"), F.col("_island.s").alias("island_seq")
    )


SCAN_OUT = T.StructType([
    T.StructField("route_id", T.StringType()),
    T.StructField("lo", T.StringType()),
    T.StructField("hi", T.StringType()),
    T.StructField("deadline", T.LongType()),
    T.StructField("due", T.LongType()),
])


def _scan_factory(hold_ms: int, horizon: int, once_per_episode: bool = False):
    """Per-partition scan over near observations sorted by (pair, island, t, seq).

    Between two near observations of a pair the state can only change at the
    observation right after the first one: if that is not the second near
    one, it is far (it ends the watch).  So the near observations and their
    ``next`` observation are the complete event sequence of the pair.
    ``once_per_episode``: after an alert, no new watch until a far observation.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        cur, deadline, pending_far, quiet = None, None, None, False
        cur_island = None

        def fire_before(key, t):
            nonlocal deadline, quiet
            if deadline is not None and t > deadline and deadline <= horizon:
                out.append((*key, deadline, deadline))
                deadline = None
                quiet = once_per_episode

        def close(key):
            nonlocal deadline
            if pending_far is not None:  # the pair's last near observation was followed by a far one
                fire_before(key, pending_far[0])
                deadline = None
            if deadline is not None and deadline <= horizon:
                out.append((*key, deadline, deadline))

        for pdf in batches:
            cols = [pdf[c].tolist() for c in
                    ("route_id", "lo", "hi", "island_t", "island_seq", "t_ms", "seq", "next_t", "next_seq")]
            for r, lo, hi, it, isq, t, sq, nt, ns in zip(*cols):
                key = (r, lo, hi)
                if (key, it, isq) != cur_island:
                    cur_island = (key, it, isq)
                    if cur is not None:
                        close(cur)
                    cur, deadline, pending_far, quiet = key, None, None, False
                elif pending_far is not None and pending_far != (t, sq):
                    # the observation after the previous near one was far
                    fire_before(key, pending_far[0])
                    deadline, quiet = None, False
                fire_before(key, t)
                if deadline is None and not quiet:
                    deadline = t + hold_ms
                pending_far = (nt, ns) if nt < OPEN_END else None
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=[f.name for f in SCAN_OUT.fields])
                out.clear()
        if cur is not None:
            close(cur)
        yield pd.DataFrame(out, columns=[f.name for f in SCAN_OUT.fields])

    return scan


def with_dues(near: DataFrame, pings: DataFrame, order: str, hold_ms: int, delay_ms: int, max_t: int) -> DataFrame:
    """Near observations with the event-time ``deadline`` of a watch they start and
    the position ``due`` up to which it lasts (``NEVER``: the input ends before)."""
    deadline = F.col("t_ms") + hold_ms
    if order == "event_time":
        never = deadline > max_t - delay_ms - 1
        return near.withColumns({"deadline": deadline, "due": F.when(never, F.lit(NEVER)).otherwise(deadline)})
    passed = pings.join(passing_arrivals(pings, hold_ms + delay_ms + 1), "t_ms")
    due = F.when(F.col("passed").isNull(), F.lit(NEVER)).otherwise(F.greatest("passed", "seq"))
    return near.join(passed.select("route_id", "seq", deadline.alias("deadline"), due.alias("due")), ["route_id", "seq"])


def fired_watches(near: DataFrame, once_per_episode: bool, reach: int | None) -> DataFrame:
    """Watches that reach their deadline: (route_id, lo, hi, deadline, due), from
    near observations with their island, ``deadline`` and ``due``."""
    keys = ["route_id", "lo", "hi", "island_t", "island_seq"]
    rows = near.select(*keys, F.col("t_ms").alias("at"), "seq", "due", F.col("deadline").alias("mark"), F.col("next_t").alias("next_at"))
    if once_per_episode:  # only the first watch of an island counts
        first = rows.where((F.col("at") == F.col("island_t")) & (F.col("seq") == F.col("island_seq")))
        tails = rows.groupBy(*keys).agg(F.max(F.struct("at", "seq", "next_at")).alias("tail"))
        starts = first.join(tails, keys).select(*keys, "due", "mark", F.lit(True).alias("last"), F.col("tail.next_at").alias("tail_next"))
    else:
        starts = chain_starts(rows if reach else materialize(rows, "bunching-watches"), keys, reach)
    # A far observation closes the island after its last row; it cancels what is not due before it.
    fires = (F.col("due") < NEVER) & (~F.col("last") | (F.col("tail_next") > F.col("due")))
    return starts.where(fires).select("route_id", "lo", "hi", F.col("mark").alias("deadline"), "due")


def bunching_deadlines(
    bus: DataFrame,
    radius_m: float = BUNCHING_RADIUS_M,
    hold_ms: int = BUNCHING_HOLD_MS,
    delay_ms: int = WATERMARK_DELAY_MS,
    missing: str = "zero",
    once_per_episode: bool = False,
    split_episodes: bool = True,
    order: str = "event_time",
    expire_ms: int | None = None,
) -> tuple[DataFrame, DataFrame | None, DataFrame, int, int]:
    """(deadlines as (route_id, lo, hi, deadline, due), near observations, segments,
    last position, width of the index buckets).  Positions are event times, or arrival numbers
    with ``order="arrival"``."""
    if order not in ("event_time", "arrival"):
        raise ValueError(f"order is 'event_time' or 'arrival', not {order!r}")
    if expire_ms is not None and (order == "arrival" or expire_ms <= 0):
        raise ValueError("expire_ms is a positive time and needs order='event_time'")
    pings = prepare_pings(bus, missing)
    max_t, max_seq = pings.agg(F.max("t_ms"), F.max("seq")).first()
    if max_t is None:
        empty = bus.sparkSession.createDataFrame([], SCAN_OUT)
        return empty, None, segments(pings), 0, LOOKUP_BUCKET_MS
    max_t = int(max_t)
    if order == "arrival":
        pings = pings.where(F.col("seq").isNotNull())
    # Segments feed the grid join (both sides) and the lookup of positions: computed
    # once and written under the shared checkpoint root.
    end = max_t if order == "event_time" else int(max_seq)
    ordered = pings if order == "event_time" else pings.withColumn("t_ms", F.col("seq"))
    seg = materialize(segments(ordered, hold_ms, expire_ms), "bunching-segments")
    bucket = LOOKUP_BUCKET_MS if order == "event_time" else arrival_bucket(seg)
    # The near set feeds the tagging and the lookup of positions: written once.
    observed = materialize(near_observations(seg, radius_m, end, bucket), "bunching-near")
    near = observed.drop("lo_t", "a_lat", "a_lon", "b_lat", "b_lon")
    if not split_episodes and order == "event_time":
        near = near.withColumn("island_t", F.lit(0).cast("long")).withColumn("island_seq", F.lit(0).cast("long"))
        keys = ["route_id", "lo", "hi", "island_t", "island_seq"]
        sorted_rows = near.repartition(*keys).sortWithinPartitions(*keys, "t_ms", "seq")
        fired = sorted_rows.mapInPandas(_scan_factory(hold_ms, max_t - delay_ms - 1, once_per_episode), SCAN_OUT)
        return fired, observed, seg, end, bucket
    day = 24 * 3_600_000 if order == "event_time" else 4096 * bucket
    near = with_islands(near, day)
    reach = hold_ms if order == "event_time" else None
    return fired_watches(with_dues(near, pings, order, hold_ms, delay_ms, max_t), once_per_episode, reach), observed, seg, end, bucket


def arrival_bucket(seg: DataFrame) -> int:
    """Width of the finest index bucket in arrival numbers: a few rows of one bus."""
    span = seg.where(F.col("e_t") < OPEN_END).agg(F.avg(F.col("e_t") - F.col("s_t"))).first()[0]
    return max(1, int(4 * (span or 1)))


def bus_bunching(
    bus: DataFrame,
    radius_m: float = BUNCHING_RADIUS_M,
    hold_ms: int = BUNCHING_HOLD_MS,
    delay_ms: int = WATERMARK_DELAY_MS,
    detected_at=None,
    once_per_episode: bool = False,
    split_episodes: bool = True,
    missing: str = "zero",
    order: str = "event_time",
    expire_ms: int | None = None,
) -> DataFrame:
    """Bus-bunching incident alerts (batch form).

    ``order``: rows in (event time, seq) order with canonical deadlines, or in
    ``arrival`` order (``seq``) with alerts when the watermark passes the
    deadline, as the reference processes them (see the module's text).

    ``missing``: pings without coordinates read as (0, 0), as in the reference,
    and so meet each other there; ``drop`` leaves them out, and a bus keeps its
    last known position (or has none).

    ``expire_ms``: a bus that has not reported for so long (event time) is
    forgotten until its next ping; by default positions never expire, as in the
    reference.

    By default a pair that stays near re-arms after each alert (an alert
    every 5 minutes, as in the reference); ``once_per_episode`` alerts once
    until the buses have been seen apart.  ``split_episodes`` spreads the
    episodes of a pair, and each episode, over tasks (costs a few shuffles of
    the near set, off = one scan per pair in event-time order)."""
    fired, near, seg, end, bucket = bunching_deadlines(bus, radius_m, hold_ms, delay_ms, missing,
                                                       once_per_episode=once_per_episode,
                                                       split_episodes=split_episodes, order=order, expire_ms=expire_ms)
    by_near = near is not None and order == "event_time"
    at = _last_near(near, seg, fired, hold_ms) if by_near else _as_of(seg, fired, end, bucket)
    dist = haversine_m("a_lat", "a_lon", "b_lat", "b_lon")
    desc = F.format_string(A.BUNCHING_TEMPLATE, F.col("lo"), F.col("hi"), F.col("route_id"), dist)
    return at.select(
        *A.alert_columns(A.BUS_BUNCHING, F.concat_ws(":", "lo", "hi"), F.lit(""), desc,
                         F.col("a_timestamp"), detected_at),
        F.col("deadline").alias("t_ms"),
        F.lit(None).cast("long").alias("seq"),
        "route_id", "lo", "hi", dist.alias("distance"),
    )


def _last_near(near: DataFrame, seg: DataFrame, fired: DataFrame, hold_ms: int) -> DataFrame:
    """Positions of both buses when a watch fires: those of the pair's observation
    that lasts beyond ``due``.  It is not before the watch began, ``hold_ms``
    earlier, so it lies in the bucket of ``due`` or in the one before.  The report
    of ``lo`` is the segment of that start that still lasts."""
    own = floor_div(F.col("due"), hold_ms)
    probe = fired.select("route_id", "lo", "hi", "deadline", "due", F.explode(F.array(own - 1, own)).alias("tb"))
    held = near.select("route_id", "lo", "hi", floor_div(F.col("t_ms"), hold_ms).alias("tb"), "t_ms", "next_t", "lo_t", "a_lat", "a_lon", "b_lat", "b_lon")
    hit = probe.join(held, ["route_id", "lo", "hi", "tb"]).where("t_ms <= due AND due < next_t").drop("tb", "t_ms", "next_t")
    report = seg.select("route_id", F.col("bus_id").alias("lo"), F.col("s_t").alias("lo_t"), "e_t", F.col("timestamp").alias("a_timestamp"))
    return hit.join(report, ["route_id", "lo", "lo_t"]).where("due < e_t").drop("lo_t", "e_t")


def _as_of(seg: DataFrame, fired: DataFrame, max_t: int, bucket_ms: int = LOOKUP_BUCKET_MS) -> DataFrame:
    """Positions of both buses when a watch fires (latest ping up to ``due``):
    one bucketed interval join for both sides, folded back to one row."""
    levels = used_levels(seg, max_t, bucket_ms)
    rep = _replicate_by_bucket(
        seg.select("route_id", "bus_id", "s_t", "e_t", "lat", "lon", "timestamp"),
        bucket_ms, max_t, levels, s_t="s_t", e_t="e_t",
    )
    sides = F.array(F.struct(F.lit("a").alias("side"), F.col("lo").alias("bus_id")),
                    F.struct(F.lit("b").alias("side"), F.col("hi").alias("bus_id")))
    probe = fired.select("route_id", "lo", "hi", "deadline", "due", F.inline(sides)).select(
        "*", _probe_buckets("due", levels, bucket_ms)
    )
    hit = probe.join(rep, ["route_id", "bus_id", "lv", "tb"]).filter(
        (F.col("s_t") <= F.col("due")) & (F.col("due") < F.col("e_t"))
    )
    pick = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    return hit.groupBy("route_id", "lo", "hi", "deadline", "due").agg(
        pick("a", "lat").alias("a_lat"), pick("a", "lon").alias("a_lon"),
        pick("a", "timestamp").alias("a_timestamp"),
        pick("b", "lat").alias("b_lat"), pick("b", "lon").alias("b_lon"),
    )
