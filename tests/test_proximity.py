"""Bus-bunching micro cases with exact expected alerts."""

import pytest
from conftest import EPOCH_MS, frame

from civicflow.operators.proximity import bus_bunching

BASE = (28.4, 77.0)
NEAR = (28.401, 77.0)   # 111.19 m north of A
FAR = (28.402, 77.0)    # 222.39 m north of A
HORIZON_PASSER = {"bus": "Z", "route": "R-9", "pos": BASE, "sec": 2000}


def _pings(spark, pings):
    rows = []
    for p in pings:
        lat, lon = p["pos"]
        rows.append({"sec": p["sec"], "route_id": p.get("route", "R-1"), "bus_id": p["bus"],
                     "lat": lat, "lon": lon})
    return frame(spark, rows, "route_id string, bus_id string, lat double, lon double")


def _alerts(spark, pings):
    out = bus_bunching(_pings(spark, pings)).collect()
    return sorted((r.entityId, (r.t_ms - EPOCH_MS) / 1000, r.sourceTimestamp) for r in out)


def p(bus, sec, pos, route="R-1"):
    return {"bus": bus, "sec": sec, "pos": pos, "route": route}


def test_case_a_fires_at_deadline_with_positions_as_of_then(spark):
    got = _alerts(spark, [p("A", 0, BASE), p("B", 10, NEAR), p("A", 200, BASE), p("A", 321, BASE)])
    assert got == [("A:B", 310.0, "2024-01-01T00:03:20.000Z")]


def test_case_a_prime_needs_horizon(spark):
    got = _alerts(spark, [p("A", 0, BASE), p("B", 10, NEAR), p("A", 200, BASE), p("A", 320, BASE)])
    assert got == []


def test_case_b_far_exactly_at_deadline_cancels(spark):
    got = _alerts(spark, [p("A", 0, BASE), p("B", 10, NEAR), p("B", 310, FAR), p("Z", 2000, BASE, "R-9")])
    assert got == []


def test_case_c_far_after_deadline_does_not_cancel(spark):
    got = _alerts(spark, [p("A", 0, BASE), p("B", 10, NEAR), p("B", 311, FAR), p("Z", 2000, BASE, "R-9")])
    assert [g[:2] for g in got] == [("A:B", 310.0)]


def test_case_d_rearms_after_firing(spark):
    pings = []
    for t in range(0, 1021, 60):
        pings += [p("A", t, BASE), p("B", t, NEAR)]
    got = _alerts(spark, pings)
    assert [g[1] for g in got] == [300.0, 660.0]


def test_case_d_once_per_episode(spark):
    pings = []
    for t in range(0, 1021, 60):
        pings += [p("A", t, BASE), p("B", t, NEAR)]
    pings += [p("B", 1100, FAR), p("B", 1160, NEAR), p("A", 1470, BASE), p("Z", 3000, BASE, "R-9")]
    out = bus_bunching(_pings(spark, pings), once_per_episode=True).collect()
    # one alert for the first episode, a new one after the buses were seen apart
    assert sorted((r.t_ms - EPOCH_MS) / 1000 for r in out) == [300.0, 1460.0]


def test_case_e_three_mutually_near_buses(spark):
    pings = []
    for t in (0, 100, 200, 320):
        pings += [p("A", t, BASE), p("B", t, NEAR), p("C", t, (28.4, 77.001))]
    got = _alerts(spark, pings)
    assert sorted(g[0] for g in got) == ["A:B", "A:C", "B:C"]


def test_case_f_null_latitude_reads_as_zero(spark):
    rows = [{"sec": 0, "route_id": "R-1", "bus_id": "A", "lat": BASE[0], "lon": BASE[1]},
            {"sec": 10, "route_id": "R-1", "bus_id": "B", "lat": None, "lon": BASE[1]},
            {"sec": 2000, "route_id": "R-9", "bus_id": "Z", "lat": BASE[0], "lon": BASE[1]}]
    df = frame(spark, rows, "route_id string, bus_id string, lat double, lon double")
    assert bus_bunching(df).count() == 0


def test_other_route_never_pairs(spark):
    got = _alerts(spark, [p("A", 0, BASE), p("B", 10, NEAR, "R-2"), p("A", 400, BASE), p("B", 400, NEAR, "R-2")])
    assert got == []


@pytest.mark.parametrize("lat", [-89.9995, 0.0, 89.9995])
def test_grid_is_exact_near_poles_and_cell_edges(spark, lat):
    # Buses 150 m apart across the antimeridian / near a pole must still pair.
    a = (lat, 179.9999)
    b = (lat + (0.00134 if lat < 89 else -0.00134), -179.9999)
    pings = [p("A", 0, a), p("B", 1, b), p("A", 400, a), p("B", 400, b)]
    got = _alerts(spark, pings)
    assert [g[1] for g in got] == [301.0]


def test_distance_helpers(spark):
    from pyspark.sql import functions as F

    from civicflow.functions.geo import flat_earth_m, haversine_m

    df = spark.createDataFrame([(28.4, 77.0, 28.401, 77.0), (28.4, 77.0, 28.4, 77.001)], "a double, b double, c double, d double")
    got = df.select(haversine_m("a", "b", "c", "d").alias("h"), flat_earth_m("a", "b", "c", "d").alias("f")).collect()
    assert abs(got[0].h - 111.195) < 0.01 and abs(got[0].f - 111.32) < 0.01
    assert abs(got[1].f - 111.32 * 0.88) < 0.01  # the helper's fixed longitude factor
    assert abs(got[1].h - 97.8) < 0.1


YEAR = 365 * 86_400


def _index_rows(spark, pings):
    from civicflow.operators import proximity as P

    prepared = P.prepare_pings(_pings(spark, pings))
    max_t = max(r.t_ms for r in prepared.collect())
    seg = P.segments(prepared)
    levels = P.used_levels(seg, max_t)
    return P._replicate_by_bucket(P._other_side(seg), P.LOOKUP_BUCKET_MS, max_t, levels).count()


def test_index_is_bounded_by_pings_not_by_time(spark):
    from civicflow.operators.proximity import LEVEL_FACTOR

    pings = [p("A", 0, BASE), p("B", 10, NEAR), p("A", YEAR, BASE)]
    assert _index_rows(spark, pings) <= len(pings) * (LEVEL_FACTOR + 1)
    epoch_zero = [p("A", -EPOCH_MS / 1000, BASE), *pings]
    assert _index_rows(spark, epoch_zero) <= len(epoch_zero) * (LEVEL_FACTOR + 1)


def test_a_bus_silent_for_a_year_still_pairs(spark):
    got = _alerts(spark, [p("A", 0, BASE), p("B", YEAR, NEAR), p("B", YEAR + 100, NEAR), p("Z", YEAR + 2000, BASE, "R-9")])
    assert [g[:2] for g in got] == [("A:B", YEAR + 300.0)]


def test_pings_without_coordinates_may_be_left_out(spark):
    nowhere = [p(b, s, (None, None)) for s in range(0, 2000, 100) for b in ("A", "B", "C")]
    assert bus_bunching(_pings(spark, nowhere)).count() > 0  # all at (0, 0)
    assert bus_bunching(_pings(spark, nowhere), missing="drop").count() == 0
    with pytest.raises(ValueError):
        bus_bunching(_pings(spark, nowhere), missing="other")
