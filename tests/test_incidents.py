from conftest import frame

from civicflow.operators import incidents


def test_aqi_emergency_threshold(spark):
    rows = [{"sec": i, "sensor_id": "S1", "zone": "Z", "aqi": a} for i, a in enumerate([300, 301, None, 400, 400])]
    df = frame(spark, rows, "sensor_id string, zone string, aqi int")
    out = incidents.aqi_emergency(df).orderBy("seq").collect()
    assert [r.description for r in out] == [
        "AQI reading of 301 exceeds emergency threshold of 300 for sensor S1",
        "AQI reading of 400 exceeds emergency threshold of 300 for sensor S1",
        "AQI reading of 400 exceeds emergency threshold of 300 for sensor S1",
    ]
    assert {r.incidentType for r in out} == {"AQI_EMERGENCY"}


def _traffic(spark, waits_by_junction):
    rows = []
    for j, waits in waits_by_junction.items():
        for i, w in enumerate(waits):
            rows.append({"sec": 10 * i, "junction_id": j, "zone": "Z",
                         "avg_wait_sec": None if w is None else float(w)})
    return frame(spark, rows, "junction_id string, zone string, avg_wait_sec double")


def test_gridlock_fires_once_per_run(spark):
    df = _traffic(spark, {"J1": [181, 190, 200, 210, 180, 185, 185, 185], "J2": [200, 200, None, 200, 200]})
    out = incidents.gridlock(df).orderBy("t_ms").collect()
    assert [(r.entityId, r.t_ms % 100000) for r in out] == [("J1", 20000), ("J1", 70000)]
    assert out[0].description == "Junction J1 avg wait 200.0s exceeded 180s for 3 consecutive cycles in zone Z"


def test_gridlock_runs_cross_time_buckets(spark):
    # Rows 40 minutes apart: every run spans several look-back buckets.
    from civicflow.operators.runs import consecutive_runs, gridlock_breach

    waits = [200, 200, 100, 200, 200, 200, 200, 200, 50, 190, 190, 190]
    rows = [{"sec": 2400 * i, "junction_id": "J", "zone": "Z", "avg_wait_sec": float(w)} for i, w in enumerate(waits)]
    df = frame(spark, rows, "junction_id string, zone string, avg_wait_sec double")
    out = consecutive_runs(df, "junction_id", gridlock_breach(), 3).orderBy("seq").collect()
    assert [r.seq for r in out] == [6, 12]


def test_gridlock_description_rounds_half_up(spark):
    df = _traffic(spark, {"J": [210.25, 210.25, 210.25]})
    (r,) = incidents.gridlock(df).collect()
    assert "avg wait 210.3s" in r.description


def test_gridlock_event_time_vs_arrival_order(spark):
    # (t seconds, arrival seq, wait): the 100 s reading arrives late (seq 3, t 10)
    rows = [(0, 1, 200.0), (30, 2, 200.0), (10, 3, 100.0), (20, 4, 200.0), (40, 5, 200.0)]
    df = spark.createDataFrame(
        [(s, 1704067200000 + t * 1000, f"t{t}", "J", "Z", w) for t, s, w in rows],
        "seq long, t_ms long, timestamp string, junction_id string, zone string, avg_wait_sec double",
    )
    by_time = [r.seq for r in incidents.gridlock(df, order="event_time").collect()]
    by_arrival = [r.seq for r in incidents.gridlock(df, order="arrival").collect()]
    assert by_time == [5]   # event order: 200, 100, 200, 200, 200
    assert by_arrival == []  # arrival order: 200, 200, 100, 200, 200
