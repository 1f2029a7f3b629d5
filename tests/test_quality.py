import json

from civicflow.operators import quality


def _records(spark, items):
    rows = [(topic, i, json.dumps(rec)) for i, (topic, rec) in enumerate(items)]
    return spark.createDataFrame(rows, "topic string, offset long, value string")


CASES = [
    ("air_quality", {"sensor_id": "A", "aqi": None}, "Null AQI"),
    ("air_quality", {"sensor_id": "A", "aqi": 501}, "AQI Out of Range"),
    ("air_quality", {"sensor_id": "A", "aqi": 500}, None),
    ("air_quality", {"sensor_id": "A", "aqi": -5}, None),
    ("air_quality", {"sensor_id": "A"}, "Null AQI"),
    ("bus_gps", {"bus_id": "B", "lat": None, "lon": 200}, "Missing Coordinates"),
    ("bus_gps", {"bus_id": "B", "lat": 95, "lon": 200}, "Invalid Latitude"),
    ("bus_gps", {"bus_id": "B", "lat": 90, "lon": -180}, None),
    ("bus_gps", {"bus_id": "B", "lat": 10, "lon": -180.5}, "Invalid Longitude"),
    ("traffic_signals", {"junction_id": "J", "aqi": None}, None),
]


def test_first_match_rules(spark):
    df = _records(spark, [(t, r) for t, r, _ in CASES])
    got = {r.offset: r.error_reason for r in quality.classify(df).collect()}
    assert [got[i] for i in range(len(CASES))] == [e for _, _, e in CASES]


def test_nan_is_not_out_of_range_but_is_invalid_latitude(spark):
    rows = [("air_quality", 0, '{"aqi": NaN}'), ("bus_gps", 1, '{"lat": NaN, "lon": 1.0}')]
    df = spark.createDataFrame(rows, "topic string, offset long, value string")
    got = {r.offset: r.error_reason for r in quality.classify(df).collect()}
    assert got == {0: None, 1: "Invalid Latitude"}


def test_dead_letters_are_copies_and_envelope_keeps_nulls(spark):
    df = _records(spark, [(t, r) for t, r, _ in CASES])
    classified = quality.classify(df)
    clean, dead = quality.split(classified)
    assert clean.count() + dead.count() == classified.count() == len(CASES)
    env = quality.envelope(dead).filter("offset = 0").select("dlq_value").first()[0]
    msg = json.loads(env)
    assert msg == {"source_topic": "air_quality", "error_reason": "Null AQI",
                   "original_record": {"sensor_id": "A", "aqi": None}}
    assert '"aqi":null' in env


def test_report_counts_and_total(spark):
    msgs = spark.createDataFrame(
        [(json.dumps({"error_reason": "a"}),), (json.dumps({"error_reason": "a"}),), (json.dumps({"x": 1}),)],
        "value string",
    )
    got = {(r.error_type, r.message_count, r.is_total) for r in quality.report_from_messages(msgs).collect()}
    assert got == {("a", 2, False), ("Unknown Error", 1, False), ("Total DLQ Messages", 3, True)}


def test_bounded_report_over_a_dead_letter_topic(spark, tmp_path):
    from civicflow.streaming.jobs import dead_letter_report

    rows = [("dlq", i, json.dumps({"error_reason": r})) for i, r in enumerate(["Null AQI", "Null AQI", "Invalid Latitude"])]
    rows.append(("other", 9, json.dumps({"error_reason": "x"})))
    spark.createDataFrame(rows, "topic string, offset long, value string").write.json(str(tmp_path / "t"))
    got = {(r.error_type, r.message_count) for r in dead_letter_report(spark, "files", "dlq", str(tmp_path / "t")).collect()}
    assert got == {("Null AQI", 2), ("Invalid Latitude", 1), ("Total DLQ Messages", 3)}


def test_text_that_is_not_json_is_malformed_and_survives(spark):
    rows = [("air_quality", 0, "not json"), ("air_quality", 1, '{"aqi": "310"}'), ("bus_gps", 2, '{"lat": 1,'),
            ("bus_gps", 3, None), ("bus_gps", 4, '{"lat": 1, "lon": 2}')]
    df = spark.createDataFrame(rows, "topic string, offset long, value string")
    classified = quality.classify(df)
    got = {r["offset"]: r["error_reason"] for r in classified.collect()}
    assert got == {0: quality.MALFORMED, 1: quality.NULL_AQI, 2: quality.MALFORMED, 3: quality.MALFORMED, 4: None}
    env = {r["offset"]: json.loads(r["dlq_value"]) for r in quality.envelope(quality.dead_letters(classified)).collect()}
    assert env[0]["original_record"] == "not json" and env[2]["original_record"] == '{"lat": 1,'
    assert env[1]["original_record"] == {"aqi": "310"}
    messages = quality.envelope(quality.dead_letters(classified)).selectExpr("dlq_value AS value")
    report = {r["error_type"]: r["message_count"] for r in quality.report_from_messages(messages).collect()}
    assert report == {quality.MALFORMED: 3, quality.NULL_AQI: 1, "Total DLQ Messages": 4}


def test_values_that_are_no_object_are_malformed(spark):
    from civicflow.operators import quality as q

    values = ["", " ", "null", "5", "[1]", '"x"', "{", None, ' \n{"aqi": 5}', '{"aqi": null}', '[{"aqi": 5}]', "true"]
    df = spark.createDataFrame([("air_quality", i, v) for i, v in enumerate(values)], "topic string, offset long, value string")
    got = {r.offset: r.error_reason for r in q.classify(df).collect()}
    assert got == {i: {8: None, 9: q.NULL_AQI}.get(i, q.MALFORMED) for i in range(len(values))}
    assert q.envelope(q.dead_letters(q.classify(df))).where("dlq_value IS NULL").count() == 0
