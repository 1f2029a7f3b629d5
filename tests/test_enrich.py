from civicflow.operators.enrich import enrich


def test_last_duplicate_wins_and_misses_drop(spark):
    lookup = spark.createDataFrame(
        [("R-1", "first", "T1", 1), ("R-2", "two", "T2", 2), ("R-1", "second", "T3", 3)],
        "route_id string, route_name string, terminal string, line long",
    )
    bus = spark.createDataFrame([("B1", "R-1", "stale"), ("B2", "R-6", "x")],
                                "bus_id string, route_id string, route_name string")
    out = enrich(bus, lookup.select("route_id", "route_name", "terminal", "line"), on="route_id", order="line")
    rows = [r.asDict() for r in out.collect()]
    assert rows == [{"route_id": "R-1", "bus_id": "B1", "route_name": "second", "terminal": "T3"}]


def test_lookup_csv_last_line_wins(spark, tmp_path):
    from civicflow import schemas
    from civicflow.sources.files import read_lookup_csv

    p = tmp_path / "routes.csv"
    p.write_text("route_id,route_name,terminal,scheduled_arrival_time\n"
                 "R-1,Old,T1,10:30:00\nR-2,Two,T2,10:45:00\nR-1,New,T3,11:00:00\n")
    got = {r.route_id: r.route_name for r in read_lookup_csv(spark, str(p), schemas.ROUTE_SCHEDULE, "route_id").collect()}
    assert got == {"R-1": "New", "R-2": "Two"}


def test_jsonl_batch_and_stream_agree(spark, tmp_path):
    import json

    from civicflow import schemas
    from civicflow.sources.files import read_jsonl
    from civicflow.streaming.io import run_to_completion, write_stream

    d = tmp_path / "in"
    d.mkdir()
    recs = [{"sensor_id": "S", "zone": "Z", "pm25": 1.0, "pm10": 2.0, "aqi": i, "timestamp": "2024-01-01T00:00:0%dZ" % i}
            for i in range(5)]
    (d / "a.json").write_text("\n".join(json.dumps(r) for r in recs))
    batch = read_jsonl(spark, str(d), schemas.AIR_QUALITY)
    assert sorted(r.aqi for r in batch.collect()) == [0, 1, 2, 3, 4]
    stream = read_jsonl(spark, str(d), schemas.AIR_QUALITY, stream=True, max_files_per_trigger=1)
    out = str(tmp_path / "out")
    run_to_completion(write_stream(stream, "parquet", str(tmp_path / "ck"), path=out))
    assert sorted(r.t_ms for r in spark.read.parquet(out).collect()) == sorted(r.t_ms for r in batch.collect())


def test_the_last_line_of_the_last_file_wins(spark, tmp_path):
    """Several files, one of them read in several splits."""
    from civicflow.sources.files import read_lookup_csv

    rows = {"a.csv": [(i % 50, f"a{i}") for i in range(400)], "b.csv": [(i % 40, f"b{i}") for i in range(3000)], "c.csv": [(7, "c0"), (7, "c1")]}
    for name, lines in rows.items():
        (tmp_path / name).write_text("k,v\n" + "".join(f"{k},{v}\n" for k, v in lines))
    want = {}
    for name in sorted(rows):
        want.update(rows[name])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        lookup = read_lookup_csv(spark, str(tmp_path), "k int, v string", key="k")
        assert spark.read.option("header", "true").schema("k int, v string").csv(str(tmp_path)).rdd.getNumPartitions() > 5
        assert dict(map(tuple, lookup.collect())) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
