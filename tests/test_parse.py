import pytest

from civicflow import schemas
from civicflow.functions.jsonio import parse_records, split_quarantine, to_json_value
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("aqi", T.IntegerType()), T.StructField("timestamp", T.StringType())])
VALUES = [
    '{"aqi":310,"timestamp":"2026-07-31T10:30:00.123456Z"}',
    '{"aqi":"310","timestamp":"2026-07-31T10:30:00Z"}',
    "not json",
    '{"aqi":null,"timestamp":"2026-07-31T10:30:00Z"}',
    '{"aqi":310,"timestamp":"bad"}',
]


def _df(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "offset long, value string")


def test_permissive(spark):
    out = parse_records(_df(spark), SCHEMA, mode="permissive", keep=("offset",)).orderBy("offset").collect()
    assert [r.aqi for r in out] == [310, None, None, None, 310]
    assert out[0].t_ms == 1785493800123  # floored to the millisecond
    assert out[4].event_time is None


def test_quarantine(spark):
    out = parse_records(_df(spark), SCHEMA, mode="quarantine", keep=("offset",))
    got = {r.offset: r._error for r in out.collect()}
    assert got == {0: None, 1: "malformed record", 2: "malformed record", 3: None, 4: "bad event time"}
    clean, bad = split_quarantine(out)
    assert clean.count() == 2 and bad.count() == 3


def test_strict_fails(spark):
    with pytest.raises(Exception):
        parse_records(_df(spark), SCHEMA, mode="strict").collect()


def test_json_keeps_nulls(spark):
    df = spark.createDataFrame([("A", None)], schemas.INCIDENT.fields[0].name + " string, zone string")
    (v,) = df.select(to_json_value().alias("v")).first()
    assert v == '{"incidentType":"A","zone":null}'


def test_quoted_numbers_can_be_coerced(spark):
    out = parse_records(_df(spark), SCHEMA, mode="quarantine", keep=("offset",), coerce_quoted_numbers=True)
    got = {r.offset: (r.aqi, r._error) for r in out.collect()}
    assert got[1] == (310, None)
    assert got[2] == (None, "malformed record")


def test_quoted_text_that_is_no_number_is_quarantined(spark):
    from civicflow import schemas
    from civicflow.functions.jsonio import parse_records

    at = '"timestamp": "2024-01-01T00:00:00.000Z"'
    df = spark.createDataFrame([('{"aqi": "abc", %s}' % at,), ('{"aqi": "310", %s}' % at,), ('{"aqi": null, %s}' % at,)], "value string")
    rows = parse_records(df, schemas.BY_KIND["air_quality"], mode="quarantine", coerce_quoted_numbers=True).collect()
    assert [(r["aqi"], r["_error"]) for r in rows] == [(None, "malformed record"), (310, None), (None, None)]


def test_strict_refuses_a_bad_event_time(spark):
    import pytest

    from civicflow import schemas
    from civicflow.functions.jsonio import parse_records

    df = spark.createDataFrame([('{"aqi": 1}',)], "value string")
    with pytest.raises(Exception, match="bad event time"):
        parse_records(df, schemas.BY_KIND["air_quality"], mode="strict").collect()


def test_unknown_fields(spark):
    values = ['{"aqi":1,"timestamp":"2026-07-31T10:30:00Z","unit":"ug","x":null}', '{"aqi":1,"timestamp":"2026-07-31T10:30:00Z"}', "not json", None, '{"b":1,"aqi":"x"}']
    df = spark.createDataFrame(list(enumerate(values)), "offset long, value string")
    got = {r.offset: r._error for r in parse_records(df, SCHEMA, mode="quarantine", keep=("offset",)).collect()}
    assert got == {0: "unknown fields: unit,x", 1: None, 2: "malformed record", 3: "null record", 4: "malformed record"}
    got = parse_records(df, SCHEMA, mode="quarantine", keep=("offset",), unknown="ignore")
    assert got.where("offset = 0 AND _error IS NULL AND aqi = 1").count() == 1
    one = df.where("offset = 0")
    with pytest.raises(Exception, match="unknown fields: unit,x"):
        parse_records(one, SCHEMA, mode="strict").collect()
    assert parse_records(one, SCHEMA, mode="strict", unknown="ignore").collect()[0].aqi == 1
    assert parse_records(df.where("offset = 1"), SCHEMA, mode="strict").collect()[0].aqi == 1
    assert parse_records(one, SCHEMA, coerce_quoted_numbers=True, mode="quarantine").collect()[0]._error == "unknown fields: unit,x"


def test_arrival_numbers_over_partitions(spark):
    from civicflow.streaming.jobs import arrival_seq, typed

    value = '{"sensor_id":"s","zone":"z","pm25":1.0,"pm10":1.0,"aqi":5,"timestamp":"2026-07-31T10:30:00Z"}'
    rows = [("t", p, o, value) for p in range(3) for o in (0, 1, 7, 1 << 40)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, value string")
    got = typed(df, "air_quality")
    assert got.select("seq").distinct().count() == len(rows)
    placed = df.withColumn("seq", arrival_seq(df.columns)).collect()
    assert all((a.seq < b.seq) == (a.offset < b.offset) for a in placed for b in placed if a.partition == b.partition)
    assert [r.seq for r in typed(df.drop("partition").limit(1), "air_quality").collect()] == [0]
    with pytest.raises(Exception, match="too large"):
        typed(spark.createDataFrame([("t", 1 << 16, 1, value)], df.schema), "air_quality").collect()
