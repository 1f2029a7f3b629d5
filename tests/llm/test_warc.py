import base64
import gzip
import hashlib
import io
import json
import random

import pytest

from civicflow.llm import warc
from civicflow.llm.common import open_store
from civicflow.session import scratch_path

SCHEMA = "page_id long, url string, html string, extra int"


def expected(rows, least=0):
    data = [(i, (h or "").encode()) for i, _, h, *_ in rows]
    first = {}
    for i, d in data:
        if len(d) >= least:
            key = (i is None, i if i is not None else 0)
            first[d] = min(first.get(d, key), key)
    out, used = [], set()
    for i, d in data:
        digest = base64.b32encode(hashlib.sha1(d).digest()).decode()
        is_first = len(d) < least or (first[d] == (i is None, i or 0) and d not in used)
        if is_first and len(d) >= least:
            used.add(d)
        to = None if is_first or first[d][0] else first[d][1]
        out.append((i, len(d), digest, "response" if is_first else "revisit", to))
    return sorted(map(str, out))


ROWS = [(1, "http://a/", "same", 0), (0, "http://b/ x\r\nWARC-Type: y", "same", 0), (2, None, None, 0), (3, "http://c/é", "", 0), (4, "u", "\r\n\r\nWARC/1.1\r\n", 0),
        (None, "u", "same", 0), (None, "u", "only null ids", 0), (None, "u", "only null ids", 0), (7, "u", "twin", 0), (7, "u", "twin", 0), (8, "u", "x" * 300000, 0),
        (9, "u", "ünïcode ✓", 0)]


@pytest.mark.parametrize("least,size", [(0, 64 << 20), (0, 50), (5, 2000)])
def test_round_trip_against_brute_force(spark, least, size):
    rng = random.Random(2)
    rows = ROWS + [(100 + i, "http://h/", rng.choice(["hot", "p%d" % i]), 1) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    index = warc.archive(df, least_bytes=least, archive_bytes=size)
    got = warc.read(index).collect()
    assert sorted(str((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])) for r in got) == expected(rows, least)
    texts = {hashlib.sha1((h or "").encode()).digest(): (h or "").encode() for _, _, h, _ in rows}
    for r in got:
        if r["record_type"] == "response":
            assert bytes(r["payload"]) == texts[base64.b32decode(r["payload_digest"])]
    if size < 1000:
        assert index.select("file").distinct().count() > 10


def test_raw_archives_are_one_member_and_new_ones_one_per_record(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).coalesce(1)
    folder = scratch_path(spark, "w")
    raw = warc.write_monolithic(df, folder)
    source, = {r["file"] for r in raw.collect()}
    store, path = open_store(source)
    data = store.open_input_file(path).read()
    assert len(list(warc.records_of([gzip.decompress(data)]))) == len(ROWS)
    kept = raw.selectExpr("file", "row", "cast(null as long) refers_id", "cast(null as long) refers_row")
    same = warc.normalise(kept, folder).collect()
    store, path = open_store(same[0]["file"])
    assert gzip.decompress(store.open_input_file(path).read()) == gzip.decompress(data)
    index = warc.normalise(warc.with_responses(raw), scratch_path(spark, "w")).collect()
    store, path = open_store(index[0]["file"])
    new = store.open_input_file(path).read()
    lines = [json.loads(x) for x in store.open_input_file(path.replace(".warc.gz", ".index.jsonl")).read().splitlines()]
    assert sorted(x["offset"] for x in lines) == sorted(r["offset"] for r in index)
    for x in lines:
        headers, _, _ = next(warc.records_of([gzip.decompress(new[x["offset"]:x["offset"] + x["length"]])]))
        assert headers["warc-record-id"] == x["record_id"] and headers["warc-type"] == x["record_type"]


def test_reader_takes_any_chunks_and_reports_cut_archives():
    whole = b"".join(warc.response_bytes(i, i, "u", b"payload" * i) for i in range(5))
    for step in (1, 7, 10**6):
        assert len(list(warc.records_of(whole[i:i + step] for i in range(0, len(whole), step)))) == 5
    with pytest.raises(ValueError):
        list(warc.records_of([whole[:-10]]))
    two = gzip.compress(whole) + gzip.compress(whole)
    assert b"".join(warc.inflate(io.BytesIO(two), 13)) == whole * 2


def test_empty_table(spark):
    assert warc.archived_pages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_against_brute_force(spark, sf):
    from civicflow.llm.catalog import QUERIES

    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = QUERIES["op5_warc"](spark, sf).collect()
    assert sorted(str(tuple(r)) for r in got) == expected(rows)


def test_cut_archives_are_errors():
    """A stream without its checksum, without its end or cut between two of its
    members is found; whole members end anywhere."""
    record = warc.response_bytes(1, 1, "u", b"x" * 500)
    one = gzip.compress(record * 3)
    both = one + gzip.compress(record)
    count = lambda data, size=64: len(list(warc.records_of(warc.inflate(io.BytesIO(data), size))))
    assert [count(one), count(both), count(both, 1), count(b"")] == [3, 4, 4, 0]
    for cut in [1, 4, 8, 9, 12, len(one) - 5]:
        for data in (one[:-cut], one + one[:-cut]):
            with pytest.raises(ValueError, match="ends within"):
                count(data)


def test_folders_get_the_scheme_spark_takes_for_them(spark, tmp_path):
    from civicflow.llm import common

    assert common.shared_uri(spark, str(tmp_path)) == f"file:{tmp_path}" == common.shared_uri(spark, f"file://{tmp_path}")
    assert common.store_uri("s3a://b/x") == "s3://b/x" and common.store_uri("file:/x") == "file:///x"
    for wrong in (str(tmp_path), "x/y:z", "dbfs:/x", "wasbs://c@a/x"):
        with pytest.raises(ValueError):
            common.open_store(wrong)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.defaultFS", "viewfs:///")
    try:
        with pytest.raises(Exception):  # no such store here: refused on the driver, nothing goes to the local disk
            warc.write_monolithic(spark.createDataFrame(ROWS, SCHEMA), str(tmp_path / "archives"))
    finally:
        conf.set("fs.defaultFS", "file:///")
    assert not (tmp_path / "archives").exists()
