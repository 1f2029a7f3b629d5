import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

EPOCH_MS = 1704067200000  # 2024-01-01T00:00:00Z


@pytest.fixture(scope="session")
def spark():
    from civicflow.session import build_session

    ckpt = tempfile.mkdtemp(prefix="civicflow-test-ckpt-")
    s = build_session(
        "local[4]", app_name="civicflow-tests", shuffle_partitions=4,
        extra={"spark.checkpoint.dir": ckpt, "spark.default.parallelism": "4"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def iso(ms: int) -> str:
    import datetime as dt

    d = dt.datetime.fromtimestamp(ms / 1000, tz=dt.timezone.utc)
    return d.strftime("%Y-%m-%dT%H:%M:%S.") + f"{ms % 1000:03d}Z"


def frame(spark, rows, schema):
    """Rows with ``sec`` (seconds after the epoch of the fixtures) -> a DataFrame
    with seq, t_ms, event_time, timestamp."""
    from pyspark.sql import functions as F

    out = []
    for i, r in enumerate(rows):
        r = dict(r)
        ms = EPOCH_MS + int(round(r.pop("sec") * 1000))
        out.append({"seq": i + 1, "t_ms": ms, "timestamp": iso(ms), **r})
    df = spark.createDataFrame(out, schema="seq long, t_ms long, timestamp string, " + schema)
    return df.withColumn("event_time", F.timestamp_millis("t_ms"))
