"""Results do not depend on input order or partitioning (event-time ordering)."""

from pyspark.sql import functions as F

from civicflow.operators import incidents
from civicflow.operators.proximity import bus_bunching
from civicflow.sources import telemetry as tv

SF = "/root/testdata/sf0.001"


def _alerts(df):
    return sorted((r.entityId, r.t_ms, r.description, r.sourceTimestamp) for r in df.collect())


def test_detectors_ignore_input_order(spark):
    events = tv.read_table(spark, SF, "events")
    shuffled = events.orderBy(F.rand(seed=11)).repartition(5)
    for build in (lambda e: incidents.gridlock(tv.traffic_signals(e)),
                  lambda e: bus_bunching(tv.bus_gps(e)),
                  lambda e: incidents.aqi_emergency(tv.air_quality(e))):
        assert _alerts(build(events)) == _alerts(build(shuffled))
