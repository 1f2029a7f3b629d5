"""Registered batch queries: each takes ``(spark, sf_dir)`` and returns a
DataFrame whose columns match the DuckDB oracle of the same name.

Every query reads the driver's tables (the telemetry streams are projections
of ``events``), runs over all rows, and uses the library operators exactly as
a user would.  Only the final projection is shaped for comparison (times as
strings, doubles rounded to 6 places).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow import schemas
from civicflow.functions.jsonio import parse_records
from civicflow.operators import incidents, quality, windows
from civicflow.operators.enrich import enrich
from civicflow.operators.latest import latest_per_key
from civicflow.operators.replay import replay
from civicflow.session import materialize, scratch_path
from civicflow.sources import files
from civicflow.sources import telemetry as tv
from civicflow.streaming import io, jobs

TS_FMT = "yyyy-MM-dd HH:mm:ss"
BUNCHING_EXPIRY_MS = 180_000


def _r6(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _r6_mean(c: str | Column) -> Column:
    """Rounding for means of short decimals: they can land exactly on a rounding
    tie, where float summation order decides the side; a bias far above float
    noise makes the side deterministic (used identically by the oracle)."""
    return F.round((F.col(c) if isinstance(c, str) else c) + F.lit(1e-9), 6)


def _ts(c: str | Column) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, TS_FMT)


def _views(spark: SparkSession, sf_dir: str, *kinds: str) -> list[DataFrame]:
    events = tv.read_table(spark, sf_dir, "events")
    return [tv.VIEWS[k](events) for k in kinds]


# -- step 1: ward energy, JSON round trip, parse modes --------------------------

def q_ward_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    (meters,) = _views(spark, sf_dir, "smart_meters")
    summary = windows.with_window_date(windows.ward_energy(meters))
    return summary.select(
        "ward_id",
        _ts("window.start").alias("window_start"),
        _ts("window.end").alias("window_end"),
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        _r6("total_kwh_consumed").alias("total_kwh_consumed"),
        _r6_mean("avg_power_factor").alias("avg_power_factor"),
        _r6("peak_voltage").alias("peak_voltage"),
    )


def q_meters_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    (meters,) = _views(spark, sf_dir, "smart_meters")
    wire = tv.wire_records(meters, "smart_meters")
    parsed = parse_records(wire, schemas.SMART_METER, mode="permissive", keep=("offset",))
    return parsed.select(
        F.col("offset").alias("seq"), "meter_id", "ward_id",
        _r6("kwh_reading").alias("kwh_reading"), _r6("voltage").alias("voltage"),
        _r6("power_factor").alias("power_factor"), "timestamp", "t_ms",
    )


def corrupt_wire(wire: DataFrame) -> DataFrame:
    """Deterministic damage for the quarantine check (every row is kept):
    truncated JSON, a quoted number, an unparseable timestamp."""
    s = F.col("offset")
    v = F.col("value")
    v = F.when(s % 37 == 5, F.substring(v, 1, 25)).otherwise(v)
    v = F.when(s % 41 == 7, F.regexp_replace(v, r'"aqi":(-?\d+)', '"aqi":"$1"')).otherwise(v)
    v = F.when(s % 43 == 11, F.regexp_replace(v, r'"timestamp":"[^"]*"', '"timestamp":"bad"')).otherwise(v)
    return wire.withColumn("value", v)


def q_parse_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    (aqi,) = _views(spark, sf_dir, "air_quality")
    wire = corrupt_wire(tv.wire_records(aqi, "air_quality"))
    parsed = parse_records(wire, schemas.AIR_QUALITY, mode="quarantine", keep=("offset",))
    ok = F.col("_error").isNull()
    return parsed.select(
        F.col("offset").alias("seq"),
        F.col("_error").alias("parse_error"),
        F.when(ok, F.col("sensor_id")).alias("sensor_id"),
        F.when(ok, F.col("aqi")).alias("aqi"),
        F.when(ok, F.col("t_ms")).alias("t_ms"),
    )


#: Values that are no JSON object, by the remainder of the offset by 7.
NO_OBJECTS = ("", "null", "5", "[1]", '"x"', " \n", "{")


def no_object_wire(wire: DataFrame) -> DataFrame:
    """Every 31st record's value is empty, a bare scalar, a list or a torn object."""
    kinds = F.array(*[F.lit(x) for x in NO_OBJECTS])
    other = F.get(kinds, (F.col("offset") % len(NO_OBJECTS)).cast("int"))
    return wire.withColumn("value", F.when(F.col("offset") % 31 == 9, other).otherwise(F.col("value")))


def q_parse_unknown_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 19th reading has a field more, every 57th two; quarantine names them."""
    (aqi,) = _views(spark, sf_dir, "air_quality")
    extra = F.when(F.col("offset") % 57 == 4, F.lit('{"unit":"ug","v":{"a":1},')).when(F.col("offset") % 19 == 4, F.lit('{"unit":"ug",'))
    wire = tv.wire_records(aqi, "air_quality")
    wire = wire.withColumn("value", F.when(extra.isNotNull(), F.concat(extra, F.expr("substr(value, 2)"))).otherwise(F.col("value")))
    parsed = parse_records(wire, schemas.AIR_QUALITY, mode="quarantine", keep=("offset",))
    return parsed.select(F.col("offset").alias("seq"), F.col("_error").alias("parse_error"), "sensor_id", "aqi")


# -- step 2: advisories and enrichment ------------------------------------------

def _advisory_out(df: DataFrame) -> DataFrame:
    return df.select(
        "zone", _ts("window_end").alias("window_end"),
        _r6("rolling_avg_aqi").alias("rolling_avg_aqi"), "population", "num_schools",
    )


def q_health_advisory_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    (aqi,) = _views(spark, sf_dir, "air_quality")
    return _advisory_out(windows.health_advisories(aqi, tv.zone_profile(spark)))


def q_health_advisory_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    (aqi,) = _views(spark, sf_dir, "air_quality")
    aqi.createOrReplaceTempView("aqi_stream")
    tv.zone_profile(spark).createOrReplaceTempView("zone_profile")
    return _advisory_out(windows.health_advisories_sql(spark, "aqi_stream", "zone_profile"))


def q_route_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    (bus,) = _views(spark, sf_dir, "bus_gps")
    out = enrich(bus, tv.route_schedule(spark), on="route_id")
    return out.select(
        "seq", "bus_id", "route_id", _r6("lat").alias("lat"), _r6("lon").alias("lon"),
        "timestamp", "route_name", "terminal", "scheduled_arrival_time",
    )


# -- step 3: AQI emergency, dead letters, replay --------------------------------

ALERT_OUT = ["incidentType", "entityId", "zone", "description", "sourceTimestamp", "t_ms"]


def q_aqi_emergency(spark: SparkSession, sf_dir: str) -> DataFrame:
    (aqi,) = _views(spark, sf_dir, "air_quality")
    return incidents.aqi_emergency(aqi).select(*ALERT_OUT)


def _dlq_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    aqi, bus = _views(spark, sf_dir, "air_quality", "bus_gps")
    return tv.wire_records(aqi, "air_quality").unionByName(tv.wire_records(bus, "bus_gps"))


def q_dlq_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_dlq_input(spark, sf_dir)).select("topic", "offset", "error_reason")


def q_dlq_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    dead = quality.dead_letters(quality.classify(_dlq_input(spark, sf_dir)))
    msg = quality.envelope(dead).select("offset", F.col("dlq_value"))
    j = F.col("dlq_value")
    return msg.select(
        F.get_json_object(j, "$.source_topic").alias("source_topic"),
        F.get_json_object(j, "$.error_reason").alias("error_reason"),
        "offset",
        F.coalesce(
            F.get_json_object(j, "$.original_record.sensor_id"),
            F.get_json_object(j, "$.original_record.bus_id"),
        ).alias("entity_id"),
        F.get_json_object(j, "$.original_record.timestamp").alias("record_timestamp"),
    )


def q_dlq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    dead = quality.dead_letters(quality.classify(_dlq_input(spark, sf_dir)))
    messages = quality.envelope(dead).select(F.col("dlq_value").alias("value"))
    return quality.report_from_messages(messages)


def q_dlq_malformed_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged records -> envelopes in a topic folder -> bounded report of it."""
    (aqi,) = _views(spark, sf_dir, "air_quality")
    dead = quality.dead_letters(quality.classify(no_object_wire(corrupt_wire(tv.wire_records(aqi, "air_quality")))))
    topic = scratch_path(spark, "dlq-topic")
    quality.envelope(dead).select(F.lit("dlq").alias("topic"), "offset", F.col("dlq_value").alias("value")).write.json(topic)
    return jobs.dead_letter_report(spark, "files", "dlq", topic)


# -- file sources and sink rows ---------------------------------------------------

def q_jsonl_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meter records written as JSON lines and read with the declared schema."""
    (meters,) = _views(spark, sf_dir, "smart_meters")
    path = scratch_path(spark, "jsonl")
    tv.wire_records(meters, "smart_meters").select("value").write.text(path)
    return files.read_jsonl(spark, path, schemas.SMART_METER).select(
        "meter_id", "ward_id", _r6("kwh_reading").alias("kwh_reading"), _r6("voltage").alias("voltage"),
        _r6("power_factor").alias("power_factor"), "timestamp", "t_ms")


def q_csv_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with a CSV lookup whose keys repeat over several files: the last
    line of the last file wins.  The lookup is made of the nation table's rows."""
    path = scratch_path(spark, "lookup")
    nation = tv.read_table(spark, sf_dir, "nation")
    (nation.repartitionByRange(3, "n_nationkey").sortWithinPartitions("n_nationkey").select("n_regionkey", "n_name")
     .write.option("header", "true").csv(path))  # part files in the order of the keys
    lookup = files.read_lookup_csv(spark, path, "n_regionkey int, n_name string", key="n_regionkey")
    suppliers = tv.read_table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.expr("CAST(s_nationkey % 7 AS INT)").alias("n_regionkey"))
    return enrich(suppliers, lookup, on="n_regionkey").select("s_suppkey", "n_regionkey", "n_name")


def q_ward_energy_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sink rows of the ward summary: JSON with the nested window, no key."""
    (meters,) = _views(spark, sf_dir, "smart_meters")
    rows = io.kafka_rows(windows.ward_energy(meters))
    j = lambda path: F.get_json_object("value", path)
    return rows.select("key", j("$.ward_id").alias("ward_id"), j("$.window.start").alias("window_start"),
                       j("$.window.end").alias("window_end"), _r6(j("$.peak_voltage").cast("double")).alias("peak_voltage"))


def q_advisory_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sink rows of the advisories, keyed by zone."""
    (aqi,) = _views(spark, sf_dir, "air_quality")
    rows = io.kafka_rows(windows.health_advisories(aqi, tv.zone_profile(spark)), key="zone")
    j = lambda path: F.get_json_object("value", path)
    return rows.select("key", j("$.zone").alias("zone"), j("$.window_end").alias("window_end"),
                       _r6(j("$.rolling_avg_aqi").cast("double")).alias("rolling_avg_aqi"),
                       j("$.population").cast("int").alias("population"))


def q_keyed_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    (bus,) = _views(spark, sf_dir, "bus_gps")
    fields = [f.name for f in schemas.BUS_GPS.fields]
    rows = replay(bus, key="route_id", fields=fields, order="seq", limit=300)
    return rows.select(
        "key", "offset",
        F.get_json_object("value", "$.bus_id").alias("bus_id"),
        F.get_json_object("value", "$.timestamp").alias("timestamp"),
    )


# -- step 4: gridlock, latest positions -----------------------------------------

def q_gridlock(spark: SparkSession, sf_dir: str) -> DataFrame:
    (traffic,) = _views(spark, sf_dir, "traffic_signals")
    return incidents.gridlock(traffic).select(*ALERT_OUT)


def q_latest_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    (bus,) = _views(spark, sf_dir, "bus_gps")
    latest = latest_per_key(bus, ["route_id", "bus_id"], ["t_ms", "seq"], ["lat", "lon", "timestamp", "t_ms"])
    return latest.select(
        "route_id", "bus_id", _r6("lat").alias("lat"), _r6("lon").alias("lon"), "timestamp", "t_ms",
    )


QUERIES = {
    "ward_energy": q_ward_energy,
    "meters_json_roundtrip": q_meters_json_roundtrip,
    "parse_quarantine": q_parse_quarantine,
    "parse_unknown_fields": q_parse_unknown_fields,
    "health_advisory_df": q_health_advisory_df,
    "health_advisory_sql": q_health_advisory_sql,
    "route_enrichment": q_route_enrichment,
    "aqi_emergency": q_aqi_emergency,
    "dlq_classified": q_dlq_classified,
    "dlq_envelope": q_dlq_envelope,
    "dlq_report": q_dlq_report,
    "dlq_malformed_report": q_dlq_malformed_report,
    "jsonl_records": q_jsonl_records,
    "csv_lookup": q_csv_lookup,
    "ward_energy_rows": q_ward_energy_rows,
    "advisory_rows": q_advisory_rows,
    "keyed_replay": q_keyed_replay,
    "gridlock": q_gridlock,
    "latest_positions": q_latest_positions,
}


# -- step 5: proximity ----------------------------------------------------------

def q_near_pair_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civicflow.operators import proximity as P

    (bus,) = _views(spark, sf_dir, "bus_gps")
    pings = P.prepare_pings(bus)
    max_t = pings.agg(F.max("t_ms")).first()[0]
    seg = materialize(P.segments(pings), "near-segments")
    near = P.near_observations(seg, max_t=int(max_t))
    return near.select("route_id", "lo", "hi", "t_ms", "seq", F.round("distance", 3).alias("distance"))


def q_bus_bunching(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civicflow.operators import proximity as P

    (bus,) = _views(spark, sf_dir, "bus_gps")
    return P.bus_bunching(bus).select(*ALERT_OUT)


QUERIES["near_pair_observations"] = q_near_pair_observations
def q_bus_bunching_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bunching in arrival order, alerts when the watermark passes a deadline.
    Every ninth ping arrives 40 rows late."""
    from civicflow.operators import proximity as P

    (bus,) = _views(spark, sf_dir, "bus_gps")
    late = F.when(F.col("seq") % 9 == 4, 81).otherwise(0)
    return P.bus_bunching(bus.withColumn("seq", 2 * F.col("seq") + late), order="arrival").select(*ALERT_OUT)


def q_bus_bunching_expiring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bunching where a bus is forgotten three minutes (event time) after its last ping."""
    from civicflow.operators import proximity as P

    (bus,) = _views(spark, sf_dir, "bus_gps")
    return P.bus_bunching(bus, expire_ms=BUNCHING_EXPIRY_MS).select(*ALERT_OUT)


QUERIES["bus_bunching"] = q_bus_bunching
QUERIES["bus_bunching_arrival"] = q_bus_bunching_arrival
QUERIES["bus_bunching_expiring"] = q_bus_bunching_expiring


# -- flagship: the incident feed --------------------------------------------------

def q_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AQI emergencies + gridlock + bus bunching, unioned (bag semantics)."""
    from civicflow.operators import proximity as P

    aqi, traffic, bus = _views(spark, sf_dir, "air_quality", "traffic_signals", "bus_gps")
    feed = incidents.union_alerts(
        incidents.aqi_emergency(aqi), incidents.gridlock(traffic), P.bus_bunching(bus)
    )
    return feed.select(*ALERT_OUT)


def q_incident_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incident topic payload (camelCase JSON, nulls kept), read back by field."""
    feed = q_incidents(spark, sf_dir).withColumn("detectedAtMillis", F.lit(0).cast("long"))
    v = incidents.alerts_json(feed).select("value")
    fields = ["incidentType", "entityId", "zone", "description", "sourceTimestamp"]
    return v.select(
        *[F.get_json_object("value", f"$.{f}").alias(f) for f in fields],
        F.get_json_object("value", "$.detectedAtMillis").cast("long").alias("detectedAtMillis"),
    )


QUERIES["incidents"] = q_incidents
QUERIES["incident_json"] = q_incident_json
FLAGSHIP = q_incidents
