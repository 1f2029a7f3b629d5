"""Data-quality routing: first-match validation rules -> dead letters + report.

Rules are data: an ordered list of ``(topic, reason, predicate)``.  They are
compiled into one ``CASE WHEN`` expression, so classification is a single
projection (no shuffle, whole-stage codegen).  Dead-lettering *copies* rows:
the main flow is not filtered by default.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the dead-letter contract: reasons in rule order, the
# report's fallback reason and total label, and the range limits.
MALFORMED = "Malformed Record"
NULL_AQI = "Null AQI"
AQI_OUT_OF_RANGE = "AQI Out of Range"
MISSING_COORDINATES = "Missing Coordinates"
INVALID_LATITUDE = "Invalid Latitude"
INVALID_LONGITUDE = "Invalid Longitude"
UNKNOWN_REASON = "Unknown Error"
TOTAL_LABEL = "Total DLQ Messages"
AQI_MAX = 500
LAT_RANGE = (-90, 90)
LON_RANGE = (-180, 180)


@dataclass(frozen=True)
class Rule:
    topic: str
    reason: str
    predicate: Column


def _num(name: str) -> Column:
    return F.col(name)


def _out_of(c: Column, lo: float, hi: float) -> Column:
    # NaN fails the range test as in Python's chained comparison.
    return ~(c.between(lo, hi)) | F.isnan(c)


def default_rules(aqi_topic: str = "air_quality", bus_topic: str = "bus_gps") -> list[Rule]:
    """The checks of the two telemetry topics, in precedence order."""
    aqi, lat, lon = _num("aqi"), _num("lat"), _num("lon")
    return [
        Rule(aqi_topic, NULL_AQI, aqi.isNull()),
        Rule(aqi_topic, AQI_OUT_OF_RANGE, (aqi > AQI_MAX) & ~F.isnan(aqi)),
        Rule(bus_topic, MISSING_COORDINATES, lat.isNull() | lon.isNull()),
        Rule(bus_topic, INVALID_LATITUDE, _out_of(lat, *LAT_RANGE)),
        Rule(bus_topic, INVALID_LONGITUDE, _out_of(lon, *LON_RANGE)),
    ]


# Fields the rules read from each JSON value (as doubles; JSON null -> null).
RULE_FIELDS = ("aqi", "lat", "lon")
CORRUPT = "_corrupt_record"
RULE_SCHEMA = T.StructType([T.StructField(n, T.DoubleType(), True) for n in RULE_FIELDS] + [T.StructField(CORRUPT, T.StringType(), True)])


def malformed(value_col: str = "value") -> Column:
    """No value, or text that is no JSON object (empty, a bare ``null``, number,
    string or list).  Only records the narrow parse could not read are parsed
    again (a quoted number is JSON, so it is not malformed)."""
    value = F.col(value_col)
    no_object = ~value.rlike(r"^[ \t\r\n]*\{")
    return value.isNull() | no_object | (F.col(CORRUPT).isNotNull() & F.try_parse_json(value).isNull())


def reason_column(rules: list[Rule], topic_col: str = "topic", value_col: str = "value") -> Column:
    expr = F.when(malformed(value_col), F.lit(MALFORMED))
    for r in rules:
        cond = (F.col(topic_col) == F.lit(r.topic)) & F.coalesce(r.predicate, F.lit(False))
        expr = expr.when(cond, F.lit(r.reason))
    return expr


def classify(records: DataFrame, rules: list[Rule] | None = None, value_col: str = "value",
             topic_col: str = "topic") -> DataFrame:
    """Add ``error_reason`` (null = clean) to Kafka-shaped rows with JSON values.
    A record whose value is no JSON object is malformed, whatever its topic.

    The rule fields are parsed once per record with a narrow schema (numbers
    only: a quoted number reads as missing, ``NaN`` is accepted).  The parse
    sits in a generator (``inline``), which keeps a later ``error_reason``
    filter from being pushed below it and re-parsing the JSON once per rule.
    """
    rules = rules or default_rules()
    parsed = F.inline(F.array(F.from_json(F.col(value_col), RULE_SCHEMA, {"columnNameOfCorruptRecord": CORRUPT})))
    typed = records.select(*[F.col(c) for c in records.columns], parsed)
    out = typed.withColumn("error_reason", reason_column(rules, topic_col, value_col))
    return out.select(*records.columns, "error_reason")


def dead_letters(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("error_reason").isNotNull())


def split(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, dead) convenience; the reference itself keeps bad rows flowing."""
    return classified.filter(F.col("error_reason").isNull()), dead_letters(classified)


def envelope(dead: DataFrame, value_col: str = "value", topic_col: str = "topic") -> DataFrame:
    """Dead-letter message: ``{source_topic, error_reason, original_record}``.

    The original record is carried as a VARIANT, so it is re-emitted as the
    same JSON object (inner nulls included), not as an escaped string; the text
    of a malformed record is carried as it is.
    """
    body = F.struct(
        F.col(topic_col).alias("source_topic"),
        F.col("error_reason"),
        F.coalesce(F.try_parse_json(F.col(value_col)), F.col(value_col).cast("variant")).alias("original_record"),
    )
    return dead.select("*", F.to_json(body).alias("dlq_value"))


def report(dlq: DataFrame, reason_col: str = "error_reason") -> DataFrame:
    """Count per error reason plus a grand total row (``GROUP BY ROLLUP``).

    A message without a reason counts as ``Unknown Error``.
    """
    reason = F.coalesce(F.col(reason_col), F.lit(UNKNOWN_REASON)).alias("error_type")
    rolled = dlq.select(reason).rollup("error_type").agg(
        F.count(F.lit(1)).alias("message_count"), F.grouping("error_type").alias("_g")
    )
    return rolled.select(
        F.when(F.col("_g") == 1, F.lit(TOTAL_LABEL)).otherwise(F.col("error_type")).alias("error_type"),
        "message_count",
        (F.col("_g") == 1).alias("is_total"),
    )


def report_from_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Report over raw DLQ messages (JSON), reading ``error_reason`` by name."""
    reason = F.get_json_object(F.col(value_col), "$.error_reason")
    return report(messages.select(reason.alias("error_reason")))
