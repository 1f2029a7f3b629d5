"""JSON wire format: parse typed records out of message values, serialize rows.

Parse modes
  ``strict``      Spark FAILFAST: a malformed record, a field the schema does not
                  have, or a bad or missing event time fails the job.
  ``permissive``  malformed records give null fields (the reference's Spark jobs).
  ``quarantine``  permissive plus an ``_error`` column naming why a record is
                  unusable (null value, malformed JSON or wrong types, unknown
                  fields with their names, bad event time); ``split_quarantine``
                  separates the two flows.

Unknown fields are looked for at the top level, by the key set of the record;
``unknown="ignore"`` accepts them in every mode.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.functions.timecols import event_time_from_iso

CORRUPT = "_corrupt_record"
MODES = ("strict", "permissive", "quarantine")


def unknown_fields(value: str | Column, schema: T.StructType) -> Column:
    """Names of a JSON object's fields that the schema does not have, comma-joined in
    their order (null: none, or no object)."""
    keys = F.json_object_keys(F.col(value) if isinstance(value, str) else value)
    other = F.array_except(keys, F.array(*[F.lit(f.name) for f in schema.fields]))
    return F.when(F.size(other) > 0, F.array_join(other, ","))


NUMERIC = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.ShortType, T.DecimalType)


def _lenient(schema: T.StructType) -> T.StructType:
    """Numbers read as strings (a JSON number or a quoted one both parse)."""
    return T.StructType([
        T.StructField(f.name, T.StringType(), True) if isinstance(f.dataType, NUMERIC) else f
        for f in schema.fields
    ])


def parse_records(
    df: DataFrame,
    schema: T.StructType,
    value_col: str = "value",
    mode: str = "permissive",
    time_field: str | None = "timestamp",
    keep: tuple[str, ...] = (),
    coerce_quoted_numbers: bool = False,
    unknown: str = "reject",
) -> DataFrame:
    """``value`` JSON string -> flattened typed columns (+ ``event_time``, ``t_ms``).

    ``coerce_quoted_numbers`` accepts ``"aqi": "310"`` as 310 (what a lenient
    JSON mapper does); by default a quoted number makes the record malformed.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if unknown not in ("reject", "ignore"):
        raise ValueError(f"unknown is 'reject' or 'ignore', not {unknown!r}")
    if coerce_quoted_numbers:
        typed = parse_records(df, _lenient(schema), value_col, mode, time_field, keep, unknown=unknown)
        casts = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields
                 if isinstance(f.dataType, NUMERIC)}
        if mode == "quarantine":  # a string that is no number
            lost = [F.col(n).isNotNull() & c.isNull() for n, c in casts.items()]
            typed = typed.withColumn("_error", F.coalesce("_error", F.when(reduce(or_, lost, F.lit(False)), F.lit("malformed record"))))
        return typed.withColumns(casts)
    names = [f.name for f in schema.fields]
    if mode == "strict":
        value = F.col(value_col)
        if unknown == "reject":
            other = unknown_fields(value_col, schema)
            value = F.when(other.isNotNull(), F.raise_error(F.concat(F.lit("unknown fields: "), other)).cast("string")).otherwise(value)
        parsed = F.from_json(value, schema, {"mode": "FAILFAST"})
        out = df.select(*keep, parsed.alias("_r")).select(*keep, *[F.col("_r")[n].alias(n) for n in names])
    else:
        wide = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
        parsed = F.from_json(
            F.col(value_col), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        )
        out = df.select(*keep, F.col(value_col).alias("_raw"), parsed.alias("_r")).select(
            *keep, "_raw", *[F.col("_r")[n].alias(n) for n in names + [CORRUPT]]
        )
    if time_field:
        out = event_time_from_iso(out, time_field)
        if mode == "strict":
            bad = F.raise_error(F.concat(F.lit("bad event time: "), F.coalesce(F.col(time_field).cast("string"), F.lit("null"))))
            out = out.withColumn("event_time", F.when(F.col("event_time").isNull(), bad.cast("timestamp")).otherwise(F.col("event_time")))
    if mode == "quarantine":
        reason = (
            F.when(F.col("_raw").isNull(), F.lit("null record"))
            .when(F.col(CORRUPT).isNotNull(), F.lit("malformed record"))
        )
        if unknown == "reject":
            other = unknown_fields("_raw", schema)
            reason = reason.when(other.isNotNull(), F.concat(F.lit("unknown fields: "), other))
        if time_field:
            reason = reason.when(F.col("event_time").isNull(), F.lit("bad event time"))
        out = out.withColumn("_error", reason)
    if mode != "strict":
        out = out.drop("_raw", CORRUPT)
    return out


def split_quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined) views of a ``mode='quarantine'`` parse."""
    return parsed.filter(F.col("_error").isNull()), parsed.filter(F.col("_error").isNotNull())


def to_json_value(cols: list[str | Column] | None = None, keep_nulls: bool = True) -> Column:
    """Row (or selected columns) -> JSON string; nulls kept by default."""
    body = F.struct(*(cols or ["*"]))
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(body, opts)
