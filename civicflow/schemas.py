"""Record schemas of the four telemetry streams, the lookups and the outputs."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Wire records: the timestamp travels as an ISO-8601 string ending in "Z".
BUS_GPS = _struct(
    ("bus_id", S), ("route_id", S), ("lat", D), ("lon", D),
    ("speed_kmh", D), ("occupancy_pct", D), ("timestamp", S),
)
TRAFFIC_SIGNAL = _struct(
    ("junction_id", S), ("zone", S), ("vehicle_count", I), ("avg_wait_sec", D),
    ("signal_phase", S), ("timestamp", S),
)
AIR_QUALITY = _struct(
    ("sensor_id", S), ("zone", S), ("pm25", D), ("pm10", D), ("aqi", I),
    ("timestamp", S),
)
SMART_METER = _struct(
    ("meter_id", S), ("ward_id", S), ("kwh_reading", D), ("voltage", D),
    ("power_factor", D), ("timestamp", S),
)

# Static lookups.
ZONE_PROFILE = _struct(("zone", S), ("population", I), ("num_schools", I))
ROUTE_SCHEDULE = _struct(
    ("route_id", S), ("route_name", S), ("terminal", S), ("scheduled_arrival_time", S),
)

# Outputs.
INCIDENT = _struct(
    ("incidentType", S), ("entityId", S), ("zone", S), ("description", S),
    ("sourceTimestamp", S), ("detectedAtMillis", L),
)

BY_KIND = {
    "bus_gps": BUS_GPS,
    "traffic_signals": TRAFFIC_SIGNAL,
    "air_quality": AIR_QUALITY,
    "smart_meters": SMART_METER,
}
