"""The incident record shared by all detectors (camelCase wire names)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicflow.functions.timecols import now_millis

ALERT_COLUMNS = (
    "incidentType", "entityId", "zone", "description", "sourceTimestamp", "detectedAtMillis",
)

# Fixed values of the alert contract (type names and description templates).
AQI_EMERGENCY = "AQI_EMERGENCY"
GRIDLOCK = "GRIDLOCK"
BUS_BUNCHING = "BUS_BUNCHING"
AQI_TEMPLATE = "AQI reading of %d exceeds emergency threshold of %d for sensor %s"
GRIDLOCK_TEMPLATE = "Junction %s avg wait %.1fs exceeded %ds for %d consecutive cycles in zone %s"
BUNCHING_TEMPLATE = "Buses %s and %s on route %s within %.0fm for over 5 minutes"


def alert_columns(
    incident_type: str,
    entity_id: Column,
    zone: Column,
    description: Column,
    source_timestamp: Column,
    detected_at: Column | None = None,
) -> list[Column]:
    """Columns of one alert row; ``detected_at`` defaults to processing time."""
    return [
        F.lit(incident_type).alias("incidentType"),
        entity_id.cast("string").alias("entityId"),
        zone.cast("string").alias("zone"),
        description.alias("description"),
        source_timestamp.cast("string").alias("sourceTimestamp"),
        (detected_at if detected_at is not None else now_millis()).cast("long").alias("detectedAtMillis"),
    ]
