"""DuckDB SQL text for every catalogued batch query (the correctness oracle).

The prelude rebuilds the telemetry views of ``sources/telemetry.py`` from the
``events`` view in plain SQL.  Decimal literals are written as DOUBLE casts so
both engines do the same IEEE arithmetic; milliseconds are floored with
``epoch_us // 1000``.  Doubles that are sums or means are rounded to 6 places
on both sides.
"""

from __future__ import annotations

PRELUDE = r"""
WITH ev AS (
  SELECT event_id AS seq, user_id AS u, value AS v,
         CAST(1704067200000 + (epoch_us(ts) // 1000 - 1704067200000) // 60 AS BIGINT) AS t_ms
  FROM events
), evt AS (
  SELECT *, strftime(make_timestamp(t_ms * 1000), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS ts_iso
  FROM ev
), smart_meters AS (
  SELECT seq, t_ms, ts_iso,
         'SM-' || CAST(1000 + u AS VARCHAR) AS meter_id,
         'WARD-' || CAST(u % 5 + 1 AS VARCHAR) AS ward_id,
         v / CAST(100 AS DOUBLE) AS kwh_reading,
         CAST(220 AS DOUBLE) + (seq % 201) / CAST(10 AS DOUBLE) AS voltage,
         CAST(0.7 AS DOUBLE) + (seq % 31) / CAST(100 AS DOUBLE) AS power_factor
  FROM evt
), air_quality AS (
  SELECT seq, t_ms, ts_iso,
         'AQI-' || CAST(u % 100 + 1 AS VARCHAR) AS sensor_id,
         'ZONE-' || CAST(u % 7 + 1 AS VARCHAR) AS zone,
         v AS pm25, v * CAST(1.5 AS DOUBLE) AS pm10,
         CASE WHEN seq % 20 = 0 THEN NULL ELSE CAST(floor(v * CAST(3 AS DOUBLE)) AS INTEGER) END AS aqi
  FROM evt
), traffic_signals AS (
  SELECT seq, t_ms, ts_iso,
         'JUNC-' || CAST(100 + u % 400 AS VARCHAR) AS junction_id,
         'ZONE-' || CAST(u % 400 % 6 + 1 AS VARCHAR) AS zone,
         CAST(floor(v) AS INTEGER) AS vehicle_count,
         v * CAST(4 AS DOUBLE) AS avg_wait_sec,
         CASE seq % 3 WHEN 0 THEN 'RED' WHEN 1 THEN 'GREEN' ELSE 'YELLOW' END AS signal_phase
  FROM evt
), bus_gps AS (
  SELECT seq, t_ms, ts_iso,
         'BUS-' || CAST(1000 + u % 30 AS VARCHAR) AS bus_id,
         'R-' || CAST(u % 30 % 6 + 1 AS VARCHAR) AS route_id,
         CASE WHEN seq % 97 = 0 THEN NULL
              WHEN seq % 89 = 0 THEN CAST(95.0 AS DOUBLE)
              ELSE CAST(28.40 AS DOUBLE) + ((t_ms // 900000 * 37 + (u % 30) * 11) % 7) * CAST(0.0005 AS DOUBLE)
         END AS lat,
         CASE WHEN seq % 83 = 0 THEN CAST(-190.0 AS DOUBLE)
              ELSE CAST(77.00 AS DOUBLE) + ((t_ms // 600000 * 5 + (u % 30)) % 3) * CAST(0.0003 AS DOUBLE)
         END AS lon,
         v % 65 AS speed_kmh,
         CAST(10 AS DOUBLE) + v % 90 AS occupancy_pct
  FROM evt
), zone_profile AS (
  SELECT 'ZONE-' || CAST(k AS VARCHAR) AS zone, CAST(k * 10000 AS INTEGER) AS population,
         CAST(k AS INTEGER) AS num_schools
  FROM range(1, 7) r(k)
), route_schedule AS (
  SELECT 'R-' || CAST(k AS VARCHAR) AS route_id, 'Line ' || CAST(k AS VARCHAR) AS route_name,
         'T-' || CAST(k % 3 + 1 AS VARCHAR) AS terminal,
         '1' || CAST(k AS VARCHAR) || ':00:00' AS scheduled_arrival_time
  FROM range(1, 6) r(k)
)
"""

TS = "'%Y-%m-%d %H:%M:%S'"


def _q(body: str, recursive: bool = False) -> str:
    pre = PRELUDE.replace("WITH ev AS", "WITH RECURSIVE ev AS", 1) if recursive else PRELUDE
    return pre + body


WARD_ENERGY = _q(f"""
SELECT ward_id,
       strftime(make_timestamp(t_ms // 900000 * 900000 * 1000), {TS}) AS window_start,
       strftime(make_timestamp((t_ms // 900000 + 1) * 900000 * 1000), {TS}) AS window_end,
       strftime(make_timestamp(t_ms // 900000 * 900000 * 1000), '%Y-%m-%d') AS date,
       round(sum(kwh_reading), 6) AS total_kwh_consumed,
       round(avg(power_factor) + 1e-9, 6) AS avg_power_factor,
       round(max(voltage), 6) AS peak_voltage
FROM smart_meters
GROUP BY ward_id, t_ms // 900000
""")

METERS_JSON_ROUNDTRIP = _q("""
SELECT seq, meter_id, ward_id, round(kwh_reading, 6) AS kwh_reading, round(voltage, 6) AS voltage,
       round(power_factor, 6) AS power_factor, ts_iso AS "timestamp", t_ms
FROM smart_meters
""")

PARSE_QUARANTINE = _q("""
SELECT seq,
       CASE WHEN bad THEN 'malformed record' WHEN seq % 43 = 11 THEN 'bad event time' END AS parse_error,
       CASE WHEN bad OR seq % 43 = 11 THEN NULL ELSE sensor_id END AS sensor_id,
       CASE WHEN bad OR seq % 43 = 11 THEN NULL ELSE aqi END AS aqi,
       CASE WHEN bad OR seq % 43 = 11 THEN NULL ELSE t_ms END AS t_ms
FROM (SELECT *, seq % 37 = 5 OR (seq % 41 = 7 AND aqi IS NOT NULL) AS bad FROM air_quality) a
""")

PARSE_UNKNOWN_FIELDS = _q("""
SELECT seq, CASE WHEN seq % 57 = 4 THEN 'unknown fields: unit,v' WHEN seq % 19 = 4 THEN 'unknown fields: unit' END AS parse_error,
       sensor_id, aqi
FROM air_quality
""")

_AQI_WINDOWS = """
aqi_w AS (
  SELECT zone, aqi, (t_ms // 300000) * 300000 + 300000 AS window_end_ms FROM air_quality
  UNION ALL
  SELECT zone, aqi, (t_ms // 300000) * 300000 + 600000 AS window_end_ms FROM air_quality
)"""

HEALTH_ADVISORY = _q(f""", {_AQI_WINDOWS.strip()}
, rolled AS (
  SELECT zone, window_end_ms, avg(aqi) AS level FROM aqi_w GROUP BY ALL
)
SELECT zone, strftime(make_timestamp(window_end_ms * 1000), {TS}) AS window_end,
       round(level, 6) AS rolling_avg_aqi, population, num_schools
FROM (FROM rolled WHERE level > 150) JOIN zone_profile USING (zone)
""")

ROUTE_ENRICHMENT = _q("""
SELECT b.seq, b.bus_id, b.route_id, round(b.lat, 6) AS lat, round(b.lon, 6) AS lon,
       b.ts_iso AS "timestamp", r.route_name, r.terminal, r.scheduled_arrival_time
FROM bus_gps b JOIN route_schedule r ON b.route_id = r.route_id
""")

AQI_EMERGENCY = _q("""
SELECT 'AQI_EMERGENCY' AS "incidentType", sensor_id AS "entityId", zone,
       'AQI reading of ' || CAST(aqi AS VARCHAR) || ' exceeds emergency threshold of 300 for sensor '
         || sensor_id AS description,
       ts_iso AS "sourceTimestamp", t_ms
FROM air_quality WHERE aqi > 300
""")

_CLASSIFIED = """
classified AS (
  SELECT 'air_quality' AS topic, seq AS "offset",
         CASE WHEN aqi IS NULL THEN 'Null AQI'
              WHEN aqi > 500 THEN 'AQI Out of Range' END AS error_reason,
         sensor_id AS entity_id, ts_iso AS record_timestamp
  FROM air_quality
  UNION ALL
  SELECT 'bus_gps' AS topic, seq AS "offset",
         CASE WHEN lat IS NULL OR lon IS NULL THEN 'Missing Coordinates'
              WHEN NOT (lat BETWEEN -90 AND 90) THEN 'Invalid Latitude'
              WHEN NOT (lon BETWEEN -180 AND 180) THEN 'Invalid Longitude' END AS error_reason,
         bus_id AS entity_id, ts_iso AS record_timestamp
  FROM bus_gps
)"""

DLQ_CLASSIFIED = _q(f""", {_CLASSIFIED.strip()}
SELECT topic, "offset", error_reason FROM classified
""")

DLQ_ENVELOPE = _q(f""", {_CLASSIFIED.strip()}
SELECT topic AS source_topic, error_reason, "offset", entity_id, record_timestamp
FROM classified WHERE error_reason IS NOT NULL
""")

DLQ_REPORT = _q(f""", {_CLASSIFIED.strip()}
SELECT CASE WHEN grouping(error_type) = 1 THEN 'Total DLQ Messages' ELSE error_type END AS error_type,
       count(*) AS message_count,
       grouping(error_type) = 1 AS is_total
FROM (SELECT coalesce(error_reason, 'Unknown Error') AS error_type
      FROM classified WHERE error_reason IS NOT NULL) d
GROUP BY ROLLUP (error_type)
""")

_DAMAGED = """
damaged AS (
  SELECT seq,
         CASE WHEN seq % 37 = 5 OR seq % 31 = 9 THEN 'Malformed Record'
              WHEN aqi IS NULL OR seq % 41 = 7 THEN 'Null AQI'
              WHEN aqi > 500 THEN 'AQI Out of Range' END AS error_reason
  FROM air_quality
)"""

DLQ_MALFORMED_REPORT = _q(f""", {_DAMAGED.strip()}
SELECT coalesce(error_reason, 'Total DLQ Messages') AS error_type, count(*) AS message_count,
       grouping(error_reason) = 1 AS is_total
FROM damaged WHERE error_reason IS NOT NULL
GROUP BY ROLLUP (error_reason)
""")

DLQ_MALFORMED = _q(f""", {_DAMAGED.strip()}
SELECT 'air_quality' AS source_topic, error_reason, seq AS "offset" FROM damaged WHERE error_reason IS NOT NULL
""")

JSONL_RECORDS = _q("""
SELECT meter_id, ward_id, round(kwh_reading, 6) AS kwh_reading, round(voltage, 6) AS voltage,
       round(power_factor, 6) AS power_factor, ts_iso AS "timestamp", t_ms
FROM smart_meters
""")

CSV_LOOKUP = """
SELECT s.s_suppkey, CAST(s.s_nationkey % 7 AS INTEGER) AS n_regionkey, n.n_name
FROM supplier s
JOIN (SELECT n_regionkey, arg_max(n_name, n_nationkey) AS n_name FROM nation GROUP BY n_regionkey) n
  ON n.n_regionkey = s.s_nationkey % 7
"""

WARD_ENERGY_ROWS = f"""
SELECT CAST(NULL AS VARCHAR) AS key, ward_id, replace(window_start, ' ', 'T') || '.000Z' AS window_start,
       replace(window_end, ' ', 'T') || '.000Z' AS window_end, peak_voltage
FROM ({WARD_ENERGY}) w
"""

ADVISORY_ROWS = f"""
SELECT zone AS key, zone, replace(window_end, ' ', 'T') || '.000Z' AS window_end, rolling_avg_aqi, population
FROM ({HEALTH_ADVISORY}) a
"""

KEYED_REPLAY = _q("""
SELECT route_id AS key, seq AS "offset", bus_id, ts_iso AS "timestamp"
FROM bus_gps ORDER BY seq LIMIT 300
""")

GRIDLOCK = _q("""
, flagged AS (
  SELECT *, coalesce(avg_wait_sec, 0) > 180 AS breach,
         sum(CASE WHEN coalesce(avg_wait_sec, 0) > 180 THEN 0 ELSE 1 END)
           OVER (PARTITION BY junction_id ORDER BY t_ms, seq ROWS UNBOUNDED PRECEDING) AS island
  FROM traffic_signals
), positioned AS (
  SELECT *, sum(CASE WHEN breach THEN 1 ELSE 0 END)
              OVER (PARTITION BY junction_id, island ORDER BY t_ms, seq ROWS UNBOUNDED PRECEDING) AS run_len
  FROM flagged
)
SELECT 'GRIDLOCK' AS "incidentType", junction_id AS "entityId", zone,
       printf('Junction %s avg wait %.1fs exceeded %ds for %d consecutive cycles in zone %s',
              junction_id, avg_wait_sec, 180, 3, zone) AS description,
       ts_iso AS "sourceTimestamp", t_ms
FROM positioned WHERE breach AND run_len = 3
""")

LATEST_POSITIONS = _q("""
SELECT route_id, bus_id, round(lat, 6) AS lat, round(lon, 6) AS lon, ts_iso AS "timestamp", t_ms
FROM (SELECT *, row_number() OVER (PARTITION BY route_id, bus_id ORDER BY t_ms DESC, seq DESC) AS rn
      FROM bus_gps) x
WHERE rn = 1
""")


ORACLE = {
    "ward_energy": WARD_ENERGY,
    "meters_json_roundtrip": METERS_JSON_ROUNDTRIP,
    "parse_quarantine": PARSE_QUARANTINE,
    "parse_unknown_fields": PARSE_UNKNOWN_FIELDS,
    "health_advisory_df": HEALTH_ADVISORY,
    "health_advisory_sql": HEALTH_ADVISORY,
    "route_enrichment": ROUTE_ENRICHMENT,
    "aqi_emergency": AQI_EMERGENCY,
    "dlq_classified": DLQ_CLASSIFIED,
    "dlq_envelope": DLQ_ENVELOPE,
    "dlq_report": DLQ_REPORT,
    "dlq_malformed_report": DLQ_MALFORMED_REPORT,
    "jsonl_records": JSONL_RECORDS,
    "csv_lookup": CSV_LOOKUP,
    "ward_energy_rows": WARD_ENERGY_ROWS,
    "advisory_rows": ADVISORY_ROWS,
    "keyed_replay": KEYED_REPLAY,
    "gridlock": GRIDLOCK,
    "latest_positions": LATEST_POSITIONS,
}


_BUS_OBS = """
pings AS (
  SELECT route_id, bus_id, seq, t_ms, coalesce(lat, 0.0) AS lat, coalesce(lon, 0.0) AS lon, ts_iso
  FROM bus_gps
), pairs AS (
  SELECT a.route_id, a.bus_id AS lo, b.bus_id AS hi
  FROM (SELECT DISTINCT route_id, bus_id FROM pings) a
  JOIN (SELECT DISTINCT route_id, bus_id FROM pings) b ON a.route_id = b.route_id AND a.bus_id < b.bus_id
), pp AS (
  SELECT p.route_id, p.lo, p.hi, x.t_ms, x.seq, x.bus_id, x.lat, x.lon
  FROM pairs p JOIN pings x ON x.route_id = p.route_id AND x.bus_id = p.lo
  UNION ALL
  SELECT p.route_id, p.lo, p.hi, x.t_ms, x.seq, x.bus_id, x.lat, x.lon
  FROM pairs p JOIN pings x ON x.route_id = p.route_id AND x.bus_id = p.hi
), filled AS (
  SELECT route_id, lo, hi, t_ms, seq,
    last_value(CASE WHEN bus_id = lo THEN lat END IGNORE NULLS) OVER w AS lo_lat,
    last_value(CASE WHEN bus_id = lo THEN lon END IGNORE NULLS) OVER w AS lo_lon,
    last_value(CASE WHEN bus_id = hi THEN lat END IGNORE NULLS) OVER w AS hi_lat,
    last_value(CASE WHEN bus_id = hi THEN lon END IGNORE NULLS) OVER w AS hi_lon
  FROM pp
  WINDOW w AS (PARTITION BY route_id, lo, hi ORDER BY t_ms, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), hv AS (
  SELECT route_id, lo, hi, t_ms, seq,
         pow(sin(radians(hi_lat - lo_lat) / 2), 2)
           + cos(radians(lo_lat)) * cos(radians(hi_lat)) * pow(sin(radians(hi_lon - lo_lon) / 2), 2) AS a
  FROM filled WHERE lo_lat IS NOT NULL AND hi_lat IS NOT NULL
), obs AS (
  SELECT route_id, lo, hi, t_ms, seq,
         CASE WHEN a >= 0 AND a <= 1 THEN 6371000.0 * 2 * atan2(sqrt(a), sqrt(1 - a)) END AS distance
  FROM hv
)"""

NEAR_PAIR_OBSERVATIONS = _q(f""", {_BUS_OBS.strip()}
SELECT route_id, lo, hi, t_ms, seq, round(distance, 3) AS distance
FROM obs WHERE distance < 200
""")

BUS_BUNCHING = _q(f""", {_BUS_OBS.strip()}
, isl AS (
  SELECT *, coalesce(distance < 200, false) AS near,
         sum(CASE WHEN coalesce(distance < 200, false) THEN 0 ELSE 1 END)
           OVER (PARTITION BY route_id, lo, hi ORDER BY t_ms, seq ROWS UNBOUNDED PRECEDING) AS island
  FROM obs
), closes AS (
  SELECT route_id, lo, hi, island - 1 AS island, min(t_ms) AS close_t
  FROM isl WHERE NOT near GROUP BY route_id, lo, hi, island
), nearobs AS (
  SELECT route_id, lo, hi, island, t_ms FROM isl WHERE near
), nxt AS (
  SELECT DISTINCT route_id, lo, hi, island, t_ms,
         min(t_ms) OVER (PARTITION BY route_id, lo, hi, island ORDER BY t_ms
                         RANGE BETWEEN 300001 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_start
  FROM nearobs
), chain AS (
  SELECT route_id, lo, hi, island, min(t_ms) AS s FROM nearobs GROUP BY route_id, lo, hi, island
  UNION ALL
  SELECT c.route_id, c.lo, c.hi, c.island, n.next_start
  FROM chain c JOIN nxt n
    ON n.route_id = c.route_id AND n.lo = c.lo AND n.hi = c.hi AND n.island = c.island AND n.t_ms = c.s
  WHERE n.next_start IS NOT NULL
), deadlines AS (
  SELECT c.route_id, c.lo, c.hi, c.s + 300000 AS deadline
  FROM chain c LEFT JOIN closes k
    ON k.route_id = c.route_id AND k.lo = c.lo AND k.hi = c.hi AND k.island = c.island
  WHERE (k.close_t IS NULL OR k.close_t > c.s + 300000)
    AND c.s + 300000 <= (SELECT max(t_ms) FROM bus_gps) - 10001
), at_a AS (
  SELECT d.*, p.lat AS a_lat, p.lon AS a_lon, p.ts_iso AS a_ts,
         row_number() OVER (PARTITION BY d.route_id, d.lo, d.hi, d.deadline ORDER BY p.t_ms DESC, p.seq DESC) AS rn
  FROM deadlines d JOIN pings p ON p.route_id = d.route_id AND p.bus_id = d.lo AND p.t_ms <= d.deadline
), at_b AS (
  SELECT d.route_id, d.lo, d.hi, d.deadline, p.lat AS b_lat, p.lon AS b_lon,
         row_number() OVER (PARTITION BY d.route_id, d.lo, d.hi, d.deadline ORDER BY p.t_ms DESC, p.seq DESC) AS rn
  FROM deadlines d JOIN pings p ON p.route_id = d.route_id AND p.bus_id = d.hi AND p.t_ms <= d.deadline
), fired AS (
  SELECT a.route_id, a.lo, a.hi, a.deadline, a.a_ts,
         6371000.0 * 2 * atan2(sqrt(h), sqrt(1 - h)) AS distance
  FROM (SELECT a.*, b.b_lat, b.b_lon,
               pow(sin(radians(b.b_lat - a.a_lat) / 2), 2)
                 + cos(radians(a.a_lat)) * cos(radians(b.b_lat)) * pow(sin(radians(b.b_lon - a.a_lon) / 2), 2) AS h
        FROM at_a a JOIN at_b b
          ON a.route_id = b.route_id AND a.lo = b.lo AND a.hi = b.hi AND a.deadline = b.deadline
        WHERE a.rn = 1 AND b.rn = 1) a
)
SELECT 'BUS_BUNCHING' AS "incidentType", lo || ':' || hi AS "entityId", '' AS zone,
       printf('Buses %s and %s on route %s within %.0fm for over 5 minutes', lo, hi, route_id, distance)
         AS description,
       a_ts AS "sourceTimestamp", deadline AS t_ms
FROM fired
""", recursive=True)

ORACLE["near_pair_observations"] = NEAR_PAIR_OBSERVATIONS
ORACLE["bus_bunching"] = BUS_BUNCHING

# A position expires three minutes after it, unless a ping came before: from then
# on the bus is nowhere (not a number), which is far from everything.
_EXPIRING = """, known AS (
  SELECT route_id, bus_id, seq, t_ms, coalesce(lat, 0.0) AS lat, coalesce(lon, 0.0) AS lon, ts_iso,
         lead(t_ms) OVER (PARTITION BY route_id, bus_id ORDER BY t_ms, seq) AS next_t
  FROM bus_gps
), pings AS (
  SELECT route_id, bus_id, seq, t_ms, lat, lon, ts_iso FROM known
  UNION ALL
  SELECT route_id, bus_id, -1, t_ms + 180000, CAST('NaN' AS DOUBLE), CAST('NaN' AS DOUBLE), NULL
  FROM known WHERE next_t IS NULL OR next_t >= t_ms + 180000
), pairs AS ("""
BUS_BUNCHING_EXPIRING = BUS_BUNCHING[:BUS_BUNCHING.index(", pings AS (")] + _EXPIRING + BUS_BUNCHING.split("), pairs AS (", 1)[1]
ORACLE["bus_bunching_expiring"] = BUS_BUNCHING_EXPIRING


# Every ninth ping arrives 40 rows late; rows are applied in order of arrival, and
# a watch fires at the row whose event time lets the watermark reach its deadline.
BUS_BUNCHING_ARRIVAL = _q(f""", {_BUS_OBS.strip().replace("seq, t_ms, coalesce", "2 * seq + CASE WHEN seq % 9 = 4 THEN 81 ELSE 0 END AS seq, 2 * seq + CASE WHEN seq % 9 = 4 THEN 81 ELSE 0 END AS t_ms, t_ms AS ev_t, coalesce", 1)}
, isl AS (
  SELECT o.*, p.ev_t, coalesce(distance < 200, false) AS near,
         sum(CASE WHEN coalesce(distance < 200, false) THEN 0 ELSE 1 END)
           OVER (PARTITION BY o.route_id, lo, hi ORDER BY o.seq ROWS UNBOUNDED PRECEDING) AS island
  FROM obs o JOIN pings p ON p.seq = o.seq
), closes AS (
  SELECT route_id, lo, hi, island - 1 AS island, min(seq) AS close_at FROM isl WHERE NOT near GROUP BY ALL
), passes AS (
  SELECT ev_t, min(min(seq)) OVER (ORDER BY ev_t DESC ROWS UNBOUNDED PRECEDING) AS pos FROM pings GROUP BY ev_t
), nearobs AS (
  SELECT n.route_id, lo, hi, island, n.seq, n.ev_t + 300000 AS deadline, greatest(pos, n.seq) AS due, pos
  FROM (SELECT *, ev_t + 310001 AS need FROM isl WHERE near) n ASOF LEFT JOIN passes ON n.need <= passes.ev_t
), nxt AS (
  SELECT x.*, y.seq AS next_seq
  FROM (SELECT *, CASE WHEN pos IS NOT NULL THEN due END AS fires_at FROM nearobs) x
  ASOF LEFT JOIN nearobs y
    ON x.route_id = y.route_id AND x.lo = y.lo AND x.hi = y.hi AND x.island = y.island AND x.fires_at < y.seq
), chain AS (
  SELECT route_id, lo, hi, island, min(seq) AS s FROM nearobs GROUP BY ALL
  UNION ALL
  SELECT c.route_id, c.lo, c.hi, c.island, n.next_seq
  FROM chain c JOIN nxt n ON n.route_id = c.route_id AND n.lo = c.lo AND n.hi = c.hi AND n.island = c.island AND n.seq = c.s
  WHERE n.next_seq IS NOT NULL
), fired AS (
  SELECT n.route_id, n.lo, n.hi, n.deadline, n.fires_at
  FROM chain c JOIN nxt n ON n.route_id = c.route_id AND n.lo = c.lo AND n.hi = c.hi AND n.island = c.island AND n.seq = c.s
  LEFT JOIN closes k ON k.route_id = c.route_id AND k.lo = c.lo AND k.hi = c.hi AND k.island = c.island
  WHERE n.fires_at IS NOT NULL AND (k.close_at IS NULL OR k.close_at > n.fires_at)
), placed AS (
  SELECT f.*, a.ts_iso AS a_ts, a.lat AS a_lat, a.lon AS a_lon, b.lat AS b_lat, b.lon AS b_lon
  FROM fired f
  ASOF JOIN pings a ON a.route_id = f.route_id AND a.bus_id = f.lo AND f.fires_at >= a.seq
  ASOF JOIN pings b ON b.route_id = f.route_id AND b.bus_id = f.hi AND f.fires_at >= b.seq
), measured AS (
  SELECT *, pow(sin(radians(b_lat - a_lat) / 2), 2)
            + cos(radians(a_lat)) * cos(radians(b_lat)) * pow(sin(radians(b_lon - a_lon) / 2), 2) AS h
  FROM placed
)
SELECT 'BUS_BUNCHING' AS "incidentType", lo || ':' || hi AS "entityId", '' AS zone,
       printf('Buses %s and %s on route %s within %.0fm for over 5 minutes', lo, hi, route_id,
              6371000.0 * 2 * atan2(sqrt(h), sqrt(1 - h))) AS description,
       a_ts AS "sourceTimestamp", deadline AS t_ms
FROM measured
""", recursive=True)
ORACLE["bus_bunching_arrival"] = BUS_BUNCHING_ARRIVAL


# The feed: the three detector queries (each with its own CTEs) unioned.
INCIDENTS = "\nUNION ALL\n".join(
    f"SELECT * FROM ({q}) d{i}" for i, q in enumerate((AQI_EMERGENCY, GRIDLOCK, BUS_BUNCHING))
)
INCIDENT_JSON = (
    'SELECT "incidentType", "entityId", zone, description, "sourceTimestamp", '
    'CAST(0 AS BIGINT) AS "detectedAtMillis" FROM (' + INCIDENTS + ") feed"
)
ORACLE["incidents"] = INCIDENTS
ORACLE["incident_json"] = INCIDENT_JSON


# -- streaming forms -------------------------------------------------------------
# Append mode emits a window once the final watermark (max event time - delay)
# has reached its end; update mode's last emission per key is the batch value.

_MAX_T = ("(SELECT CAST(1704067200000 + (max(epoch_us(ts)) // 1000 - 1704067200000) // 60 AS BIGINT) "
          "FROM events)")


def _closed(sql: str, delay_ms: int, extra: str = "") -> str:
    return (f"SELECT * FROM ({sql}) w WHERE epoch_ms(strptime(window_end, '%Y-%m-%d %H:%M:%S')) "
            f"<= {_MAX_T} - {delay_ms}{extra}")


FANOUT = _q("""
SELECT s.subscriber, seq, junction_id, signal_phase, vehicle_count
FROM traffic_signals, (VALUES ('HIGH_PRIORITY'), ('STANDARD_PRIORITY')) s(subscriber)
""")


# Several months of readings (30 days of events, stretched fourfold), without a
# power factor in every 13th; the history holds the closed 15-minute windows.
_HISTORY = """
WITH months AS (
  SELECT 'WARD-' || CAST(user_id % 5 + 1 AS VARCHAR) AS ward_id,
         CAST(1704067200000 + (epoch_us(ts) // 1000 - 1704067200000) * 4 AS BIGINT) AS t_ms,
         value / CAST(100 AS DOUBLE) AS kwh_reading,
         CAST(220 AS DOUBLE) + (event_id % 201) / CAST(10 AS DOUBLE) AS voltage,
         CASE WHEN event_id % 13 <> 0 THEN CAST(0.7 AS DOUBLE) + (event_id % 31) / CAST(100 AS DOUBLE) END AS power_factor
  FROM events
), smart_meters AS (
  SELECT * FROM months WHERE (t_ms // 900000 + 1) * 900000 <= (SELECT max(t_ms) FROM months) - 2700000
)
"""


def _rollup_sql(unit: str) -> str:
    return _HISTORY + (f"""
SELECT ward_id,
       strftime(date_trunc('{unit}', make_timestamp(t_ms * 1000)), {TS}) AS period_start,
       round(sum(kwh_reading), 6) AS total_kwh_consumed,
       round(avg(power_factor) + 1e-9, 6) AS avg_power_factor,
       round(max(voltage), 6) AS peak_voltage,
       count(*) AS n_readings
FROM smart_meters
GROUP BY ward_id, date_trunc('{unit}', make_timestamp(t_ms * 1000))
""")


ORACLE.update({
    "ward_energy_stream_append": _closed(WARD_ENERGY, 45 * 60 * 1000),
    "ward_energy_stream_update": WARD_ENERGY,
    "ward_history_pruned": WARD_ENERGY.replace(PRELUDE, _HISTORY).replace(
        "FROM smart_meters", "FROM smart_meters WHERE ward_id = 'WARD-3' AND t_ms >= epoch_ms(TIMESTAMP '2024-03-01')"),
    "health_advisory_stream": _closed(HEALTH_ADVISORY, 5 * 60 * 1000),
    "aqi_emergency_stream": AQI_EMERGENCY,
    "route_enrichment_stream": ROUTE_ENRICHMENT,
    "dlq_stream": DLQ_ENVELOPE,
    "dlq_malformed_stream": DLQ_MALFORMED,
    "gridlock_stream": GRIDLOCK,
    "bus_bunching_stream": BUS_BUNCHING,
    "bus_bunching_expiring_stream": BUS_BUNCHING_EXPIRING,
    "priority_fanout": FANOUT,
    "ward_energy_weekly": _rollup_sql("week"),
    "ward_energy_monthly": _rollup_sql("month"),
})


# Late rows: slices of the offset range, every 50th record three slices late; a
# row is dropped when behind the late-event watermark of its batch, which in
# Spark lags one batch (max event time up to two batches back - 10 s); windows
# closed by the final watermark.
LATE_ROWS = _q(f"""
, bounds AS (SELECT min(seq) AS lo, max(seq) AS hi FROM traffic_signals
), staged AS (
  SELECT t.t_ms,
         (t.seq - b.lo) // ((b.hi - b.lo) // 4 + 1) + CASE WHEN t.seq % 50 = 7 THEN 3 ELSE 0 END AS batch
  FROM traffic_signals t, bounds b
), batch_max AS (
  SELECT batch, max(t_ms) AS mx FROM staged GROUP BY batch
), wm AS (
  SELECT batch, max(mx) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - 10000 AS wm_before
  FROM batch_max
), kept AS (
  SELECT s.t_ms FROM staged s JOIN wm ON s.batch = wm.batch
  WHERE wm.wm_before IS NULL OR s.t_ms > wm.wm_before
)
SELECT strftime(make_timestamp(t_ms // 60000 * 60000 * 1000), {TS}) AS window_start,
       strftime(make_timestamp((t_ms // 60000 + 1) * 60000 * 1000), {TS}) AS window_end,
       count(*) AS n_rows
FROM kept
GROUP BY t_ms // 60000
HAVING (t_ms // 60000 + 1) * 60000 <= (SELECT max(t_ms) FROM traffic_signals) - 10000
""")
ORACLE["late_rows"] = LATE_ROWS

# The own bound of a batch: the greatest event time of all batches before it - 10 s.
ORACLE["late_feed"] = _q(f"""
, bounds AS (SELECT min(seq) AS lo, max(seq) AS hi FROM traffic_signals
), staged AS (
  SELECT t.t_ms, (t.seq - b.lo) // ((b.hi - b.lo) // 4 + 1) + CASE WHEN t.seq % 50 = 7 THEN 3 ELSE 0 END AS batch
  FROM traffic_signals t, bounds b
), tops AS (SELECT batch, max(t_ms) AS top FROM staged GROUP BY batch
), bounded AS (SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 10000 AS bound FROM tops
), split AS (
  SELECT t_ms // 60000 AS minute, coalesce(t_ms <= bound, false) AS late, coalesce((t_ms // 60000 + 1) * 60000 <= bound, false) AS closed
  FROM staged JOIN bounded USING (batch)
)
SELECT strftime(make_timestamp(minute * 60000 * 1000), {TS}) AS window_start,
       count(*) FILTER (NOT late) AS n_on_time, count(*) FILTER (late) AS n_late,
       count(*) FILTER (late AND closed) AS n_after_close, count(*) AS n_rows
FROM split GROUP BY minute HAVING count(*) FILTER (late) > 0
""")

_CLOSED_WARDS = _closed(WARD_ENERGY, 45 * 60 * 1000)
ORACLE["stream_batch_diff"] = f"""
SELECT side, count(*) AS n_rows, 0 AS n_unmatched
FROM ({_CLOSED_WARDS}) w, (VALUES ('stream_only'), ('batch_only')) AS s(side) GROUP BY side
"""
ORACLE["ward_history_corrected"] = _CLOSED_WARDS
ORACLE["ward_rollup_corrected"] = _q(f"""
, closed AS (
  SELECT *, date_trunc('week', make_timestamp(t_ms // 900000 * 900000 * 1000)) AS period FROM smart_meters
  WHERE (t_ms // 900000 + 1) * 900000 <= (SELECT max(t_ms) FROM smart_meters) - 2700000
)
SELECT ward_id, strftime(period, {TS}) AS period_start, round(sum(kwh_reading), 6) AS total_kwh_consumed,
       round(avg(power_factor) + 1e-9, 6) AS avg_power_factor, round(max(voltage), 6) AS peak_voltage, count(*) AS n_readings
FROM closed GROUP BY ward_id, period
""")
ORACLE["signal_silence"] = _q("""
, heard AS (
  SELECT junction_id, t_ms, lead(t_ms) OVER (PARTITION BY junction_id ORDER BY t_ms, seq) AS next_t FROM traffic_signals
)
SELECT junction_id, t_ms AS last_t_ms, t_ms + 1800000 AS due_t_ms FROM heard
WHERE (next_t IS NULL OR next_t > t_ms + 1800000) AND t_ms + 1800000 < (SELECT max(t_ms) FROM traffic_signals) - 10000
""")
ORACLE["signal_silence_stream"] = ORACLE["signal_silence"]


# Update-mode advisories: per micro-batch (offset slice) the cumulative mean of
# every (zone, window) that received readings; published when above 150; the
# consumer keeps the last publication per key.
HEALTH_ADVISORY_STREAM_UPDATE = _q(f""", {_AQI_WINDOWS.strip().replace("SELECT zone, aqi,", "SELECT seq, zone, aqi,")}
, bounds AS (SELECT min(seq) AS lo, max(seq) AS hi FROM air_quality
), batched AS (
  SELECT a.zone, a.aqi, a.window_end_ms, (a.seq - b.lo) // ((b.hi - b.lo) // 4 + 1) AS batch
  FROM aqi_w a, bounds b
), touched AS (
  SELECT DISTINCT zone, window_end_ms, batch FROM batched
), cumulative AS (
  SELECT t.zone, t.window_end_ms, t.batch, avg(x.aqi) AS rolling_avg_aqi
  FROM touched t JOIN batched x
    ON x.zone = t.zone AND x.window_end_ms = t.window_end_ms AND x.batch <= t.batch
  GROUP BY t.zone, t.window_end_ms, t.batch
), published AS (
  SELECT *, row_number() OVER (PARTITION BY zone, window_end_ms ORDER BY batch DESC) AS rn
  FROM cumulative WHERE rolling_avg_aqi > 150
)
SELECT p.zone, strftime(make_timestamp(p.window_end_ms * 1000), {TS}) AS window_end,
       round(p.rolling_avg_aqi, 6) AS rolling_avg_aqi, z.population, z.num_schools
FROM published p JOIN zone_profile z ON p.zone = z.zone
WHERE p.rn = 1
""")
ORACLE["health_advisory_stream_update"] = HEALTH_ADVISORY_STREAM_UPDATE

ORACLE["incidents_stream"] = INCIDENTS
