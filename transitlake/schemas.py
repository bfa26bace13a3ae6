"""Schemas of the archive: raw snapshots, decoded feed, the three flat tables, the dimensions."""

from __future__ import annotations

from pyspark.sql import types as T
from pyspark.sql.types import _parse_datatype_string as _parse  # DDL text to StructType

# The three feed types of the archive.
FEED_TYPES = ("vehicle_positions", "trip_updates", "service_alerts")

# --- raw layer -------------------------------------------------------------------------------

# Columns of the binary file source, then the partition columns of the raw layout. The partition
# columns are declared because inference reads an all-digit base64url as an integer.
BINARY_FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
RAW_PARTITIONS = "date DATE, hour STRING, base64url STRING"

SIDECAR = (
    "feed_id STRING, agency_id STRING, agency_name STRING, system_id STRING, system_name STRING, "
    "schedule_url STRING, url STRING, fetch_timestamp STRING, duration_ms DOUBLE, "
    "response_code INT, content_length BIGINT, content_type STRING, headers MAP<STRING, STRING>"
)

# --- decoded feed ----------------------------------------------------------------------------

_TRIP = (
    "STRUCT<trip_id: STRING, route_id: STRING, direction_id: BIGINT, start_time: STRING, "
    "start_date: STRING, schedule_relationship: INT>"
)
_VEHICLE = "STRUCT<id: STRING, label: STRING, license_plate: STRING>"
_POSITION = "STRUCT<latitude: FLOAT, longitude: FLOAT, bearing: FLOAT, odometer: DOUBLE, speed: FLOAT>"
_EVENT = "STRUCT<delay: INT, time: BIGINT, uncertainty: INT>"
_TEXT = "STRUCT<translation: ARRAY<STRUCT<text: STRING>>>"

FEED_MESSAGE = f"""STRUCT<
  header: STRUCT<timestamp: BIGINT>,
  entity: ARRAY<STRUCT<
    id: STRING,
    vehicle: STRUCT<
      trip: {_TRIP}, vehicle: {_VEHICLE}, position: {_POSITION},
      current_stop_sequence: BIGINT, stop_id: STRING, current_status: INT, timestamp: BIGINT,
      congestion_level: INT, occupancy_status: INT, occupancy_percentage: BIGINT>,
    trip_update: STRUCT<
      trip: {_TRIP}, vehicle: {_VEHICLE}, timestamp: BIGINT, delay: INT,
      stop_time_update: ARRAY<STRUCT<
        stop_sequence: BIGINT, stop_id: STRING, arrival: {_EVENT}, departure: {_EVENT},
        schedule_relationship: INT>>>,
    alert: STRUCT<
      cause: INT, effect: INT, severity_level: INT,
      active_period: ARRAY<STRUCT<start: BIGINT, end: BIGINT>>,
      header_text: {_TEXT}, description_text: {_TEXT}, url: {_TEXT},
      informed_entity: ARRAY<STRUCT<
        agency_id: STRING, route_id: STRING, route_type: INT, stop_id: STRING, trip: {_TRIP}>>>
  >>>"""

# --- compacted tables ------------------------------------------------------------------------

_PROVENANCE = (
    "source_file STRING NOT NULL, feed_url STRING NOT NULL, feed_timestamp BIGINT, "
    "fetch_timestamp TIMESTAMP, entity_id STRING NOT NULL, "
)

VEHICLE_POSITIONS = _PROVENANCE + (
    "trip_id STRING, route_id STRING, direction_id BIGINT, start_time STRING, start_date STRING, "
    "schedule_relationship INT, vehicle_id STRING, vehicle_label STRING, license_plate STRING, "
    "latitude FLOAT, longitude FLOAT, bearing FLOAT, odometer DOUBLE, speed FLOAT, "
    "current_stop_sequence BIGINT, stop_id STRING, current_status INT, timestamp BIGINT, "
    "congestion_level INT, occupancy_status INT, occupancy_percentage BIGINT"
)

TRIP_UPDATES = _PROVENANCE + (
    "trip_id STRING, route_id STRING, direction_id BIGINT, start_time STRING, start_date STRING, "
    "schedule_relationship INT, vehicle_id STRING, vehicle_label STRING, trip_timestamp BIGINT, "
    "trip_delay INT, stop_sequence BIGINT, stop_id STRING, arrival_delay INT, arrival_time BIGINT, "
    "arrival_uncertainty INT, departure_delay INT, departure_time BIGINT, "
    "departure_uncertainty INT, stop_schedule_relationship INT"
)

SERVICE_ALERTS = _PROVENANCE + (
    "cause INT, effect INT, severity_level INT, active_period_start BIGINT, "
    "active_period_end BIGINT, header_text STRING, description_text STRING, url STRING, "
    "agency_id STRING, route_id STRING, route_type INT, stop_id STRING, trip_id STRING, "
    "trip_route_id STRING, trip_direction_id BIGINT"
)

TABLES = dict(zip(FEED_TYPES, (VEHICLE_POSITIONS, TRIP_UPDATES, SERVICE_ALERTS)))

# --- dimensions and catalogue ----------------------------------------------------------------

FEEDS = (
    "base64url STRING NOT NULL, url STRING NOT NULL, feed_type STRING NOT NULL, "
    "feed_id STRING NOT NULL, feed_name STRING NOT NULL, agency_id STRING NOT NULL, "
    "agency_name STRING NOT NULL, system_id STRING, system_name STRING, "
    "interval_seconds INT NOT NULL, schedule_url STRING, schedule_urls STRING"
)

INVENTORY = (
    "url STRING, base64url STRING, agency_id STRING, agency_name STRING, system_id STRING, "
    "system_name STRING, feed_type STRING, date_min STRING, date_max STRING, "
    "total_records BIGINT, total_bytes BIGINT"
)

SCHEDULE_VERSION = (
    "schedule_url STRING, _feed_digest STRING, date_retrieved STRING, feed_start_date STRING, "
    "feed_end_date STRING"
)

SCHEDULE_DOCUMENT = (
    "schedule_url STRING, base64url STRING, versions ARRAY<STRUCT<_feed_digest: STRING, "
    "date_retrieved: STRING, feed_start_date: STRING, feed_end_date: STRING>>"
)

# The schedule tables that are exposed for queries.
SCHEDULE_TABLES = (
    "agency", "stops", "routes", "trips", "stop_times", "calendar", "calendar_dates", "shapes",
    "feed_info",
)

_AUTH = "STRUCT<type: STRING, secret_name: STRING, key: STRING, value: STRING>"
_RETRY = "STRUCT<max_attempts: INT, backoff_base: DOUBLE, backoff_max: DOUBLE>"
_FEED = (
    "STRUCT<feed_type: STRING, url: STRING, name: STRING, interval_seconds: INT, "
    f"timeout_seconds: INT, retry: {_RETRY}, auth: {_AUTH}>"
)
AGENCIES = (
    "id STRING, name STRING, schedule_url STRING, schedule_urls ARRAY<STRING>, "
    f"auth {_AUTH}, feeds ARRAY<{_FEED}>, systems ARRAY<STRUCT<id: STRING, name: STRING, "
    f"schedule_url: STRING, schedule_urls: ARRAY<STRING>, auth: {_AUTH}, feeds: ARRAY<{_FEED}>>>"
)

FETCH_LOG = (
    "feed_id STRING, feed_type STRING, agency STRING, scheduled_ts TIMESTAMP, start_ts TIMESTAMP, "
    "acquired_ts TIMESTAMP, end_ts TIMESTAMP, fetch_ts TIMESTAMP, status_code INT, "
    "exception_class STRING, duration_ms DOUBLE, content_length BIGINT, content_type STRING, "
    "upload_ok BOOLEAN, upload_error STRING, upload_seconds DOUBLE"
)

EVENT_LOG = (
    "event STRING, timestamp STRING, level STRING, feed_id STRING, feed_type STRING, "
    "duration_ms DOUBLE, content_length BIGINT, status_code INT, error_type STRING, "
    "error_message STRING, path STRING, duration_seconds DOUBLE"
)


def struct(ddl: str) -> T.StructType:
    """The StructType of a DDL text (needs an active session)."""
    return _parse(ddl)
