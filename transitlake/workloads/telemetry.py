"""Fetch telemetry checks: every event is one poll of the feed of its user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from transitlake.functions.times import seconds_between
from transitlake.functions import utc_stamp
from transitlake.operators.telemetry import (
    byte_counters,
    classify,
    counters,
    error_counters,
    feed_status,
    histograms,
    last_times,
    latest_ticks,
    with_delays,
)
from transitlake.session import work_folder
from transitlake.sinks.raw import fetch_record
from transitlake.sources.fetch_log import attempts, event_counts, read_event_log
from transitlake.sources.raw import fetch_records
from transitlake.workloads.tables import micros, rounded, table

# Status, exception and upload result of a poll by the last digits of its "k" property.
_STATUS = {0: 404, 1: 429, 2: 503, 3: 304, 4: 410}
_FAILURES = {5: "ReadTimeout", 6: "ConnectError", 7: "ValueError"}


def fetch_log(events: DataFrame) -> DataFrame:
    """Poll results of the declared columns from events (a batch or a stream)."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    status, failure = F.lit(200), F.lit(None).cast("string")
    for digit, value in _STATUS.items():
        status = F.when(k % 10 == digit, F.lit(value)).otherwise(status)
    for digit, value in _FAILURES.items():
        failure = F.when(k % 10 == digit, F.lit(value)).otherwise(failure)
    u, us = F.col("user_id"), F.unix_micros("ts")
    value_ms = F.round(F.col("value") * 1000).cast("bigint")
    scheduled = F.floor(us / 1_000_000) * 1_000_000
    acquired = us + value_ms * 10
    return events.select(
        "event_id",
        F.concat(F.lit("feed-"), u.cast("string")).alias("feed_id"),
        F.col("event_type").alias("feed_type"),
        F.when(u % 4 == 0, None).when(u % 4 == 1, "").otherwise(F.concat(F.lit("agency-"), (u % 4).cast("string"))).alias("agency"),
        F.timestamp_micros(scheduled).alias("scheduled_ts"),
        F.timestamp_micros(us).alias("start_ts"),
        F.timestamp_micros(acquired).alias("acquired_ts"),
        F.timestamp_micros(acquired + value_ms * 100).alias("end_ts"),
        F.timestamp_micros(acquired).alias("fetch_ts"),
        F.when(k % 10 < 5, status).when(k % 10 >= 8, 200).alias("status_code"),
        failure.alias("exception_class"),
        F.round(F.col("value") * 50, 2).alias("duration_ms"),
        (value_ms * 10).alias("content_length"),
        F.when(k % 3 == 0, None).when(k % 3 == 1, "").otherwise("application/x-protobuf").alias("content_type"),
        (k < 90).alias("upload_ok"),
        F.when(k >= 90, F.when(k % 2 == 0, "TimeoutError").otherwise("ConnectionError")).alias("upload_error"),
        (value_ms / 1e5).alias("upload_seconds"),
    )


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch_log(table(spark, sf_dir, "events"))


_POLLS = """
raw AS (
  SELECT *, json_extract_string(props, '$.k')::BIGINT AS k, epoch_us(ts) AS us, round(value * 1000)::BIGINT AS ms
  FROM events),
polls AS (
  SELECT event_id, user_id, 'feed-' || user_id AS feed_id, event_type AS feed_type, k, ms,
    CASE WHEN user_id % 4 > 1 THEN 'agency-' || (user_id % 4) ELSE 'unknown' END AS agency,
    us // 1000000 * 1000000 AS scheduled, us AS started, us + ms * 10 AS acquired, us + ms * 110 AS ended,
    CASE k % 10 WHEN 0 THEN 'http_404' WHEN 1 THEN 'http_429' WHEN 2 THEN 'http_503' WHEN 3 THEN 'http_304'
         WHEN 4 THEN 'http_410' WHEN 5 THEN 'timeout' WHEN 6 THEN 'transport' WHEN 7 THEN 'unknown' END AS error_type,
    k % 10 >= 8 AS fetch_ok, k < 90 AS upload_ok, round(value * 50, 2) AS duration_ms, ms * 10 AS content_length,
    CASE WHEN k % 3 = 2 THEN 'application/x-protobuf' ELSE 'unknown' END AS content_type,
    CASE WHEN k >= 90 THEN CASE WHEN k % 2 = 0 THEN 'TimeoutError' ELSE 'ConnectionError' END END AS upload_error,
    ms / 1e5 AS upload_seconds
  FROM raw)"""


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = ("scheduler_delay", "queue_delay", "total_delay", "processing_seconds")
    return with_delays(classify(polls(spark, sf_dir))).select(
        "event_id", "fetch_ok", "error_type", "retryable", *(rounded(F.col(name), 6).alias(name) for name in seconds)
    )


OUTCOMES = f"""
WITH {_POLLS}
SELECT event_id, fetch_ok, error_type, k % 10 IN (1, 2, 3, 5, 6) AS retryable,
       round((started - scheduled) / 1e6, 6) AS scheduler_delay, round((acquired - started) / 1e6, 6) AS queue_delay,
       round((acquired - scheduled) / 1e6, 6) AS total_delay, round((ended - acquired) / 1e6, 6) AS processing_seconds
FROM polls"""


def fetch_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters(classify(polls(spark, sf_dir)))


FETCH_COUNTERS = f"""
WITH {_POLLS}
SELECT feed_id, feed_type, agency, count(*) AS fetch_total, count(*) FILTER (WHERE fetch_ok) AS fetch_success,
       count(*) FILTER (WHERE NOT fetch_ok) AS fetch_errors, count(*) FILTER (WHERE fetch_ok) AS upload_total,
       count(*) FILTER (WHERE fetch_ok AND upload_ok) AS upload_success,
       count(*) FILTER (WHERE fetch_ok AND NOT upload_ok) AS upload_errors,
       coalesce(sum(content_length) FILTER (WHERE fetch_ok AND upload_ok), 0)::BIGINT AS processed_bytes
FROM polls GROUP BY ALL"""


def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return error_counters(classify(polls(spark, sf_dir)))


ERRORS = f"""
WITH {_POLLS}
SELECT feed_id, feed_type, agency, 'fetch' AS stage, error_type, count(*) AS errors
FROM polls WHERE NOT fetch_ok GROUP BY ALL
UNION ALL
SELECT feed_id, feed_type, agency, 'upload', upload_error, count(*)
FROM polls WHERE fetch_ok AND NOT upload_ok GROUP BY ALL"""


def processed_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_counters(classify(polls(spark, sf_dir)))


PROCESSED_BYTES = f"""
WITH {_POLLS}
SELECT feed_id, feed_type, agency, content_type, sum(content_length)::BIGINT AS processed_bytes
FROM polls WHERE fetch_ok AND upload_ok GROUP BY ALL"""


def fetch_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histograms(classify(polls(spark, sf_dir))).withColumn("sum", rounded(F.col("sum"), 6))


def _histogram_sql() -> str:
    from transitlake.operators.telemetry import FETCH_BYTES, FETCH_SECONDS, TIMING, UPLOAD_SECONDS

    metrics = {
        "fetch_duration_seconds": ("duration_ms / 1000.0", "fetch_ok", FETCH_SECONDS),
        "fetch_bytes": ("content_length", "fetch_ok", FETCH_BYTES),
        "upload_duration_seconds": ("upload_seconds", "fetch_ok AND upload_ok", UPLOAD_SECONDS),
        "scheduler_delay_seconds": ("(started - scheduled) / 1e6", "true", TIMING),
        "queue_delay_seconds": ("(acquired - started) / 1e6", "true", TIMING),
        "total_delay_seconds": ("(acquired - scheduled) / 1e6", "true", TIMING),
        "processing_time_seconds": ("(ended - acquired) / 1e6", "fetch_ok", TIMING),
    }
    parts = []
    for metric, (value, condition, bounds) in metrics.items():
        labels = ", ".join(f"('{bound}', {bound}::DOUBLE)" for bound in bounds)
        parts.append(f"""
SELECT feed_id, feed_type, agency, '{metric}' AS metric, le, count(*) FILTER (WHERE v <= bound) AS count,
       count(*) AS observations, round(sum(v), 6) AS sum
FROM (SELECT feed_id, feed_type, agency, ({value})::DOUBLE AS v FROM polls WHERE {condition}),
     (VALUES {labels}, ('+Inf', 'infinity'::DOUBLE)) b(le, bound)
GROUP BY ALL""")
    return f"WITH {_POLLS} " + " UNION ALL ".join(parts)


# The time at which feeds are looked at: after the last event.
NOW_US = 1_706_745_600_000_000


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as registered feeds: more of them than have ever been polled."""
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("feed-"), c.cast("string")).alias("feed_id"),
        F.concat(F.lit("agency-"), F.col("c_nationkey").cast("string")).alias("agency_id"),
        F.col("c_mktsegment").alias("feed_type"), (c % 60 + 5).cast("int").alias("interval_seconds"),
    )


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.timestamp_micros(F.lit(NOW_US))
    return feed_status(_registry(spark, sf_dir), classify(polls(spark, sf_dir)), now)


_LAST = """
last AS (
  SELECT feed_id, max(ended) AS last_attempt_us, max(ended) FILTER (WHERE fetch_ok AND upload_ok) AS last_success_us
  FROM polls GROUP BY feed_id)"""

STATUS = f"""
WITH {_POLLS}, {_LAST}
SELECT 'feed-' || c_custkey AS feed_id, 'agency-' || c_nationkey AS agency_id, c_mktsegment AS feed_type,
       (c_custkey % 60 + 5)::INT AS interval_seconds,
       round(({NOW_US} - last_success_us) / 1e6, 1) AS last_success_seconds_ago
FROM customer LEFT JOIN last ON last.feed_id = 'feed-' || c_custkey"""


def last_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_times(classify(polls(spark, sf_dir))).select(
        "feed_id", micros(F.col("last_attempt")).alias("last_attempt_us"), micros(F.col("last_success")).alias("last_success_us")
    )


LAST_SEEN = f"WITH {_POLLS}, {_LAST} SELECT * FROM last"

# The lateness that drops a poll. Intervals of the feeds are some hours, by their number.
GRACE = 0.5


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.substring_index("feed_id", "-", -1).cast("bigint")
    return latest_ticks(polls(spark, sf_dir), (number % 5 + 2) * 3600, GRACE).select(
        "feed_id", "bucket", micros(F.col("scheduled_ts")).alias("scheduled_us"),
        rounded(seconds_between(F.col("scheduled_ts"), F.col("start_ts")), 6).alias("late"), "planned",
    )


TICKS = f"""
WITH {_POLLS},
t AS (SELECT feed_id, scheduled // ((user_id % 5 + 2) * 3600000000) AS bucket, max([scheduled, started]) AS tick, count(*) AS planned
      FROM polls GROUP BY ALL)
SELECT feed_id, bucket, tick[1] AS scheduled_us, round((tick[2] - tick[1]) / 1e6, 6) AS late, planned
FROM t WHERE (tick[2] - tick[1]) / 1e6 <= {GRACE}"""


def _log_lines(polled: DataFrame) -> DataFrame:
    """Log lines of polls: one for the fetch and, after a good one, one for the upload."""
    log = classify(polled)
    label = F.col("error_type")
    event = (
        F.when(F.col("fetch_ok"), "fetch_success")
        .when(F.col("status_code").isin(404, 410), "fetch_non_retryable")
        .when(label == "timeout", "fetch_timeout")
        .when(label == "transport", "fetch_transport_error")
        .when(label == "unknown", "fetch_unknown_error")
        .otherwise("fetch_http_error")
    )
    stage = F.explode(F.when(F.col("fetch_ok"), F.array(F.lit("fetch"), F.lit("upload"))).otherwise(F.array(F.lit("fetch"))))
    both = log.select("*", event.alias("fetch_event"), stage.alias("stage"))
    upload = F.col("stage") == "upload"

    def only(condition: Column, value: Column) -> Column:
        return F.when(condition, value)

    return both.select(
        F.when(upload, F.when(F.col("upload_ok"), "upload_success").otherwise("upload_error")).otherwise(F.col("fetch_event")).alias("event"),
        "feed_id",
        only(~upload, F.col("feed_type")).alias("feed_type"),
        only(~upload & F.col("fetch_ok"), F.col("duration_ms")).alias("duration_ms"),
        only(~upload & F.col("fetch_ok"), F.col("content_length")).alias("content_length"),
        only(~upload, F.col("status_code")).alias("status_code"),
        F.when(upload, F.col("upload_error")).otherwise(F.col("exception_class")).alias("error_type"),
        utc_stamp(F.col("end_ts")).alias("timestamp"),
        only(upload & F.col("upload_ok"), F.concat(_poll_stem(), F.lit(".pb"))).alias("path"),
        only(upload & F.col("upload_ok"), F.col("upload_seconds")).alias("duration_seconds"),
    )


def _poll_stem() -> Column:
    return F.concat_ws("/", "feed_type", F.col("event_id").cast("string"))


def _written_lines(spark: SparkSession, polled: DataFrame, name: str) -> DataFrame:
    path = f"{work_folder(spark, name)}/log"
    _log_lines(polled).write.json(path)
    return read_event_log(spark, path)


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls written as log lines and read back from them."""
    return event_counts(_written_lines(spark, polls(spark, sf_dir), "event-log"))


def logged_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of attempts that are put together from log lines and fetch records. A feed for each user and type."""
    feed = F.concat_ws("-", "feed_id", "feed_type")
    polled = polls(spark, sf_dir).withColumn("feed_id", feed)
    nothing = F.lit(None).cast("string")
    stored = classify(polled).where("fetch_ok AND upload_ok").select(
        "*", F.col("agency").alias("agency_id"), F.col("agency").alias("agency_name"), nothing.alias("system_id"),
        nothing.alias("system_name"), nothing.alias("schedule_url"), nothing.alias("url"),
        F.create_map(F.lit("Content-Type"), "content_type").alias("headers"),
    )
    documents = stored.select("feed_type", _poll_stem().alias("stem"), fetch_record(stored).alias("document"))
    feeds = polled.select("feed_id", "feed_type", F.col("agency").alias("agency_id")).distinct()
    lines = _written_lines(spark, polled, "attempts")
    return counters(classify(attempts(lines, fetch_records(documents), feeds)))


EVENT_LOG = f"""
WITH {_POLLS},
lines AS (
  SELECT feed_id, 'fetch' AS stage, error_type, fetch_ok AS ok, CASE WHEN fetch_ok THEN content_length END AS bytes FROM polls
  UNION ALL
  SELECT feed_id, 'upload', upload_error, upload_ok, NULL FROM polls WHERE fetch_ok)
SELECT feed_id, stage, error_type, count(*) AS attempts, count(*) FILTER (WHERE ok) AS successes,
       coalesce(sum(bytes), 0)::BIGINT AS bytes
FROM lines GROUP BY ALL"""

LOGGED_COUNTERS = FETCH_COUNTERS.replace("SELECT feed_id, feed_type", "SELECT feed_id || '-' || feed_type AS feed_id, feed_type")

QUERIES = {
    "fetch_outcomes": outcomes,
    "fetch_counters": fetch_counters,
    "error_counters": errors,
    "processed_bytes": processed_bytes,
    "fetch_histograms": fetch_histograms,
    "feed_status": status,
    "last_times": last_seen,
    "latest_ticks": ticks,
    "fetch_event_log": event_log,
    "logged_counters": logged_counters,
}

ORACLES = {
    "fetch_outcomes": OUTCOMES,
    "fetch_counters": FETCH_COUNTERS,
    "error_counters": ERRORS,
    "processed_bytes": PROCESSED_BYTES,
    "fetch_histograms": _histogram_sql(),
    "feed_status": STATUS,
    "last_times": LAST_SEEN,
    "latest_ticks": TICKS,
    "fetch_event_log": EVENT_LOG,
    "logged_counters": LOGGED_COUNTERS,
}
