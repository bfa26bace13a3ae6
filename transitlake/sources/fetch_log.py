"""Fetch event log: JSON lines written by the pollers, one event per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from transitlake.functions.paths import path_stem
from transitlake.functions.times import iso_timestamp
from transitlake.operators.telemetry import TRANSPORT_ERRORS
from transitlake.schemas import EVENT_LOG, FETCH_LOG, struct

# Event names of a fetch and of its upload.
FETCH_EVENTS = (
    "fetch_success", "fetch_non_retryable", "fetch_timeout", "fetch_transport_error",
    "fetch_http_error", "fetch_unknown_error",
)
UPLOAD_EVENTS = ("upload_success", "upload_error")


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Events as a batch."""
    return spark.read.schema(EVENT_LOG).json(path)


def stream_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Events as a stream of new log files."""
    return spark.readStream.schema(EVENT_LOG).json(path)


def _error_type() -> Column:
    event, status = F.col("event"), F.col("status_code").cast("string")
    return (
        F.when(event.isin("fetch_non_retryable", "fetch_http_error"), F.concat(F.lit("http_"), status))
        .when(event == "fetch_timeout", "timeout")
        .when(event == "fetch_transport_error", "transport")
        .when(event == "fetch_unknown_error", "unknown")
        .when(event == "upload_error", F.col("error_type"))
    )


def fetch_events(events: DataFrame) -> DataFrame:
    """Known events with their stage and error label; other log lines are left out."""
    stage = F.when(F.col("event").isin(*FETCH_EVENTS), "fetch").when(
        F.col("event").isin(*UPLOAD_EVENTS), "upload"
    )
    return events.select(
        stage.alias("stage"), "event", "feed_id", "feed_type",
        iso_timestamp(F.col("timestamp")).alias("ts"),
        F.col("event").endswith("_success").alias("ok"), _error_type().alias("error_type"),
        F.coalesce(F.col("duration_ms") / 1000.0, "duration_seconds").alias("seconds"),
        "content_length", "path",
    ).where(F.col("stage").isNotNull())


def event_counts(events: DataFrame) -> DataFrame:
    """Attempts, successes, errors and bytes per feed, stage and error label."""
    return (
        fetch_events(events)
        .groupBy("feed_id", "stage", "error_type")
        .agg(
            F.count("*").alias("attempts"),
            F.count_if("ok").alias("successes"),
            F.coalesce(F.sum("content_length"), F.lit(0)).alias("bytes"),
        )
    )


def attempts(events: DataFrame, records: DataFrame, feeds: DataFrame) -> DataFrame:
    """One row per fetch in the columns of FETCH_LOG, from the event log and the fetch records.

    A fetch that was stored is known from its fetch record and, where it was logged, the upload event of the same
    path. One that failed, or that was fetched but not stored, is known from its error event. ``fetch_success`` has
    no key in common with the upload that follows it, so it adds no row: bytes and duration of fetches
    that were not stored stay NULL, as do the times that nobody logs. ``feeds`` (feed_id, feed_type, agency_id)
    names type and agency where an event does not.
    """
    uploads = events.where(F.col("event") == "upload_success").select(
        path_stem(F.col("path")).alias("stem"), iso_timestamp(F.col("timestamp")).alias("end_ts"),
        F.col("duration_seconds").alias("upload_seconds"),
    )
    # A path is written once in a sound log; the aggregate keeps the join 1:1 in any other.
    uploads = uploads.groupBy("stem").agg(F.max("end_ts").alias("end_ts"), F.max("upload_seconds").alias("upload_seconds"))
    at = iso_timestamp(F.col("fetch_timestamp"))
    stored = records.join(uploads, "stem", "left").select(
        "feed_id", "feed_type", F.col("agency_id").alias("agency"), F.coalesce("end_ts", at).alias("end_ts"),
        at.alias("fetch_ts"), F.col("response_code").alias("status_code"), "duration_ms", "content_length", "content_type",
        F.lit(True).alias("upload_ok"), "upload_seconds",
    )

    event, failure = F.col("event"), F.col("error_type")
    unstored = event == "upload_error"
    exception = (
        F.when(event == "fetch_timeout", "TimeoutException")
        .when(event == "fetch_transport_error", F.when(failure.isin(*TRANSPORT_ERRORS), failure).otherwise("TransportError"))
        .when(event == "fetch_unknown_error", F.coalesce(failure, F.lit("Exception")))
    )
    known = feeds.select(
        F.col("feed_id").alias("known_id"), F.col("feed_type").alias("known_type"), F.col("agency_id").alias("agency")
    ).dropDuplicates(["known_id"])
    failed = events.where(unstored | (event.isin(*FETCH_EVENTS) & (event != "fetch_success")))
    failed = failed.join(known, F.col("feed_id") == F.col("known_id"), "left").select(
        "feed_id", F.coalesce("feed_type", "known_type").alias("feed_type"), "agency",
        iso_timestamp(F.col("timestamp")).alias("end_ts"),
        F.when(unstored, 200).otherwise(F.col("status_code")).alias("status_code"), exception.alias("exception_class"),
        F.when(unstored, F.lit(False)).alias("upload_ok"), F.when(unstored, failure).alias("upload_error"),
    )
    both = stored.unionByName(failed, allowMissingColumns=True)
    columns = [
        (F.col(c.name) if c.name in both.columns else F.lit(None)).cast(c.dataType).alias(c.name) for c in struct(FETCH_LOG)
    ]
    return both.select(*columns)
