from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from transitlake.operators.telemetry import (
    TIMING,
    byte_counters,
    classify,
    counters,
    error_counters,
    feed_status,
    histogram_set,
    histograms,
    last_times,
    latest_ticks,
)
from transitlake.schemas import FETCH_LOG, struct
from transitlake.sources.fetch_log import event_counts, fetch_events, read_event_log

T0 = datetime(2025, 1, 15, 14, 0, 0, tzinfo=timezone.utc)


@pytest.fixture
def log(spark):
    names = struct(FETCH_LOG).names

    def make(*rows):
        base = {
            "feed_id": "f", "feed_type": "trip_updates", "agency": "a", "scheduled_ts": T0, "start_ts": T0,
            "acquired_ts": T0, "end_ts": T0, "fetch_ts": T0, "status_code": 200, "duration_ms": 100.0,
            "content_length": 10, "upload_ok": True, "upload_seconds": 0.1,
        }
        return spark.createDataFrame([tuple({**base, **r}.get(n) for n in names) for r in rows], FETCH_LOG)

    return make


@pytest.mark.parametrize(
    ("row", "error", "retryable"),
    [
        ({}, None, False),
        ({"status_code": 404}, "http_404", False),
        ({"status_code": 410}, "http_410", False),
        ({"status_code": 429}, "http_429", True),
        ({"status_code": 500}, "http_500", True),
        ({"status_code": 301}, "http_301", True),
        ({"status_code": None, "exception_class": "ConnectTimeout"}, "timeout", True),
        ({"status_code": None, "exception_class": "RemoteProtocolError"}, "transport", True),
        ({"status_code": None, "exception_class": "KeyError"}, "unknown", False),
    ],
)
def test_outcomes(log, row, error, retryable):
    found = classify(log(row)).first()
    assert (found.error_type, found.retryable, found.fetch_ok) == (error, retryable, error is None)


def test_counters(log):
    rows = classify(
        log({}, {"agency": None}, {"agency": ""}, {"upload_ok": False, "upload_error": "TimeoutError"}, {"status_code": 503},
            {"content_type": "text/x"}, {"content_type": "", "content_length": None})
    )
    by_agency = {r.agency: r for r in counters(rows).collect()}
    a = by_agency["a"]
    assert (a.fetch_total, a.fetch_success, a.fetch_errors, a.upload_total, a.upload_success, a.upload_errors) == (5, 4, 1, 4, 3, 1)
    assert a.processed_bytes == 20 and by_agency["unknown"].fetch_total == 2
    assert {(r.stage, r.error_type, r.errors) for r in error_counters(rows).collect()} == {("fetch", "http_503", 1), ("upload", "TimeoutError", 1)}
    assert {(r.agency, r.content_type, r.processed_bytes) for r in byte_counters(rows).collect()} == {
        ("a", "unknown", 10), ("a", "text/x", 10), ("unknown", "unknown", 20)
    }


def test_histogram(log):
    rows = log(*({"duration_ms": v} for v in (100.0, 100.1, 250.0, 31000.0)), {"duration_ms": None})
    found = histogram_set(rows, {"m": (F.col("duration_ms") / 1000, TIMING)}, ["feed_id"]).collect()
    counts = {r.le: r["count"] for r in found}
    assert len(found) == len(TIMING) + 1
    assert (counts["0.1"], counts["0.25"], counts["30.0"], counts["+Inf"]) == (1, 3, 3, 4)
    assert found[0].observations == 4 and abs(found[0]["sum"] - 31.4501) < 1e-9


def test_histograms_read_the_log_once(log, spark, tmp_path):
    log({}, {"status_code": 500}).write.parquet(f"{tmp_path}/log")
    frame = histograms(classify(spark.read.parquet(f"{tmp_path}/log")))
    assert frame._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    observed = {r.metric: r.observations for r in frame.collect()}
    assert observed["fetch_duration_seconds"] == 1 and observed["scheduler_delay_seconds"] == 2


def test_status(spark, log):
    rows = classify(log({"end_ts": T0}, {"end_ts": T0 + timedelta(seconds=9), "upload_ok": False}))
    last = last_times(rows).select(F.unix_micros("last_attempt"), F.unix_micros("last_success")).first()
    assert last[0] - last[1] == 9_000_000
    registry = spark.createDataFrame([("f", "a", "trip_updates", 20), ("g", "a", "trip_updates", 20)], "feed_id STRING, agency_id STRING, feed_type STRING, interval_seconds INT")
    now = F.timestamp_micros(F.lit(int(T0.timestamp() * 1e6) + 12_340_000))
    assert {r.feed_id: r.last_success_seconds_ago for r in feed_status(registry, rows, now).collect()} == {"f": 12.3, "g": None}


def test_ticks(log):
    def tick(second, late):
        at = T0 + timedelta(seconds=second)
        return {"scheduled_ts": at, "start_ts": at + timedelta(seconds=late)}

    found = latest_ticks(log(tick(1, 9), tick(19, 5), tick(20, 0), tick(39, 5.1)), 20).collect()
    assert len(found) == 1 and found[0].planned == 2

    rows = log(tick(1, 0), tick(19, 0), tick(20, 0), tick(39, 0)).withColumn("every", F.lit(10))
    assert sorted(r.bucket % 2 for r in latest_ticks(rows, F.col("every")).collect()) == [0, 0, 1, 1]
    (row,) = latest_ticks(rows, F.lit(None).cast("int")).collect()
    assert row.bucket is None and row.planned == 4


def test_event_log(spark, tmp_path):
    (tmp_path / "log.json").write_text(
        "\n".join(
            [
                '{"event": "fetch_success", "feed_id": "f", "duration_ms": 250.0, "content_length": 7, "timestamp": "2025-01-15T14:00:00.5Z", "level": "info"}',
                '{"event": "upload_error", "feed_id": "f", "error_type": "TimeoutError"}',
                '{"event": "fetch_non_retryable", "feed_id": "f", "status_code": 404}',
                '{"event": "fetch_unknown_error", "feed_id": "f", "error_type": "KeyError"}',
                '{"event": "scheduler_started", "active_feeds": 3}',
            ]
        )
    )
    events = read_event_log(spark, str(tmp_path / "log.json"))
    assert [(r.stage, r.ok, r.error_type, r.seconds) for r in fetch_events(events).collect()] == [
        ("fetch", True, None, 0.25), ("upload", False, "TimeoutError", None), ("fetch", False, "http_404", None),
        ("fetch", False, "unknown", None),
    ]
    assert sum(r.attempts for r in event_counts(events).collect()) == 4
