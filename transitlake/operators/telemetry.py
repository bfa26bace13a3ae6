"""Fetch telemetry: outcome, delays, counters, histograms, per-feed status, missed ticks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from transitlake.functions.hashing import in_shard, md5_mod
from transitlake.functions.times import seconds_between, seconds_since

# Statuses that are not worth a retry, and exception classes of the HTTP client.
NOT_RETRYABLE = (400, 401, 403, 404, 410)
TIMEOUTS = ("TimeoutException", "ConnectTimeout", "ReadTimeout", "WriteTimeout", "PoolTimeout")
TRANSPORT_ERRORS = (
    "TransportError", "NetworkError", "ConnectError", "ReadError", "WriteError", "CloseError",
    "ProtocolError", "LocalProtocolError", "RemoteProtocolError", "ProxyError", "UnsupportedProtocol",
)

# Histogram bounds.
TIMING = (0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0, 15.0, 20.0, 25.0, 30.0)
FETCH_SECONDS = (0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0)
FETCH_BYTES = (1000.0, 10000.0, 50000.0, 100000.0, 500000.0, 1000000.0)
UPLOAD_SECONDS = (0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)

# How late a poll may start before it is dropped.
MISFIRE_GRACE_SECONDS = 5.0

LABELS = ("feed_id", "feed_type", "agency")


def _status_label() -> Column:
    return F.concat(F.lit("http_"), F.col("status_code").cast("string"))


def classify(log: DataFrame) -> DataFrame:
    """Add ``fetch_ok``, ``error_type`` (NULL on success) and ``retryable``.

    A status in the fixed list is final; then timeouts and other transport failures; then any other
    status outside 2xx, which is retried; anything else that failed is unknown.
    """
    status, failure = F.col("status_code"), F.col("exception_class")
    final = F.coalesce(status.isin(*NOT_RETRYABLE), F.lit(False))
    error = (
        F.when(final, _status_label())
        .when(failure.isin(*TIMEOUTS), "timeout")
        .when(failure.isin(*TRANSPORT_ERRORS), "transport")
        .when(status.isNotNull() & ~status.between(200, 299), _status_label())
        .when(failure.isNotNull() | status.isNull(), "unknown")
    )
    return (
        log.withColumn("error_type", error)
        .withColumn("fetch_ok", F.col("error_type").isNull())
        .withColumn("retryable", ~F.col("fetch_ok") & ~final & (F.col("error_type") != "unknown"))
    )


def with_delays(log: DataFrame) -> DataFrame:
    """Add scheduler, queue, total and processing time in seconds."""
    return log.withColumns(
        {
            "scheduler_delay": seconds_between(F.col("scheduled_ts"), F.col("start_ts")),
            "queue_delay": seconds_between(F.col("start_ts"), F.col("acquired_ts")),
            "total_delay": seconds_between(F.col("scheduled_ts"), F.col("acquired_ts")),
            "processing_seconds": seconds_between(F.col("acquired_ts"), F.col("end_ts")),
        }
    )


def _labelled(log: DataFrame) -> DataFrame:
    agency = F.coalesce(F.nullif(F.col("agency"), F.lit("")), F.lit("unknown"))
    return log.withColumn("agency", agency)


def counters(classified: DataFrame) -> DataFrame:
    """Attempts and results of fetches and uploads per feed. An upload follows a good fetch only."""
    uploaded = F.col("fetch_ok") & F.coalesce("upload_ok", F.lit(False))
    return _labelled(classified).groupBy(*LABELS).agg(
        F.count("*").alias("fetch_total"),
        F.count_if("fetch_ok").alias("fetch_success"),
        F.count_if(~F.col("fetch_ok")).alias("fetch_errors"),
        F.count_if("fetch_ok").alias("upload_total"),
        F.count_if(uploaded).alias("upload_success"),
        F.count_if(F.col("fetch_ok") & ~uploaded).alias("upload_errors"),
        F.coalesce(F.sum(F.when(uploaded, F.col("content_length"))), F.lit(0)).alias("processed_bytes"),
    )


def error_counters(classified: DataFrame) -> DataFrame:
    """Failures per feed, stage (fetch or upload) and error label."""
    upload_failed = F.col("fetch_ok") & ~F.coalesce("upload_ok", F.lit(False))
    stage = F.when(~F.col("fetch_ok"), "fetch").when(upload_failed, "upload")
    label = F.when(F.col("fetch_ok"), F.col("upload_error")).otherwise(F.col("error_type"))
    failures = _labelled(classified).select(*LABELS, stage.alias("stage"), label.alias("error_type"))
    return failures.where(F.col("stage").isNotNull()).groupBy(*LABELS, "stage", "error_type").agg(
        F.count("*").alias("errors")
    )


def byte_counters(classified: DataFrame) -> DataFrame:
    """Bytes fetched and stored per feed and content type."""
    stored = classified.where(F.col("fetch_ok") & F.coalesce("upload_ok", F.lit(False)))
    kind = F.coalesce(F.nullif(F.col("content_type"), F.lit("")), F.lit("unknown"))
    return _labelled(stored).withColumn("content_type", kind).groupBy(*LABELS, "content_type").agg(
        F.coalesce(F.sum("content_length"), F.lit(0)).alias("processed_bytes")
    )


def histogram_set(
    log: DataFrame, metrics: dict[str, tuple[Column, Sequence[float]]], labels: Sequence[str] = LABELS
) -> DataFrame:
    """Cumulative histograms: observations at or below each bound, their count and sum per label set.

    All buckets of all metrics are counted side by side in one aggregate and turned into rows
    afterwards, so the log is read once and never multiplied. NULL values are no observations, and a
    label set without observations has no rows.
    """
    values = log.select(
        *labels, *(value.cast("double").alias(f"v{m}") for m, (value, _) in enumerate(metrics.values()))
    )
    aggregates, rows = [], []
    for m, (metric, (_, bounds)) in enumerate(metrics.items()):
        v = F.col(f"v{m}")
        aggregates += [F.count_if(v <= bound).alias(f"v{m}b{i}") for i, bound in enumerate(bounds)]
        aggregates += [F.count(v).alias(f"v{m}n"), F.sum(v).alias(f"v{m}s")]
        steps = [(str(bound), F.col(f"v{m}b{i}")) for i, bound in enumerate(bounds)]
        for le, count in [*steps, ("+Inf", F.col(f"v{m}n"))]:
            rows.append(
                F.struct(
                    F.lit(metric).alias("metric"), F.lit(le).alias("le"), count.alias("count"),
                    F.col(f"v{m}n").alias("observations"), F.col(f"v{m}s").alias("sum"),
                )
            )
    wide = values.groupBy(*labels).agg(*aggregates)
    return wide.select(*labels, F.inline(F.array(*rows))).where(F.col("observations") > 0)


def histograms(classified: DataFrame) -> DataFrame:
    """All fetch histograms, told apart by ``metric``."""
    log = _labelled(with_delays(classified))
    stored = F.col("fetch_ok") & F.coalesce("upload_ok", F.lit(False))

    def when_fetched(name: str) -> Column:
        return F.when(F.col("fetch_ok"), F.col(name))

    return histogram_set(
        log,
        {
            "fetch_duration_seconds": (when_fetched("duration_ms") / 1000.0, FETCH_SECONDS),
            "fetch_bytes": (when_fetched("content_length"), FETCH_BYTES),
            "upload_duration_seconds": (F.when(stored, F.col("upload_seconds")), UPLOAD_SECONDS),
            "scheduler_delay_seconds": (F.col("scheduler_delay"), TIMING),
            "queue_delay_seconds": (F.col("queue_delay"), TIMING),
            "total_delay_seconds": (F.col("total_delay"), TIMING),
            "processing_time_seconds": (when_fetched("processing_seconds"), TIMING),
        },
    )


def last_times(classified: DataFrame) -> DataFrame:
    """Last attempt and last full success (fetch and upload) per feed."""
    done = F.col("fetch_ok") & F.coalesce("upload_ok", F.lit(False))
    return classified.groupBy("feed_id").agg(
        F.max("end_ts").alias("last_attempt"),
        F.max(F.when(done, F.col("end_ts"))).alias("last_success"),
    )


def feed_status(registry: DataFrame, classified: DataFrame, now: Column) -> DataFrame:
    """Seconds since the last success of every registered feed; NULL when there was none."""
    seen = last_times(classified).select("feed_id", "last_success")
    return registry.join(seen, "feed_id", "left").select(
        "feed_id", "agency_id", "feed_type", "interval_seconds",
        seconds_since(F.col("last_success"), now).alias("last_success_seconds_ago"),
    )


def feeds_by_shard(registry: DataFrame, shards: int) -> DataFrame:
    """Feeds and poll jobs of every worker that has any, in one pass over the registry."""
    shard = md5_mod(F.col("feed_id"), F.lit(shards)).alias("shard")
    return registry.groupBy(shard).agg(F.count("*").alias("active_feeds"), F.count("*").alias("scheduler_jobs"))


def active_feeds(registry: DataFrame, shard: int = 0, shards: int = 1) -> DataFrame:
    """Feeds and poll jobs of one worker; every feed has one job."""
    own = registry.where(in_shard(F.col("feed_id"), shard, shards))
    return own.agg(F.count("*").alias("active_feeds"), F.count("*").alias("scheduler_jobs"))


def latest_ticks(log: DataFrame, interval: Column | int, grace: float = MISFIRE_GRACE_SECONDS) -> DataFrame:
    """Of the polls planned in the same interval only the last, unless it started too late.

    ``interval`` is in seconds: one for all feeds, or a column such as the interval of each feed. A feed
    whose interval is NULL or zero has one bucket, NULL.
    """
    seconds = F.nullif(interval if isinstance(interval, Column) else F.lit(interval), F.lit(0))
    bucket = F.floor(F.unix_micros("scheduled_ts") / (seconds * F.lit(1_000_000).cast("bigint")))
    last = log.groupBy("feed_id", bucket.alias("bucket")).agg(
        F.max_by(F.struct("scheduled_ts", "start_ts"), F.struct("scheduled_ts", "start_ts")).alias("tick"),
        F.count("*").alias("planned"),
    )
    return last.select("feed_id", "bucket", "tick.*", "planned").where(
        seconds_between(F.col("scheduled_ts"), F.col("start_ts")) <= grace
    )
