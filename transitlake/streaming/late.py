"""Late snapshots as work: hours are counted until they close, and what comes later asks for its day to be compacted again.

The clock of the stream is the latest fetch time of the micro-batches before. An hour is closed once the clock is ``late_hours``
past its end. Counts, requests and the clock are tables of newest rows, changed once for each micro-batch, the clock last: a
micro-batch that is repeated after a failure finds what it found before and writes the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from transitlake.functions.codec import base64url_decode, feed_key
from transitlake.sinks.statetable import batch_name, holds, read_state, write_change
from transitlake.streaming.ingest import LATE_HOURS

HOURS = "feed_type STRING, hour_start TIMESTAMP, snapshots BIGINT, bytes BIGINT"
HOUR_KEYS = ("feed_type", "hour_start")
REQUESTS = "run_key STRING, feed_type STRING, date STRING, feed_key STRING, late_snapshots BIGINT, batches BIGINT, clock_us BIGINT"
REQUEST_KEYS = ("run_key",)
CLOCK = "name STRING, at_us BIGINT"
_HOUR = 3_600_000_000


def read_clock(spark: SparkSession, out: str) -> int | None:
    """The clock of the stream in epoch microseconds, None before its first micro-batch."""
    row = read_state(spark, f"{out}/clock", ("name",), CLOCK).first()
    return None if row is None else row.at_us


def read_hours(spark: SparkSession, out: str) -> DataFrame:
    """Snapshots and bytes of each feed type and hour that came in time."""
    return read_state(spark, f"{out}/hours", HOUR_KEYS, HOURS)


def read_requests(spark: SparkSession, out: str) -> DataFrame:
    """A request for each type, day and feed with late snapshots: how many, in how many micro-batches, and the clock at the last."""
    return read_state(spark, f"{out}/requests", REQUEST_KEYS, REQUESTS)


def _added(old: DataFrame, new: DataFrame, keys: tuple[str, ...], sums: tuple[str, ...]) -> DataFrame:
    """``new`` with the sums that ``old`` has for the same keys added. Only keys of ``new`` remain."""
    before = old.select(*keys, *(F.col(name).alias(f"old_{name}") for name in sums))
    joined = new.join(before, list(keys), "left")
    added = {name: F.col(name) + F.coalesce(f"old_{name}", F.lit(0)) for name in sums}
    return joined.select(*(added.get(name, F.col(name)).alias(name) for name in new.columns))


def watch_hours(snapshots: DataFrame, out: str, checkpoint: str, late_hours: int = LATE_HOURS) -> DataStreamWriter:
    """Count snapshots (feed_type, date, base64url, fetch_timestamp, length) below ``out/hours``, and ask for days to be compacted
    again below ``out/requests``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, batch_name(batch_id)
        if holds(spark, f"{out}/clock", name):
            return
        clock = read_clock(spark, out)
        hour = F.floor(F.unix_micros("fetch_timestamp") / _HOUR) * _HOUR
        closed = F.lit(False) if clock is None else hour + (1 + late_hours) * _HOUR <= clock
        batch = batch.withColumns({"hour_start": F.timestamp_micros(hour), "late": closed}).persist()
        try:
            latest = batch.agg(F.max(F.unix_micros("fetch_timestamp"))).first()[0]
            if latest is None:
                return
            counts = batch.where(~F.col("late")).groupBy(*HOUR_KEYS).agg(
                F.count("*").alias("snapshots"), F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("bytes")
            )
            counts = _added(read_hours(spark, out), counts, HOUR_KEYS, ("snapshots", "bytes"))
            write_change(counts, f"{out}/hours", name, HOUR_KEYS, HOURS)
            day, key = F.col("date").cast("string"), feed_key(base64url_decode(F.col("base64url")))
            late = batch.where("late").groupBy(
                F.concat_ws("_", "feed_type", day, key).alias("run_key"), "feed_type", day.alias("date"), key.alias("feed_key")
            ).agg(F.count("*").alias("late_snapshots"), F.lit(1).cast("bigint").alias("batches"))
            late = _added(read_requests(spark, out), late, REQUEST_KEYS, ("late_snapshots", "batches"))
            write_change(late.withColumn("clock_us", F.lit(clock).cast("bigint")), f"{out}/requests", name, REQUEST_KEYS, REQUESTS)
            now = latest if clock is None else max(latest, clock)
            tick = spark.range(1).select(F.lit("stream").alias("name"), F.lit(now).cast("bigint").alias("at_us"))
            write_change(tick, f"{out}/clock", name, ("name",), CLOCK)
        finally:
            batch.unpersist()

    return snapshots.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
