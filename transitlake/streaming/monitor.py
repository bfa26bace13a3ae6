"""Streams over fetch results and schedule checks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from transitlake.operators.telemetry import classify
from transitlake.sinks.statetable import MERGE_EVERY, batch_name, read_state, write_change


def last_success_stream(log: DataFrame) -> DataFrame:
    """Last attempt and last full success per feed, kept as state of one row per feed."""
    done = F.col("fetch_ok") & F.coalesce("upload_ok", F.lit(False))
    return classify(log).groupBy("feed_id").agg(
        F.max("end_ts").alias("last_attempt"),
        F.max(F.when(done, F.col("end_ts"))).alias("last_success"),
    )


# Days behind the newest check for which a stream still gives ingest requests, and so keeps their keys.
VERSION_DAYS = 30


def new_version_requests(checks: DataFrame, keep_days: int = VERSION_DAYS) -> DataFrame:
    """Ingest requests from a stream of check results: the new versions, each request once.

    Which results were handled is kept by the checkpoint of the stream, for ``keep_days`` days behind the newest check.
    An older result gives no request here; the next check finds its version again as long as it is not stored.
    """
    new = checks.where(F.col("status") == "new").withWatermark("checked_at", f"{keep_days} days")
    key = F.concat_ws("_", F.lit("schedule_ingest"), F.unix_micros("checked_at").cast("string"), "feed_key")
    keyed = new.select(key.alias("run_key"), "schedule_url", "feed_key", "_feed_digest", "checked_at")
    return keyed.dropDuplicates(["run_key", "checked_at"]).drop("checked_at")


def write_latest(updates: DataFrame, out: str, checkpoint: str, keys: tuple[str, ...], merge_every: int = MERGE_EVERY) -> DataStreamWriter:
    """Keep the newest state of an update stream below ``out``, as a table of newest rows (``sinks.statetable``).

    A micro-batch that is repeated after a failure changes nothing; folders are merged as they come, so there are never many.
    """
    schema = ", ".join(f"`{name}` {kind}" for name, kind in updates.dtypes)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_change(batch, out, batch_name(batch_id), keys, schema, merge_every)

    return updates.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)


def read_latest(updates: DataFrame, out: str, keys: tuple[str, ...]) -> DataFrame:
    """Newest row of each key of what ``write_latest`` wrote from ``updates``."""
    return read_state(updates.sparkSession, out, keys, ", ".join(f"`{name}` {kind}" for name, kind in updates.dtypes))


STALE = "feed_id STRING, last_success_ms BIGINT, stale_ms BIGINT"


class Staleness(StatefulProcessor):
    """Last success of a feed as state, with a timer for the moment from which the feed is stale.

    A success puts the timer off. When event time passes it, the feed is reported; where the next success is read before the timer
    could fire, the gap between the two is reported instead. No gap is reported twice.
    """

    def __init__(self, after_ms: int) -> None:
        self.after_ms = after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at BIGINT, reported BOOLEAN")

    def _row(self, key: tuple, at: int) -> pd.DataFrame:
        return pd.DataFrame({"feed_id": [key[0]], "last_success_ms": [at], "stale_ms": [at + self.after_ms]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        times = np.unique(np.concatenate([chunk["success_ms"].dropna().to_numpy(np.int64) for chunk in rows]))
        at, reported = self.last.get() if self.last.exists() else (None, False)
        before = at
        for time in times.tolist():
            if at is not None and time <= at:
                # Older than what is known: changes nothing.
                continue
            if at is not None and time - at > self.after_ms and not reported:
                yield self._row(key, at)
            at, reported = time, False
        if at is not None and at != before:
            if before is not None:
                self.handle.deleteTimer(before + self.after_ms)
            self.handle.registerTimer(at + self.after_ms)
            self.last.update((at, reported))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at, reported = self.last.get()
        if not reported and at + self.after_ms == expiredTimerInfo.getExpiryTimeInMs():
            self.last.update((at, True))
            yield self._row(key, at)


def stale_feeds(log: DataFrame, after_seconds: int, late: str = "0 seconds") -> DataFrame:
    """Feeds that had no full success for ``after_seconds``, each time that happens, as soon as the stream has passed that moment.

    One row of state and one timer for each feed, however many polls come in. Polls have to come in about as they end: what ends
    more than ``late`` before the last end of the parts before it is left out. Start the query under the settings of
    ``session.keyed_state``.
    """
    done = F.col("fetch_ok") & F.coalesce("upload_ok", F.lit(False))
    polls = classify(log).withWatermark("end_ts", late).select("feed_id", "end_ts", F.when(done, F.unix_millis("end_ts")).alias("success_ms"))
    return polls.groupBy("feed_id").transformWithStateInPandas(Staleness(after_seconds * 1000), STALE, "Append", "EventTime")
