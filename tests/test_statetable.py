"""Tables of newest rows: merges, repeats, readers; and the streams that keep their state in them."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from transitlake.operators.telemetry import last_times, classify
from transitlake.schemas import FETCH_LOG, struct
from transitlake.session import keyed_state, settings
from transitlake.sinks.statetable import batch_name, holds, live_folders, read_state, write_change
from transitlake.streaming.late import read_clock, read_hours, read_requests, watch_hours
from transitlake.streaming.monitor import STALE, last_success_stream, read_latest, stale_feeds, write_latest

KEYS, SCHEMA = ("k",), "k STRING, v BIGINT"
T0 = datetime(2025, 1, 15, 14, 0, 0, tzinfo=timezone.utc)


def run(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


def test_folders_stay_bounded_over_fifty_changes(spark, tmp_path):
    path, expected, most = str(tmp_path / "t"), {}, 0
    for n in range(50):
        rows = [(f"k{(n * 7) % 13}", n), (f"k{n % 5}", n)]
        rows = list(dict(rows).items())
        expected |= dict(rows)
        write_change(spark.createDataFrame(rows, SCHEMA).coalesce(1), path, batch_name(n), KEYS, SCHEMA, merge_every=10)
        most = max(most, len([f for f in (tmp_path / "t").iterdir() if f.is_dir()]))
    assert most <= 22 and len(live_folders(spark, path)) <= 10
    assert {r.k: r.v for r in read_state(spark, path, KEYS, SCHEMA).collect()} == expected


def test_repeats_and_torn_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_state(spark, path, KEYS, SCHEMA).count() == 0 and not holds(spark, path, batch_name(0))
    one = spark.createDataFrame([("a", 1)], SCHEMA)
    for n in range(3):
        write_change(one.withColumn("v", F.lit(n).cast("bigint")), path, batch_name(n), KEYS, SCHEMA, merge_every=2)
    # Repeated after the merge, and behind it: nothing changes.
    write_change(one.withColumn("v", F.lit(99).cast("bigint")), path, batch_name(1), KEYS, SCHEMA)
    write_change(one.withColumn("v", F.lit(99).cast("bigint")), path, batch_name(2), KEYS, SCHEMA)
    assert read_state(spark, path, KEYS, SCHEMA).first().v == 2
    # A change whose write was not finished does not count, and is written again.
    write_change(one.withColumn("v", F.lit(5).cast("bigint")), path, batch_name(3), KEYS, SCHEMA)
    (tmp_path / "t" / f"delta-{batch_name(3)}" / "_SUCCESS").unlink()
    assert read_state(spark, path, KEYS, SCHEMA).first().v == 2
    write_change(one.withColumn("v", F.lit(6).cast("bigint")), path, batch_name(3), KEYS, SCHEMA)
    assert read_state(spark, path, KEYS, SCHEMA).first().v == 6


def test_a_reader_survives_a_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(2):
        write_change(spark.createDataFrame([("a", n)], SCHEMA), path, batch_name(n), KEYS, SCHEMA, merge_every=3)
    reader = read_state(spark, path, KEYS, SCHEMA)
    write_change(spark.createDataFrame([("a", 2)], SCHEMA), path, batch_name(2), KEYS, SCHEMA, merge_every=3)
    assert live_folders(spark, path) == [f"base-{batch_name(2)}"]
    assert reader.first().v == 1 and read_state(spark, path, KEYS, SCHEMA).first().v == 2


@pytest.fixture
def polls(spark):
    names = struct(FETCH_LOG).names

    def make(*rows):
        """(feed, minutes after T0, success)"""
        made = []
        for feed, minute, ok in rows:
            at = T0 + timedelta(minutes=minute)
            row = {"feed_id": feed, "feed_type": "trip_updates", "end_ts": at, "status_code": 200 if ok else 500, "upload_ok": ok}
            made.append(tuple(row.get(n) for n in names))
        return spark.createDataFrame(made, FETCH_LOG)

    return make


def test_last_success_over_restarts(spark, polls, tmp_path):
    parts = [[("a", 0, True), ("b", 1, False)], [("a", 5, False), ("b", 6, True)], [("a", 2, True), ("c", 7, False)]]
    for part in parts:
        polls(*part).write.mode("append").parquet(f"{tmp_path}/in")
        stream = last_success_stream(spark.readStream.schema(FETCH_LOG).parquet(f"{tmp_path}/in"))
        run(write_latest(stream, f"{tmp_path}/out", f"{tmp_path}/state", ("feed_id",), merge_every=2))
    every = last_times(classify(polls(*[row for part in parts for row in part])))
    found = read_latest(every, f"{tmp_path}/out", ("feed_id",))
    assert found.count() == 3 and found.exceptAll(every).count() == 0


def test_stale_feeds(spark, polls, tmp_path):
    """Feeds that fall silent are reported once each time: inside a part, by a timer, and after a restart."""
    parts = [
        [("a", 0, True), ("b", 0, True), ("c", 0, False), ("b", 20, True), ("a", 45, False)],
        # ``a`` is reported by its timer at minute 30; here it comes back. ``b`` had its last success at minute 20.
        [("a", 46, True), ("b", 49, True), ("a", 47, True)],
        [("b", 100, True), ("a", 60, True), ("a", 10, True)],
        [("d", 200, False)],
    ]
    seen = []
    for part in parts:
        polls(*part).write.mode("append").parquet(f"{tmp_path}/in")
        with settings(spark, **keyed_state(spark)):
            stale = stale_feeds(spark.readStream.schema(FETCH_LOG).parquet(f"{tmp_path}/in"), 30 * 60)
            run(stale.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").option("path", f"{tmp_path}/out"))
        rows = spark.read.schema(STALE).parquet(f"{tmp_path}/out").collect()
        start = int(T0.timestamp() * 1000)
        assert all(r.stale_ms - r.last_success_ms == 30 * 60_000 for r in rows)
        seen.append(sorted((r.feed_id, (r.last_success_ms - start) // 60_000) for r in rows))
    assert seen[0] == [("a", 0)]
    assert seen[1] == [("a", 0)]
    assert seen[2] == [("a", 0), ("a", 60), ("b", 49)]
    assert seen[3] == [("a", 0), ("a", 60), ("b", 49), ("b", 100)]


def test_staleness_loses_no_poll_between_parts(spark, tmp_path):
    """A long poll ends behind the start of the next part, and the log goes on into a second month; no success may be taken for late."""
    from transitlake.workloads.streams import staleness

    def at(day, clock, month=1):
        return datetime.fromisoformat(f"2024-{month:02d}-{day:02d}T{clock}").replace(tzinfo=timezone.utc)

    polls = [(1, at(1, "00:00:00"), 1.0), (2, at(8, "23:59:50"), 500.0), (3, at(9, "00:00:05"), 1.0), (1, at(30, "00:00:00"), 1.0),
             (4, at(3, "00:00:00", 2), 1.0), (5, at(20, "00:00:00", 2), 1.0), (1, at(28, "00:00:00", 2), 1.0)]
    rows = [(n, ts, user, "a", value, '{"k": 8}') for n, (user, ts, value) in enumerate(polls)]
    schema = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    found = sorted((r.feed_id, r.last_success_ms) for r in staleness(spark, str(tmp_path)).collect())
    ends = [(f"feed-{user}", int(ts.timestamp() * 1000) + round(value * 110)) for user, ts, value in polls]
    # All but the very last success are followed by a day of silence.
    assert found == sorted(ends[:-1])


def test_late_snapshots_become_requests(spark, tmp_path):
    """An hour is closed two hours past its end by the clock of the batches before; a repeated batch changes nothing."""
    url = "aHR0cHM6Ly9h"

    def rows(*minutes):
        made = [("trip_updates", (T0 + timedelta(minutes=m)).date().isoformat(), url, T0 + timedelta(minutes=m), 10) for m in minutes]
        schema = "feed_type STRING, date STRING, base64url STRING, fetch_timestamp TIMESTAMP, length BIGINT"
        return spark.createDataFrame(made, schema)

    def arrive(*minutes):
        rows(*minutes).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(rows(0).schema).parquet(f"{tmp_path}/in")
        run(watch_hours(stream, f"{tmp_path}/out", f"{tmp_path}/state"))

    arrive(0, 1, 70)
    arrive(2, 179)
    assert read_requests(spark, f"{tmp_path}/out").count() == 0
    # The clock is at minute 179 now: the hour from 0 to 60 closes at 180.
    arrive(3, 180)
    arrive(4, 5, 71)
    arrive(6)
    (request,) = read_requests(spark, f"{tmp_path}/out").collect()
    assert (request.run_key, request.late_snapshots, request.batches) == ("trip_updates_2025-01-15_a", 3, 2)
    assert request.clock_us == read_clock(spark, f"{tmp_path}/out") == int((T0 + timedelta(minutes=180)).timestamp() * 1_000_000)
    hours = {int(r.s - T0.timestamp()) // 3600: (r.snapshots, r.bytes) for r in read_hours(spark, f"{tmp_path}/out").selectExpr("*", "unix_seconds(hour_start) AS s").collect()}
    assert hours == {0: (4, 40), 1: (2, 20), 2: (1, 10), 3: (1, 10)}


def test_a_batch_that_stops_half_way_is_finished(spark, tmp_path, monkeypatch):
    from transitlake.streaming import late

    made = [("trip_updates", "2025-01-15", "aHR0cHM6Ly9h", T0, 10)]
    schema = "feed_type STRING, date STRING, base64url STRING, fetch_timestamp TIMESTAMP, length BIGINT"
    spark.createDataFrame(made, schema).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    whole = late.write_change

    def torn(rows, path, *rest):
        whole(rows, path, *rest)
        if path.endswith("/requests"):
            raise RuntimeError("stopped")

    monkeypatch.setattr(late, "write_change", torn)
    with pytest.raises(Exception, match="stopped"):
        run(watch_hours(stream, f"{tmp_path}/out", f"{tmp_path}/state"))
    assert read_clock(spark, f"{tmp_path}/out") is None and read_hours(spark, f"{tmp_path}/out").first().snapshots == 1
    monkeypatch.setattr(late, "write_change", whole)
    run(watch_hours(stream, f"{tmp_path}/out", f"{tmp_path}/state"))
    assert read_hours(spark, f"{tmp_path}/out").first().snapshots == 1 and read_clock(spark, f"{tmp_path}/out") is not None
