"""Bounded pieces: of Arrow batches, of raw archives that a query lands, of streams over one large file."""

from __future__ import annotations

import datetime
import os
import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

from check_oracles import compare  # noqa: E402
from transitlake.operators.batches import gathered, pieces, python_rows  # noqa: E402
from transitlake.operators.schedules import version_rows  # noqa: E402
from transitlake.streaming.ingest import flatten_stream, stream_rows  # noqa: E402
from transitlake.sinks.raw import snapshot_rows  # noqa: E402
from transitlake.workloads import realtime, schedule, streams  # noqa: E402
from transitlake.workloads.tables import spread_stream, stream  # noqa: E402


def test_python_rows():
    kind = pa.struct([("a", pa.list_(pa.struct([("x", pa.int64()), ("t", pa.string()), ("f", pa.float32())]))), ("b", pa.bool_())])
    rows = [{"a": [{"x": 1, "t": None, "f": 0.5}, None], "b": True}, None, {"a": None, "b": None}, {"a": [], "b": False}, {"a": [{"x": None, "t": "é", "f": None}], "b": True}]
    column = pa.array(rows, kind)
    assert python_rows(column) == rows
    for start in range(5):
        assert python_rows(column.slice(start, 2)) == rows[start : start + 2]
    assert python_rows(column.slice(0, 0)) == []


def test_pieces():
    batch = pa.RecordBatch.from_pydict({"n": list(range(2_500))})
    found = list(pieces([batch, batch.slice(0, 0)]))
    assert [p.num_rows for p in found] == [1000, 1000, 500, 0] and found[2].column("n")[0].as_py() == 2000
    assert [b.num_rows for b in gathered(found, 1_500)] == [2000, 500]


@pytest.fixture
def tables(tmp_path):
    """24 events of two days in one row group, among them unreadable and empty snapshots."""
    noon = datetime.datetime(2024, 1, 11, 11, 50)
    ids = [*range(20), 51, 52, 52, 101]
    pq.write_table(pa.table({
        "event_id": pa.array(ids, pa.int64()),
        "ts": pa.array([noon + datetime.timedelta(minutes=37 * (i % 24)) for i in range(24)], pa.timestamp("us")),
        "user_id": pa.array([i % 6 for i in ids], pa.int64()), "event_type": ["view"] * 24,
        "value": [i / 8 for i in ids], "props": ["{}"] * 24,
    }), tmp_path / "events.parquet")
    names = ["c_custkey", "c_name", "c_mktsegment"]
    pq.write_table(pa.table({"c_custkey": pa.array(range(60), pa.int64()), "c_name": [f"n{i}" for i in range(60)], "c_mktsegment": ["M"] * 60}).select(names), tmp_path / "customer.parquet")
    return str(tmp_path)


def _sql(tables, text):
    db = duckdb.connect()
    for name in ("events", "customer"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    result = db.execute(text)
    return [d[0] for d in result.description], result.fetchall()


@pytest.mark.parametrize("name", ["archive_runs", "stream_archive_positions"])
def test_raw_files_are_bounded(spark, tables, monkeypatch, name):
    """no more snapshots lie in the raw archive at a time than a part has, and all are dropped in the end."""
    seen = []
    module = realtime if name == "archive_runs" else streams
    drop = module.drop_objects

    def watched(session, root):
        seen.append(sum(f.endswith(".pb") for _, _, files in os.walk(root.removeprefix("file:")) for f in files))
        drop(session, root)
        assert not os.path.exists(root)

    monkeypatch.setattr(realtime, "LANDED_SNAPSHOTS", 10)
    monkeypatch.setattr(module, "drop_objects", watched)
    frame = module.QUERIES[name](spark, tables)
    rows = [tuple(row) for row in frame.collect()]
    assert len(seen) > 2 and max(seen) <= 10 and sum(seen) == 24
    assert compare(frame.columns, rows, *_sql(tables, module.ORACLES[name])) == ""


def test_stream_of_one_row_group_is_spread(spark, tables, tmp_path):
    """F21"""
    tasks = []
    for number, rows in enumerate((stream(spark, tables, "events"), spread_stream(spark, tables, "events"))):
        writer = rows.writeStream.option("checkpointLocation", f"{tmp_path}/s{number}")
        writer.foreachBatch(lambda batch, _: tasks.append((batch.rdd.getNumPartitions(), batch.count()))).trigger(availableNow=True).start().awaitTermination()
    assert tasks == [(1, 24), (4, 24)]


def test_large_day_of_a_stream_is_cut(spark, tables, tmp_path):
    """a feed and day is no longer one task however large it is."""
    rows = {}
    for size in (800, 1 << 20):
        snapshots = snapshot_rows(realtime.vehicle_fetches(stream(spark, tables, "events").withColumn("user_id", F.lit(1).cast("bigint"))))
        flatten_stream(snapshots, f"{tmp_path}/{size}", f"{tmp_path}/s{size}", ("vehicle_positions",), size).trigger(availableNow=True).start().awaitTermination()
        files = [f for _, _, names in os.walk(f"{tmp_path}/{size}/vehicle_positions/batch=0/kind=rows/date=2024-01-11") for f in names if f.endswith(".parquet")]
        rows[size] = len(files), sorted(stream_rows(spark, f"{tmp_path}/{size}", "vehicle_positions").select("source_file", "entity_id").collect())
    assert rows[800][0] > 1 == rows[1 << 20][0] and rows[800][1] == rows[1 << 20][1]


def test_archives_are_made_once(spark, tables, monkeypatch):
    """F23"""
    calls, make = [], schedule.archives
    monkeypatch.setattr(schedule, "archives", lambda *args: calls.append(1) or make(*args))
    frame = schedule.schedule_routes(spark, tables)
    assert compare(frame.columns, [tuple(row) for row in frame.collect()], *_sql(tables, schedule.SCHEDULE_ROUTES)) == ""
    assert len(calls) == 1


def test_version_rows_are_not_sorted(spark):
    """the catalogue sorts its lines, so versions need no order before."""
    columns = "schedule_url string, base64url string, path string, _feed_digest string, date_retrieved string, feed_start_date string, feed_end_date string"
    found = version_rows(spark.createDataFrame([("u", "b", "p2", None, None, None, None), ("u", "a", "p1", "d", "2024", None, None)], columns))
    assert "Sort [schedule_url" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.path, r.base64url, r._feed_digest, r.date_retrieved) for r in found.collect()) == [("p1", "a", "d", "2024"), ("p2", "a", "", "")]


def test_next_part_is_landed_while_one_is_worked_on(spark, tables, tmp_path, monkeypatch):
    """two raw archives at most, and no part waits for the landing of the one after it."""
    monkeypatch.setattr(realtime, "LANDED_SNAPSHOTS", 6)
    done, there = [], []

    def work(raw, last):
        if not done:
            # The second archive comes while the first is still there.
            deadline = time.monotonic() + 60
            while not os.path.exists(f"{tmp_path}/raw-1") and time.monotonic() < deadline:
                time.sleep(0.1)
        there.append(sorted(name for name in os.listdir(tmp_path) if name.startswith("raw-")))
        done.append(last)

    realtime.by_parts(realtime.archive_events(spark, tables), F.lpad(F.col("event_id").cast("string"), 3, "0"), str(tmp_path), work, realtime.drop_objects)
    assert len(done) >= 4 and done == sorted(done) and done[-1] == "101"
    assert there[0] == ["raw-0", "raw-1"] and max(map(len, there)) <= 2
    assert not [name for name in os.listdir(tmp_path) if name.startswith("raw-")]


def test_snapshots_are_made_once(spark, tables, tmp_path, monkeypatch):
    """objects and sidecars come from the same encoded snapshots."""
    made = spark.sparkContext.accumulator(0)
    fetches = realtime.vehicle_fetches

    def counted(events):
        def seen(batches):
            for batch in batches:
                made.add(batch.num_rows)
                yield batch

        rows = fetches(events)
        return rows.mapInArrow(seen, rows.schema)

    monkeypatch.setattr(realtime, "vehicle_fetches", counted)
    realtime.land_archive(realtime.archive_events(spark, tables), str(tmp_path / "raw"))
    assert made.value == 24
    assert len(list((tmp_path / "raw").rglob("*.pb"))) == 24 > len(list((tmp_path / "raw").rglob("*.meta"))) > 0
