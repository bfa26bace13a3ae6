from __future__ import annotations

import json
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from transitlake.functions import base64url_encode
from transitlake.operators.layout import SlicePlan, hour_sizes
from transitlake.plans.catalog import add_partitions, create_tables, preview, register_views, with_feed
from transitlake.plans.compaction import compact, compact_run, compact_snapshots
from transitlake.sinks.raw import fetch_record, snapshot_rows
from transitlake.sinks.runs import empties, forget, partition_stats, recover, run_files
from transitlake.sources.archive import list_snapshots, load_snapshots
from transitlake.sources.listing import file_row_counts, partition_row_counts
from transitlake.sources.raw import list_objects, read_sidecars, read_snapshots
from transitlake.sources.tables import read_feeds, read_partition, read_table, read_unsigned

from conftest import URL, URL_B64

DAY = "2024-01-01"


def write_raw(root, feed_type, base64url, stamps, content, meta=None):
    for stamp in stamps:
        hour = stamp[:13] + ":00:00Z"
        folder = root / feed_type / f"date={stamp[:10]}" / f"hour={hour}" / f"base64url={base64url}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{stamp}.pb").write_bytes(content)
        if meta is not None:
            (folder / f"{stamp}.meta").write_text(meta(stamp))


@pytest.fixture
def raw(tmp_path, vehicle_feed, message):
    root = tmp_path / "raw"
    header_only = message(header={"timestamp": 1}).SerializeToString()

    def good(stamp):
        return json.dumps({"feed_id": "x", "fetch_timestamp": stamp.replace("Z", "+00:00")}, indent=2)

    stamps = [f"{DAY}T0{h}:00:{s:02d}.123Z" for h in (3, 4) for s in (0, 20, 40)]
    write_raw(root, "vehicle_positions", URL_B64, stamps, vehicle_feed, good)
    write_raw(root, "vehicle_positions", URL_B64, [f"{DAY}T05:00:00.000Z"], b"not valid protobuf data")
    write_raw(root, "vehicle_positions", URL_B64, [f"{DAY}T05:00:20.000Z"], vehicle_feed, lambda s: "{broken")
    write_raw(root, "vehicle_positions", "MTIz", [f"{DAY}T05:00:00.000Z"], b"", lambda s: '{"content_length": 0}')
    write_raw(root, "vehicle_positions", "MTIz", [f"{DAY}T05:00:20.000Z"], header_only)
    write_raw(root, "vehicle_positions", "MTIzNDU2", ["2024-01-02T00:00:00.000Z"], vehicle_feed)
    return str(root)


def test_scan_and_sidecars(spark, raw):
    found = read_snapshots(spark, raw, "vehicle_positions", [DAY, "2030-01-01"])
    assert found.count() == 9 and read_snapshots(spark, raw, "trip_updates").count() == 0
    names = [r.source_file for r in found.orderBy("source_file").select("source_file").collect()]
    assert names[0] == f"vehicle_positions/date={DAY}/hour={DAY}T03:00:00Z/base64url={URL_B64}/{DAY}T03:00:00.123Z.pb"
    times = {r.stem[-12:]: r.fetch_timestamp for r in read_sidecars(spark, raw, "vehicle_positions").collect()}
    assert len(times) == 8 and sum(t is None for t in times.values()) == 2
    listing = list_objects(spark, raw)
    assert listing.count() == 10 and "content" not in listing.columns


def test_digits_stay_text(spark, tmp_path, vehicle_feed):
    write_raw(tmp_path, "vehicle_positions", "12345678", [f"{DAY}T03:00:00.000Z"], vehicle_feed)
    (row,) = read_snapshots(spark, str(tmp_path), "vehicle_positions").select("base64url").collect()
    assert row.base64url == "12345678"


def test_listing_reads_no_content(spark, raw):
    plan = read_snapshots(spark, raw, "vehicle_positions").drop("content").where(f"date = '{DAY}' AND base64url = 'MTIz'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in text
    assert "PartitionFilters: [isnotnull(date" in text and plan.count() == 1


def test_compact(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    run = compact_run(spark, raw, out, "vehicle_positions", [DAY])
    runs = {r.feed_url: r for r in run.records.collect()}
    assert (runs[URL].files_processed, runs[URL].records_written) == (8, 14)
    assert run.counts == {"rows": 14, "rejected": 1, "empty": 2}
    assert runs[URL].feed == "example.com/feed" and runs[URL].output_path.endswith(f"base64url={URL_B64}")
    empty = runs["https://123"]
    assert (empty.files_processed, empty.records_written, empty.output_path) == (2, 0, None)

    table = read_table(spark, out, "vehicle_positions")
    assert table.count() == 14 and len(table.columns) == 28
    stamped = table.where("fetch_timestamp IS NOT NULL").count()
    assert stamped == 12
    files = file_row_counts(spark, out).collect()
    assert [(f.feed_type, f.date, f.base64url, f.row_count) for f in files] == [("vehicle_positions", DAY, URL_B64, 14)]
    assert files[0].size_bytes > 0
    # One file, its rows in time and feed order.
    rows = read_partition(spark, out, "vehicle_positions", DAY, URL_B64).collect()
    keys = [(r.source_file, r.entity_id) for r in rows]
    assert keys == sorted(keys)
    bad = run.rejected.collect()
    assert len(bad) == 1 and "T05:00:00.000Z" in bad[0].source_file


def test_rerun_replaces_only_its_partitions(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    compact(spark, raw, out, "vehicle_positions")
    before = read_table(spark, out, "vehicle_positions").count()
    compact(spark, raw, out, "vehicle_positions", ["2024-01-02"])
    after = read_table(spark, out, "vehicle_positions")
    assert before == after.count() == 16
    assert {(r.date.isoformat(), r.row_count) for r in partition_row_counts(spark, out, "vehicle_positions").collect()} == {
        (DAY, 14), ("2024-01-02", 2)
    }


def test_records_and_rejects_are_those_of_the_run(spark, raw, tmp_path):
    """Snapshots go bad after the first run: what it left in the table neither counts nor hides them."""
    out = str(tmp_path / "out")
    first = compact_run(spark, raw, out, "vehicle_positions", [DAY])
    assert sum(r.records_written for r in first.records.collect()) == 14
    for file in Path(raw).rglob(f"*base64url={URL_B64}/*.pb"):
        if file.stat().st_size:
            file.write_bytes(b"\xff")
    again = compact_run(spark, raw, out, "vehicle_positions", [DAY])
    runs = {r.feed_url: r for r in again.records.collect()}
    assert (runs[URL].files_processed, runs[URL].records_written, runs[URL].output_path) == (8, 0, None)
    assert read_table(spark, out, "vehicle_positions").count() == 14
    bad = again.rejected.where(f"base64url = '{URL_B64}'").collect()
    assert len(bad) == 8 and {r.error.split(":")[0] for r in bad} == {"DecodeError"}


def test_sidecar_of_zero_bytes_beside_a_snapshot_counts_once(spark, raw, tmp_path):
    file = next(f for f in sorted(Path(raw).rglob(f"date={DAY}/hour=*/base64url={URL_B64}/*.pb")) if f.stat().st_size)
    file.with_suffix(".meta").write_text('{"content_length": 0}')
    runs = compact(spark, raw, str(tmp_path / "out"), "vehicle_positions", [DAY]).collect()
    assert {r.feed_url: r.files_processed for r in runs}[URL] == 8


def test_folder_that_is_no_base64url_is_rejected(spark, vehicle_feed):
    from transitlake.operators.decode import decode_snapshots, quarantine

    schema = "date STRING, base64url STRING, source_file STRING, fetch_timestamp TIMESTAMP, content BINARY"
    rows = spark.createDataFrame([(DAY, "a", "file", None, vehicle_feed)], schema)
    (row,) = quarantine(decode_snapshots(rows, "vehicle_positions")).collect()
    assert row.error == "ValueError: folder name is no base64url"


def test_zstd_files(spark, raw, tmp_path):
    import pyarrow.parquet as pq

    out = tmp_path / "out"
    compact(spark, raw, str(out), "vehicle_positions", [DAY])
    (file,) = (out / "vehicle_positions").rglob("*.parquet")
    assert pq.read_metadata(file).row_group(0).column(0).compression == "ZSTD"
    # The columns of the table and no other.
    assert pq.read_schema(file).names == read_table(spark, str(out), "vehicle_positions").columns[:-2]


def test_hot_feed_is_sliced_and_whole(spark, raw, tmp_path):
    """A feed beyond the slice size is cut by hour and hash; every row is still there."""
    found = read_snapshots(spark, raw, "vehicle_positions", [DAY])
    size = found.where(f"base64url = '{URL_B64}'").agg(F.max("length")).first()[0]
    plan = SlicePlan(found.drop("content"), 2 * size)
    assert plan.hot is not None and plan.partitions >= 4
    slices = plan.apply(found.drop("content")).groupBy("base64url").agg(F.collect_set("slice").alias("s")).collect()
    by_feed = {r.base64url: r.s for r in slices}
    assert by_feed["MTIz"] == [""] and len(by_feed[URL_B64]) >= 3
    # More hot hours than may be broadcast: the same slices by the salted join.
    salted = SlicePlan(found.drop("content"), 2 * size, broadcast_rows=0)
    named = [p.apply(found.drop("content")).select("source_file", "slice") for p in (plan, salted)]
    assert salted.salts > 1 and named[1].count() == named[0].count()
    assert named[0].exceptAll(named[1]).count() == 0
    sizes = hour_sizes(found.drop("content")).where(f"base64url = '{URL_B64}'").collect()
    assert len({r.day_bytes for r in sizes}) == 1

    out = str(tmp_path / "out")
    compact_snapshots(found, out, "vehicle_positions", read_sidecars(spark, raw, "vehicle_positions", [DAY]), 2 * size)
    table = read_table(spark, out, "vehicle_positions")
    assert table.count() == 14 and table.where("fetch_timestamp IS NOT NULL").count() == 12
    assert file_row_counts(spark, out).count() > 1


def test_snapshots_are_shuffled_once(spark, raw):
    from transitlake.plans.compaction import _REUSE_PLACEMENT
    from transitlake.session import settings
    from transitlake.sources.raw import attach_fetch_time

    found, meta = read_snapshots(spark, raw, "vehicle_positions"), read_sidecars(spark, raw, "vehicle_positions")
    plan = SlicePlan(found.drop("content"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", **_REUSE_PLACEMENT):
        joined = attach_fetch_time(plan.place(found), plan.place(meta), plan.keys)
        text = joined._jdf.queryExecution().executedPlan().toString()
        hot = SlicePlan(found.drop("content"), 100)
        cut = attach_fetch_time(hot.place(found), hot.place(meta), hot.keys)

        def shuffles(df, kind):
            return df._jdf.queryExecution().executedPlan().toString().count(kind)

        # Plans are made here, under the settings. The join adds no shuffle to those that place the sides.
        sides = [hot.place(found), hot.place(meta)]
        assert "slice" in hot.keys and shuffles(cut, "REPARTITION_BY_NUM") == 2
        assert shuffles(cut, "ENSURE_REQUIREMENTS") == sum(shuffles(side, "ENSURE_REQUIREMENTS") for side in sides)
        assert text.count("Exchange hash") == 2 and joined.count() == 10 and cut.count() == 10


def test_views_preview_and_dimension_join(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    compact(spark, raw, out, "vehicle_positions")
    feeds = spark.createDataFrame([(URL_B64, URL, "a1", "Agency", None, None, "vehicle_positions")], "base64url STRING, url STRING, agency_id STRING, agency_name STRING, system_id STRING, system_name STRING, feed_type STRING")
    feeds.write.parquet(f"{out}/feeds.parquet")
    assert register_views(spark, out) == ["vehicle_positions", "trip_updates", "service_alerts", "feeds"]
    (row,) = spark.sql(
        "SELECT f.agency_name, count(*) AS n FROM vehicle_positions v JOIN feeds f USING (base64url) GROUP BY 1"
    ).collect()
    assert tuple(row) == ("Agency", 14)
    assert preview(spark, out, "vehicle_positions", DAY, URL_B64, 5).count() == 5
    joined = with_feed(read_table(spark, out, "vehicle_positions"), feeds)
    assert joined.count() == 14 and "agency_id" in joined.columns
    salted = with_feed(read_table(spark, out, "vehicle_positions"), feeds, broadcast_rows=0)
    assert salted.exceptAll(joined).count() == 0 and salted.count() == 14
    assert read_feeds(spark, out).columns[-1] == "load_order" and read_feeds(spark, str(tmp_path)).count() == 0


def test_reading_unsigned_columns(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from transitlake.schemas import VEHICLE_POSITIONS, struct

    kinds = {"feed_timestamp": pa.uint64(), "timestamp": pa.uint64(), "direction_id": pa.uint32()}
    fields = struct(VEHICLE_POSITIONS)
    data = {f.name: pa.array([7 if f.name in kinds else None], kinds.get(f.name, pa.null())) for f in fields}
    data = {n: (a if a.type != pa.null() else pa.array([None], pa.string())) for n, a in data.items()}
    pq.write_table(pa.table(data), tmp_path / "data.parquet")
    table = read_unsigned(spark, str(tmp_path / "data.parquet"), "vehicle_positions")
    assert dict(table.dtypes)["feed_timestamp"] == "bigint" and table.first().timestamp == 7


def test_fetch_record_and_snapshot_rows(spark):
    row = (
        "f", "a", "A", None, None, None, URL, datetime(2025, 1, 15, 14, 20, 30, 120000, timezone.utc), 12.5, 200, 3,
        {"ETag": "e", "Last-Modified": "l", "content-type": "t", "X-Custom": "no"}, "vehicle_positions", b"abc",
    )
    fetches = spark.createDataFrame(
        [row],
        "feed_id STRING, agency_id STRING, agency_name STRING, system_id STRING, system_name STRING, schedule_url STRING, "
        "url STRING, fetch_ts TIMESTAMP, duration_ms DOUBLE, status_code INT, content_length BIGINT, "
        "headers MAP<STRING, STRING>, feed_type STRING, content BINARY",
    )
    record = json.loads(fetches.select(fetch_record(fetches)).first()[0])
    assert record["headers"] == {"ETag": "e", "Last-Modified": "l", "content-type": "t"}
    assert record["fetch_timestamp"] == "2025-01-15T14:20:30.120000+00:00"
    assert record["system_id"] is None and record["content_type"] == "t" and len(record) == 13
    (snapshot,) = snapshot_rows(fetches).collect()
    assert snapshot.hour == "2025-01-15T14:00:00Z" and snapshot.length == 3 and snapshot.base64url == URL_B64
    assert spark.range(1).select(base64url_encode(F.lit(URL))).first()[0] == URL_B64


def test_empty_snapshots_count_without_a_sidecar(spark, raw, tmp_path):
    """Listed in tasks, an object of zero bytes is a snapshot like any other."""
    write_raw(Path(raw), "vehicle_positions", "MTIz", [f"{DAY}T06:00:00.000Z", f"{DAY}T07:00:00.000Z"], b"")
    run = compact_run(spark, raw, str(tmp_path / "out"), "vehicle_positions", [DAY])
    assert {r.feed_url: r.files_processed for r in run.records.collect()} == {URL: 8, "https://123": 4}
    assert sorted(r.source_file[-27:] for r in empties(spark, run.run).collect()) == [
        f"{DAY}T05:00:00.000Z.pb", f"{DAY}T05:00:20.000Z.pb", f"{DAY}T06:00:00.000Z.pb", f"{DAY}T07:00:00.000Z.pb"
    ]


def test_content_is_read_once(spark, raw, tmp_path):
    """Every read of a snapshot leaves a byte in a file of the test: as many as there are snapshots, with rejects and counts."""
    reads = tmp_path / "reads"

    def counted(batches):
        for batch in batches:
            with reads.open("ab") as log:
                log.write(b"." * batch.num_rows)
            yield batch

    found = load_snapshots(spark, raw, "vehicle_positions", [DAY])
    listing = list_snapshots(spark, raw, "vehicle_positions", [DAY])
    run = compact_snapshots(found.mapInArrow(counted, found.schema), str(tmp_path / "out"), "vehicle_positions", listing=listing)
    assert run.rejected.count() == 1 and run.records.count() == 2 and run.counts["rows"] == 14
    assert len(reads.read_bytes()) == 10


@pytest.mark.parametrize("step", ["write_run", "commit"])
def test_a_failing_run_leaves_the_old_partition_whole(spark, raw, tmp_path, monkeypatch, step):
    from transitlake.plans import compaction

    out = str(tmp_path / "out")
    compact(spark, raw, out, "vehicle_positions", [DAY])
    before = sorted(map(tuple, read_table(spark, out, "vehicle_positions").collect()), key=repr)

    def stop(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(compaction, step, stop)
    write_raw(Path(raw), "vehicle_positions", URL_B64, [f"{DAY}T08:00:00.000Z"], (Path(raw) / before[0][0]).read_bytes())
    with pytest.raises(RuntimeError):
        compact(spark, raw, out, "vehicle_positions", [DAY])
    assert recover(spark, out, "vehicle_positions") == []
    assert sorted(map(tuple, read_table(spark, out, "vehicle_positions").collect()), key=repr) == before


def test_a_committed_run_is_finished_by_the_next(spark, raw, tmp_path, monkeypatch):
    """Stopped between two partitions: one is the new, one the old, each whole; then all are new, and figures with them."""
    from transitlake.plans import compaction

    out = str(tmp_path / "out")
    compact(spark, raw, out, "vehicle_positions")
    feed = next(f for f in Path(raw).rglob(f"base64url={URL_B64}/*.pb") if "T03" in f.name).read_bytes()
    write_raw(Path(raw), "vehicle_positions", URL_B64, [f"{DAY}T08:00:00.000Z"], feed)
    write_raw(Path(raw), "vehicle_positions", "MTIzNDU2", ["2024-01-02T08:00:00.000Z"], feed)

    def first_only(spark, run):
        moved = run_files(spark, run).first()
        part = f"date={moved.date}/base64url={moved.base64url}"
        (Path(run.table) / part).rename(Path(run.folder) / "moved")
        (Path(run.folder) / "kind=rows" / part).rename(Path(run.table) / part)
        raise RuntimeError("stopped")

    monkeypatch.setattr(compaction, "publish", first_only)
    with pytest.raises(RuntimeError):
        compact(spark, raw, out, "vehicle_positions")
    spark.catalog.clearCache()
    assert {r.n for r in read_table(spark, out, "vehicle_positions").groupBy("date").agg(F.count("*").alias("n")).collect()} in ({16, 2}, {14, 4})
    assert len(recover(spark, out, "vehicle_positions")) == 1 and recover(spark, out, "vehicle_positions") == []
    counts = {r.date.isoformat(): r.n for r in read_table(spark, out, "vehicle_positions").groupBy("date").agg(F.count("*").alias("n")).collect()}
    assert counts == {DAY: 16, "2024-01-02": 4}
    stats = partition_stats(spark, out, ["vehicle_positions"])
    assert {(r.date, r.row_count) for r in stats.collect()} == {(DAY, 16), ("2024-01-02", 4)}
    forget(spark, out, "vehicle_positions", keep=1)
    assert partition_stats(spark, out).count() == 2 and len(list(Path(out).glob("_runs/vehicle_positions/*"))) == 1


def test_statistics_equal_the_footers(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    for days in (None, [DAY], ["2024-01-02"]):
        compact(spark, raw, out, "vehicle_positions", days)
    footers = file_row_counts(spark, out).select("feed_type", "date", "base64url", "row_count", "size_bytes")
    kept = partition_stats(spark, out).select(*footers.columns)
    assert kept.count() == 2 and kept.exceptAll(footers).count() == 0


def test_catalogue_tables_look_at_named_days_only(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    first = compact_run(spark, raw, out, "vehicle_positions", [DAY])
    names = create_tables(spark, out, "archive_test")
    try:
        assert names[0] == "`archive_test`.vehicle_positions" and first.counts["rows"] == 14
        count = "SELECT count(*) FROM archive_test.vehicle_positions"
        assert spark.sql(count).first()[0] == 14 and spark.sql("SELECT * FROM archive_test.trip_updates").count() == 0
        second = compact_run(spark, raw, out, "vehicle_positions", ["2024-01-02"])
        # The catalogue decides what belongs to the table, and lists the folders of named days alone.
        assert spark.sql(count).first()[0] == 14
        add_partitions(spark, second.run, "archive_test")
        assert spark.sql(count).first()[0] == 16
        day = spark.sql("SELECT * FROM archive_test.vehicle_positions WHERE date = DATE'2024-01-02'")
        assert [f.rsplit("/", 3)[1] for f in day.inputFiles()] == ["date=2024-01-02"] and day.count() == 2
        assert spark.sql("SHOW PARTITIONS archive_test.vehicle_positions").count() == 2
    finally:
        spark.sql("DROP DATABASE archive_test CASCADE")
    assert read_table(spark, out, "vehicle_positions").count() == 16


def test_a_task_holds_few_slices(spark):
    """Thirty feeds of 12 MiB on a day: a task gets some of them, not the rows of 128 MiB."""
    from transitlake.operators.layout import SlicePlan

    rows = spark.range(30).selectExpr("'2024-01-01' AS date", "cast(id AS string) AS base64url", "'h' AS hour", "'s' AS stem", "12582912L AS length")
    plan = SlicePlan(rows)
    assert plan.partitions >= 20
    loads = plan.place(rows).groupBy(F.spark_partition_id()).agg(F.sum("length").alias("bytes"))
    assert loads.agg(F.max("bytes")).first()[0] <= 96 * 1024 * 1024


def test_stand_ins_are_made_in_tasks_of_bounded_size(spark, monkeypatch):
    from transitlake.workloads import tables

    monkeypatch.setattr(tables, "TASK_ROWS", 100)
    assert tables.spread(spark.range(0, 2000, 1, 8)).rdd.getNumPartitions() == 20
    assert tables.spread(spark.range(0, 50, 1, 1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
