from __future__ import annotations

import json

import pytest

from transitlake.operators.discovery import feeds_over_days, new_feeds, pending, run_requests, work_grid
from transitlake.operators.inventory import archive_stats, inventory, inventory_totals, unmapped
from transitlake.operators.schedules import version_listing
from transitlake.plans.inventory import write_catalogue
from transitlake.schemas import SCHEDULE_DOCUMENT
from transitlake.sinks.catalogue import read_inventory, write_inventory, write_schedules
from transitlake.sources.listing import compacted_files, scan_objects, version_files
from transitlake.sources.schedule import read_versions

FILE = "feed_type STRING, date STRING, base64url STRING, row_count BIGINT, size_bytes BIGINT"
FEED = (
    "base64url STRING, url STRING, agency_id STRING, agency_name STRING, system_id STRING, system_name STRING, "
    "feed_type STRING, load_order INT"
)


@pytest.fixture
def files(spark):
    return spark.createDataFrame(
        [("vehicle_positions", "2025-01-02", "a", 5, 50), ("trip_updates", "2025-01-01", "a", 7, 70),
         ("trip_updates", "2025-01-03", "b", 1, 10), ("trip_updates", "2025-01-03", "c", 2, 20)], FILE
    )


@pytest.fixture
def feeds(spark):
    return spark.createDataFrame(
        [("a", "https://old", "x", "X", None, None, "trip_updates", 1), ("a", "https://new", "x", "X", "s", "S", "trip_updates", 2),
         ("b", "", "y", "Y", None, None, "trip_updates", 3)], FEED
    )


def test_inventory(files, feeds):
    (row,) = inventory(files, feeds).collect()
    assert (row.url, row.date_min, row.date_max, row.total_records, row.total_bytes) == (
        "https://new", "2025-01-01", "2025-01-02", 12, 120
    )
    assert {r.base64url for r in unmapped(files, feeds).collect()} == {"b", "c"}
    assert tuple(inventory_totals(files, feeds).first()) == (1, 4, 12, 120)


def test_a_missing_agency_counts_once(spark, files, feeds):
    rows = inventory(files, feeds)
    twice = rows.unionByName(rows.selectExpr(*(f"cast(NULL AS STRING) AS {c}" if c == "agency_id" else c for c in rows.columns)))
    stats = archive_stats(twice).first()
    assert (stats.agencies, stats.feeds, stats.range_text) == (2, 2, "01/01 – 01/02")


@pytest.mark.parametrize("n", [0, 1, 250])
def test_inventory_document(spark, tmp_path, n):
    schema = "url STRING, base64url STRING, total_records BIGINT, agency_id STRING"
    rows = spark.createDataFrame([(f"https://x/{i}", f"k{i:03d}", i, None) for i in range(n)], schema)
    path = str(tmp_path / "inventory.json")
    write_inventory(rows.repartition(5), path)
    parts = sorted((tmp_path / "inventory.json").glob("part-*"))
    document = json.loads("".join(p.read_text() for p in parts))
    assert [d["base64url"] for d in document] == [f"k{i:03d}" for i in range(n)]
    assert all(d["agency_id"] is None for d in document)
    assert read_inventory(spark, path, schema).count() == n


def test_pretty_inventory(spark, tmp_path):
    (tmp_path / "inventory.json").write_text(json.dumps([{"url": "u", "total_records": 3}, {"url": "v"}], indent=2))
    rows = read_inventory(spark, str(tmp_path / "inventory.json"), pretty=True).collect()
    assert [(r.url, r.total_records) for r in rows] == [("u", 3), ("v", None)]


def version(root, base64url, digest, text):
    folder = root / "schedules" / f"base64url={base64url}" / f"_feed_digest={digest}"
    folder.mkdir(parents=True)
    (folder / "metadata.json").write_text(text)


def test_version_documents(spark, tmp_path):
    version(tmp_path, "b1", "d2", json.dumps({"schedule_url": "https://b", "_feed_digest": "d2", "date_retrieved": "2025-02-01"}))
    version(tmp_path, "b1", "d1", json.dumps({"schedule_url": "https://b", "_feed_digest": "d1", "date_retrieved": "2025-03-01", "feed_start_date": "20250101"}))
    version(tmp_path, "a9", "d3", json.dumps({"schedule_url": "https://a"}))
    version(tmp_path, "zz", "d4", "{broken")
    version(tmp_path, "zy", "d5", json.dumps({"_feed_digest": "d5"}))
    objects = scan_objects(spark, str(tmp_path))
    assert version_files(objects).count() == 5 and compacted_files(objects).count() == 0
    rows = version_listing(read_versions(spark, str(tmp_path))).collect()
    assert [(r.schedule_url, r._feed_digest, r.date_retrieved) for r in rows] == [
        ("https://a", "", ""), ("https://b", "d2", "2025-02-01"), ("https://b", "d1", "2025-03-01")
    ]
    out = tmp_path / "schedules.json"
    write_schedules(version_listing(read_versions(spark, str(tmp_path))), str(out))
    document = json.loads("".join(p.read_text() for p in sorted(out.glob("part-*"))))
    assert [d["schedule_url"] for d in document] == ["https://a", "https://b"]
    assert [v["_feed_digest"] for v in document[1]["versions"]] == ["d2", "d1"]
    assert document[1]["versions"][0]["feed_start_date"] is None and document[1]["base64url"] == "b1"


def test_many_versions_of_one_url_spread_over_parts(spark, tmp_path):
    rows = spark.range(5000).selectExpr(
        "concat('p', lpad(id, 6, '0')) AS path", "if(id % 50 = 0, concat('https://x/', id), 'https://hot') AS schedule_url",
        "'b' AS base64url", "md5(cast(id AS STRING)) AS _feed_digest", "concat('2025-', lpad(id % 9, 2, '0')) AS date_retrieved",
        "cast(NULL AS STRING) AS feed_start_date", "cast(NULL AS STRING) AS feed_end_date",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_schedules(version_listing(rows), str(tmp_path / "s.json"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted((tmp_path / "s.json").glob("part-*"))
    document = json.loads("".join(p.read_text() for p in parts))
    assert len(parts) > 1 and len(document) == 101
    hot = next(d for d in document if d["schedule_url"] == "https://hot")
    assert len(hot["versions"]) == 4900
    dates = [v["date_retrieved"] for v in hot["versions"]]
    assert dates == sorted(dates)


def test_catalogue_job_on_an_empty_archive(spark, tmp_path):
    totals = write_catalogue(spark, str(tmp_path))
    assert tuple(totals.first()) == (0, 0, 0, 0, 0, 0)
    assert spark.read.text(f"{tmp_path}/inventory.json").first()[0] == "[]"
    assert spark.read.text(f"{tmp_path}/schedules.json").first()[0] == "[]"


def test_objects_of_the_single_file_layout(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "trip_updates" / "date=2025-01-01" / "base64url=123"
    folder.mkdir(parents=True)
    pq.write_table(pa.table({"source_file": ["x"] * 9}), folder / "data.parquet")
    (row,) = compacted_files(scan_objects(spark, str(tmp_path))).collect()
    assert (row.feed_type, row.date, row.base64url) == ("trip_updates", "2025-01-01", "123") and row.size_bytes > 100


def test_discovery(spark):
    b64 = {"https://a": "aHR0cHM6Ly9h", "http://b": "aHR0cDovL2I"}
    listing = spark.createDataFrame(
        [("trip_updates", d, k) for d, k in [("2025-01-01", b64["https://a"]), ("2025-01-03", b64["https://a"]),
         ("2025-01-03", b64["https://a"]), ("2025-01-02", b64["http://b"]), ("2025-01-03", "!!")]],
        "feed_type STRING, date STRING, base64url STRING",
    ).selectExpr("feed_type", "cast(date AS DATE) AS date", "base64url")
    found = {r.feed_key: [str(d) for d in r.dates] for r in feeds_over_days(listing, "2025-01-03", 2).collect()}
    assert found == {"a": ["2025-01-03"], "~b": ["2025-01-02"]}
    keys = spark.createDataFrame([("trip_updates", "a"), ("trip_updates", "a"), ("service_alerts", "a")], "feed_type STRING, feed_key STRING")
    known = spark.createDataFrame([("trip_updates", "a")], "feed_type STRING, feed_key STRING")
    assert [tuple(r) for r in new_feeds(keys, known).collect()] == [("service_alerts", "a")]
    grid = work_grid(known, "2025-01-01", "2025-01-03")
    done = spark.sql("SELECT 'trip_updates' AS feed_type, 'a' AS feed_key, DATE'2025-01-02' AS date")
    assert [str(r.date) for r in pending(grid, done).orderBy("date").collect()] == ["2025-01-01", "2025-01-03"]
    assert "CartesianProduct" not in grid._jdf.queryExecution().executedPlan().toString()
    requests = run_requests(done.union(done)).collect()
    assert [r.run_key for r in requests] == ["trip_updates_2025-01-02_a"]


def compacted(root, feed_type, day, base64url, rows):
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = root / feed_type / f"date={day}" / f"base64url={base64url}"
    folder.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table({"source_file": ["x"] * rows}), folder / "data.parquet")
    return folder / "data.parquet"


def test_footers_of_changed_partitions_only(spark, tmp_path):
    """Kept figures count as long as files and bytes agree: a footer that cannot be read is not noticed then."""
    from transitlake.sources.listing import partition_figures

    old = compacted(tmp_path, "trip_updates", "2025-01-01", "123", 5)
    other = compacted(tmp_path, "trip_updates", "2025-01-02", "123", 6)
    new = compacted(tmp_path, "vehicle_positions", "2025-01-02", "abc", 7)
    (tmp_path / "_runs" / "trip_updates").mkdir(parents=True)
    (tmp_path / "_runs" / "trip_updates" / "part.parquet").write_bytes(b"not a table")
    size = old.stat().st_size
    old.write_bytes(b"x" * size)
    schema = "feed_type STRING, date STRING, base64url STRING, files BIGINT, row_count BIGINT, size_bytes BIGINT"
    kept = spark.createDataFrame(
        [("trip_updates", "2025-01-01", "123", 1, 5, size), ("trip_updates", "2025-01-02", "123", 1, 99, 1), ("trip_updates", "2025-01-03", "gone", 1, 9, 9)],
        schema,
    )
    found = partition_figures(spark, str(tmp_path), kept)
    assert sorted(map(tuple, found.collect())) == [
        ("trip_updates", "2025-01-01", "123", 1, 5, size), ("trip_updates", "2025-01-02", "123", 1, 6, other.stat().st_size),
        ("vehicle_positions", "2025-01-02", "abc", 1, 7, new.stat().st_size),
    ]
    assert partition_figures(spark, str(tmp_path / "nowhere"), kept).count() == 0


def test_objects_are_listed_in_tasks(spark, tmp_path):
    from transitlake.sources.archive import ObjectListing, list_objects

    for name in ("top", "a/one", "a/b/two", "a/b/c/d/three", "a/_runs/no", "a/.hidden", "_commits/no", "e/date=1/four"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    rows = list_objects(spark, str(tmp_path)).collect()
    assert sorted((r.path, r.size_bytes) for r in rows) == [(n, len(n)) for n in ("a/b/c/d/three", "a/b/two", "a/one", "e/date=1/four", "top")]
    assert [r.path for r in list_objects(spark, str(tmp_path), ["e"]).collect()] == ["e/date=1/four"]
    parts = ObjectListing({"path": str(tmp_path)}).reader(None).partitions()
    assert sorted((p.path.removeprefix(str(tmp_path)), p.recursive) for p in parts) == [
        ("", False), ("/a", False), ("/a/b", True), ("/e", False), ("/e/date=1", True)
    ]
