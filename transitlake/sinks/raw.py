"""Raw layer records: the fetch record beside a snapshot, and the table of snapshots."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from transitlake.functions.codec import base64url_encode
from transitlake.functions.paths import path_stem, raw_path
from transitlake.functions.times import utc_date, utc_hour, utc_iso
from transitlake.sources.archive import folder_names, store_of

# Response headers that are kept.
KEPT_HEADERS = ("etag", "last-modified", "content-type", "content-length")

SNAPSHOT_PARTITIONS = ("feed_type", "date", "hour", "base64url")


def kept_headers(headers: Column) -> Column:
    """Headers of the allow-list, compared without case, under the names they came with."""
    return F.map_filter(headers, lambda name, _: F.lower(name).isin(*KEPT_HEADERS))


def fetch_record(fetches: DataFrame) -> Column:
    """Fetch record as JSON text; missing values are written as null."""
    fields = (
        "feed_id", "agency_id", "agency_name", "system_id", "system_name", "schedule_url", "url",
    )
    record = F.struct(
        *(F.col(name) for name in fields),
        utc_iso(F.col("fetch_ts")).alias("fetch_timestamp"),
        F.col("duration_ms"),
        F.col("status_code").alias("response_code"),
        F.col("content_length"),
        # The first of several spellings of the name.
        F.get(F.filter(F.map_entries("headers"), lambda e: F.lower(e["key"]) == "content-type"), F.lit(0))["value"].alias(
            "content_type"
        ),
        kept_headers(F.col("headers")).alias("headers"),
    )
    return F.to_json(record, {"ignoreNullFields": "false"})


def snapshot_rows(fetches: DataFrame) -> DataFrame:
    """Snapshot rows of the raw table from fetch results (url, feed_type, fetch_ts, content)."""
    ts, url = F.col("fetch_ts"), F.col("url")
    path = raw_path(F.col("feed_type"), url, ts)
    return fetches.select(
        "feed_type", utc_date(ts).alias("date"), utc_hour(ts).alias("hour"),
        base64url_encode(url).alias("base64url"), path.alias("source_file"), path_stem(path).alias("stem"),
        F.length("content").cast("bigint").alias("length"), F.col("fetch_ts").alias("fetch_timestamp"), "content",
    )


def sidecars(snapshots: DataFrame, document: Column) -> DataFrame:
    """Objects (path, content) that hold the fetch record ``document`` beside each snapshot."""
    return snapshots.select(F.concat("stem", F.lit(".meta")).alias("path"), document.cast("binary").alias("content"))


def store_objects(objects: DataFrame, root: str) -> int:
    """Write each row (path, content) as an object of its own below ``root``, from the tasks that hold the rows; returns how many
    there are. A task that is repeated writes the same objects again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(root)
        made = set()
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                target = posixpath.join(base, path)
                if (folder := posixpath.dirname(target)) not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(target) as out:
                    out.write(content or b"")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["stored"])

    stored = objects.select("path", F.col("content").cast("binary").alias("content")).mapInArrow(run, "stored BIGINT")
    return stored.agg(F.coalesce(F.sum("stored"), F.lit(0))).first()[0]


def drop_objects(spark: SparkSession, root: str) -> None:
    """Delete a raw layer that is done with: its hour folders from tasks, then the folders that are left.

    Tasks that delete wait for the store. They take half of the cores, so that other work goes on beside them."""
    store, base = store_of(root)
    folders = [base]
    for _ in range(3):
        folders = [posixpath.join(path, name) for path in folders for name in folder_names(store, path)]

    tasks = min(len(folders), max(1, spark.sparkContext.defaultParallelism // 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = store_of(root)
        for batch in batches:
            for number in batch.column("id").to_pylist():
                for folder in folders[number::tasks]:
                    # A task that is repeated finds some folders gone.
                    with suppress(FileNotFoundError):
                        store.delete_dir(folder)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["dropped"])

    if folders:
        spark.range(0, tasks, 1, tasks).mapInArrow(run, "dropped BIGINT").agg(F.sum("dropped")).first()
        store.delete_dir(base)
