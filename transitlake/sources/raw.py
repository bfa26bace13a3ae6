"""Scans of the raw layer: snapshots, their sidecars, and plain listings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from transitlake.functions.paths import path_stem
from transitlake.functions.times import iso_timestamp
from transitlake.schemas import BINARY_FILE, FEED_TYPES, RAW_PARTITIONS, SIDECAR

SNAPSHOT_GLOB = "*.pb"
SIDECAR_GLOB = "*.meta"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob matches anything on its file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def object_name(path: Column, root: str) -> Column:
    """Path below the archive root, with the escaped colons of the hour folder restored."""
    tail = F.substring_index(path, root.rstrip("/").split("://")[-1] + "/", -1)
    return F.replace(tail, F.lit("%3A"), F.lit(":"))


def _scan(
    spark: SparkSession, root: str, feed_type: str, glob: str, dates: Iterable[str] | None
) -> DataFrame:
    base = f"{root.rstrip('/')}/{feed_type}"
    # Naming the days keeps the driver from listing the whole archive before pruning it.
    paths = [base] if dates is None else [f"{base}/date={day}" for day in dates]
    paths = [path for path in paths if path_exists(spark, path)]
    schema = f"{BINARY_FILE}, {RAW_PARTITIONS}"
    if not paths:
        empty = spark.createDataFrame([], schema)
        return empty.select(F.lit(feed_type).alias("feed_type"), "*", F.col("path").alias("source_file"))
    files = (
        spark.read.format("binaryFile")
        .schema(schema)
        .option("pathGlobFilter", glob)
        .option("basePath", base)
        .load(paths)
    )
    return files.select(
        F.lit(feed_type).alias("feed_type"), "*", object_name(F.col("path"), root).alias("source_file")
    )


def read_snapshots(
    spark: SparkSession, root: str, feed_type: str, dates: Iterable[str] | None = None
) -> DataFrame:
    """Raw snapshots of one feed type, all hours. ``content`` is read only if it is selected.

    Filters on ``date`` and ``base64url`` prune folders.
    """
    files = _scan(spark, root, feed_type, SNAPSHOT_GLOB, dates)
    return files.select(
        "feed_type", "date", "hour", "base64url", "source_file",
        path_stem(F.col("source_file")).alias("stem"), "length", "content",
    )


def read_sidecars(
    spark: SparkSession, root: str, feed_type: str, dates: Iterable[str] | None = None
) -> DataFrame:
    """Fetch time and content length per sidecar; NULL where the document cannot be read."""
    files = _scan(spark, root, feed_type, SIDECAR_GLOB, dates)
    document = F.col("content").cast("string")
    return files.select(
        "feed_type", "date", "hour", "base64url",
        path_stem(F.col("source_file")).alias("stem"),
        sidecar_fetch_time(document).alias("fetch_timestamp"),
        F.from_json(document, "content_length BIGINT")["content_length"].alias("content_length"),
    )


def read_fetch_records(
    spark: SparkSession, root: str, feed_type: str, dates: Iterable[str] | None = None
) -> DataFrame:
    """Whole fetch records with the type and path stem of their snapshot; unreadable documents are left out."""
    files = _scan(spark, root, feed_type, SIDECAR_GLOB, dates)
    return fetch_records(
        files.select("feed_type", path_stem(F.col("source_file")).alias("stem"), F.col("content").cast("string").alias("document"))
    )


def fetch_records(documents: DataFrame) -> DataFrame:
    """Fields of fetch records from (feed_type, stem, document)."""
    parsed = documents.select("feed_type", "stem", F.from_json("document", SIDECAR).alias("r"))
    return parsed.where(F.col("r.feed_id").isNotNull()).select("feed_type", "stem", "r.*")


def empty_snapshots(sidecars: DataFrame) -> DataFrame:
    """Listing rows of snapshots without a single byte.

    File sources of Spark leave out empty files, so these are known from their sidecars only.
    """
    return sidecars.where(F.col("content_length") == 0).select(
        "feed_type", "date", "hour", "base64url", F.concat(F.col("stem"), F.lit(".pb")).alias("source_file"),
        "stem", F.lit(0).cast("bigint").alias("length"),
    )


def sidecar_fetch_time(document: Column) -> Column:
    """``fetch_timestamp`` of a sidecar document, NULL for anything malformed."""
    return iso_timestamp(F.from_json(document, "fetch_timestamp STRING")["fetch_timestamp"])


def list_objects(spark: SparkSession, root: str, feed_types: Iterable[str] = FEED_TYPES) -> DataFrame:
    """Listing of all snapshots with their sizes, without opening any of them."""
    frames = [read_snapshots(spark, root, feed_type).drop("content") for feed_type in feed_types]
    listing = frames[0]
    for frame in frames[1:]:
        listing = listing.unionByName(frame)
    return listing


def attach_fetch_time(snapshots: DataFrame, sidecars: DataFrame, placed_by: tuple[str, ...] = ()) -> DataFrame:
    """Snapshot with the fetch time of its sidecar; without one, or with a bad one, NULL.

    ``placed_by`` names columns by which both sides are already distributed; they become part of
    the join key so that the distribution can be reused.
    """
    keys = [*placed_by, "stem"]
    # One sidecar per stem in a sound archive; the aggregate keeps the join 1:1 in any other.
    times = sidecars.groupBy(*keys).agg(F.max("fetch_timestamp").alias("fetch_timestamp"))
    return snapshots.drop("fetch_timestamp").join(times, keys, "left")
