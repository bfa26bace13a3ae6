"""Run records of the compacted tables, and the writer of the feed dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from transitlake.functions.codec import feed_key, feed_url

# Codec of the archive.
CODEC = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}


def write_feeds(feeds: DataFrame, root: str) -> None:
    """Write the feed dimension, one row per configured feed.

    The order of the rows decides which of two feeds with the same URL wins in the lookup; it is the
    order of the registry, which part file names and row positions keep.
    """
    feeds.write.mode("overwrite").options(**CODEC).parquet(f"{root.rstrip('/')}/feeds.parquet")


def run_counts(listed: DataFrame, written: DataFrame) -> DataFrame:
    """Per feed and day: snapshots listed, bad and empty ones included, and rows written.

    ``listed`` has the number of ``files`` per feed and hour, ``written`` row counts per (date, base64url). Both sides are counted
    before they meet.
    """
    files = listed.groupBy("feed_type", "date", "base64url").agg(F.sum("files").alias("files_processed"))
    rows = written.groupBy("date", "base64url").agg(F.sum("row_count").alias("records_written"))
    return files.join(rows, ["date", "base64url"], "left").select(
        "feed_type", "date", "base64url", "files_processed",
        F.coalesce("records_written", F.lit(0)).alias("records_written"),
    )


def run_records(counts: DataFrame, root: str) -> DataFrame:
    """Result record of each compacted feed and day; the path is NULL where nothing was written."""
    url = feed_url(F.col("base64url"))
    day = F.concat(F.lit("date="), F.col("date").cast("string"))
    path = F.concat_ws(
        "/", F.lit(root.rstrip("/")), "feed_type", day, F.concat(F.lit("base64url="), F.col("base64url"))
    )
    return counts.select(
        "feed_type", F.col("date").cast("string").alias("date"), feed_key(url).alias("feed"),
        url.alias("feed_url"), "files_processed", "records_written",
        F.when(F.col("records_written") > 0, path).alias("output_path"),
    )
