"""Catalogue aggregates over the compacted layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from transitlake.functions.display import (
    compact_bytes,
    compact_number,
    feed_type_label,
    feed_type_rank,
    month_day,
)

FEED_FIELDS = ("url", "agency_id", "agency_name", "system_id", "system_name", "feed_type")


def feed_lookup(feeds: DataFrame) -> DataFrame:
    """One entry per base64url; of several, the one loaded last."""
    last = feeds.groupBy("base64url").agg(F.max_by(F.struct(*FEED_FIELDS), "load_order").alias("feed"))
    return last.select("base64url", "feed.*")


def _by_feed(files: DataFrame, feeds: DataFrame) -> DataFrame:
    """Totals per base64url over all feed types, joined with the lookup.

    Files are added up first, so the join sees one row per feed on either side.
    """
    totals = files.groupBy("base64url").agg(
        F.min("date").alias("date_min"),
        F.max("date").alias("date_max"),
        F.sum("row_count").alias("total_records"),
        F.sum("size_bytes").alias("total_bytes"),
        F.count("*").alias("n_files"),
    )
    return totals.join(feed_lookup(feeds), "base64url", "left")


def _mapped() -> Column:
    return F.coalesce(F.col("url"), F.lit("")) != ""


def inventory(files: DataFrame, feeds: DataFrame) -> DataFrame:
    """One row per feed with a known URL: date range, records and bytes."""
    return _by_feed(files, feeds).where(_mapped()).select(
        "url", "base64url", "agency_id", "agency_name", "system_id", "system_name", "feed_type",
        "date_min", "date_max", "total_records", "total_bytes",
    )


def unmapped(files: DataFrame, feeds: DataFrame) -> DataFrame:
    """Feeds with data but no known URL: they are reported and left out of the inventory."""
    return _by_feed(files, feeds).where(~_mapped()).select("base64url", "n_files", "total_records", "total_bytes")


def inventory_totals(files: DataFrame, feeds: DataFrame) -> DataFrame:
    """Grand totals: all files, but feeds, records and bytes of known URLs only."""
    return _by_feed(files, feeds).agg(
        F.count_if(_mapped()).alias("feeds_count"),
        F.coalesce(F.sum("n_files"), F.lit(0)).alias("files_processed"),
        F.coalesce(F.sum(F.when(_mapped(), F.col("total_records"))), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum(F.when(_mapped(), F.col("total_bytes"))), F.lit(0)).alias("total_bytes"),
    )


def archive_stats(feeds: DataFrame) -> DataFrame:
    """Headline numbers of an inventory. A missing agency counts as one agency."""
    stats = feeds.agg(
        (
            F.countDistinct("agency_id") + F.coalesce(F.max(F.col("agency_id").isNull().cast("bigint")), F.lit(0))
        ).alias("agencies"),
        F.count("*").alias("feeds"),
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("total_bytes"), F.lit(0)).alias("total_bytes"),
        F.min("date_min").alias("date_min"),
        F.max("date_max").alias("date_max"),
    )
    return stats.select(
        "*",
        compact_number(F.col("total_records")).alias("records_text"),
        compact_bytes(F.col("total_bytes")).alias("size_text"),
        F.concat_ws(" – ", month_day(F.col("date_min")), month_day(F.col("date_max"))).alias("range_text"),
    )


def agency_rollup(feeds: DataFrame) -> DataFrame:
    """Per agency: feeds, records, bytes and whether it has several systems; sorted by name."""
    agencies = feeds.groupBy("agency_id").agg(
        F.min("agency_name").alias("agency_name"),
        F.count("*").alias("feeds"),
        F.sum("total_records").alias("total_records"),
        F.sum("total_bytes").alias("total_bytes"),
        (F.countDistinct(F.nullif(F.col("system_id"), F.lit(""))) > 1).alias("multiple_systems"),
    )
    return agencies.select(
        "*",
        compact_number(F.col("total_records")).alias("records_text"),
        compact_bytes(F.col("total_bytes")).alias("size_text"),
    ).orderBy("agency_name", "agency_id")


def feed_listing(feeds: DataFrame) -> DataFrame:
    """Feeds in display order, with labels and the latest day, which is the one to preview."""
    rank = feed_type_rank(F.col("feed_type"))
    system = F.coalesce("system_name", F.lit(""))
    label = feed_type_label(F.col("feed_type"))
    return feeds.select(
        "agency_id", "agency_name", "system_name", "feed_type", "base64url",
        F.when(system != "", F.concat_ws(" / ", label, system)).otherwise(label).alias("label"),
        rank.alias("type_rank"),
        F.concat_ws(" – ", month_day(F.col("date_min")), month_day(F.col("date_max"))).alias("range_text"),
        compact_number(F.col("total_records")).alias("records_text"),
        compact_bytes(F.col("total_bytes")).alias("size_text"),
        F.col("date_max").alias("preview_date"),
    ).orderBy("agency_name", "agency_id", system, rank, "base64url")
