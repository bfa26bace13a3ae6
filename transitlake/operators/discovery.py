"""Which feeds exist, which are new, and what work is pending."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from transitlake.functions.codec import base64url_decode, feed_key


def present_feeds(listing: DataFrame) -> DataFrame:
    """Distinct (feed_type, date, base64url) of a listing."""
    return listing.select("feed_type", "date", "base64url").distinct()


def feeds_over_days(listing: DataFrame, last_day: str, days: int) -> DataFrame:
    """Feeds seen in the ``days`` up to ``last_day`` with the set of their dates.

    Keys that cannot be decoded are left out. The set holds at most ``days`` dates.
    """
    last = F.lit(last_day).cast("date")
    recent = listing.where(F.col("date").between(F.date_sub(last, days - 1), last))
    keyed = present_feeds(recent).select(
        "feed_type", "date", feed_key(base64url_decode(F.col("base64url"))).alias("feed_key")
    )
    return (
        keyed.where(F.col("feed_key").isNotNull())
        .groupBy("feed_type", "feed_key")
        .agg(F.sort_array(F.collect_set("date")).alias("dates"))
        .select("*", F.size("dates").alias("n_dates"))
    )


def new_feeds(discovered: DataFrame, known: DataFrame) -> DataFrame:
    """Discovered (feed_type, feed_key) pairs that are not known yet."""
    keys = ["feed_type", "feed_key"]
    return discovered.select(*keys).distinct().join(known.select(*keys), keys, "left_anti")


def run_requests(discovered: DataFrame) -> DataFrame:
    """One request per discovered (feed_type, date, feed_key).

    Its key is the same however often the feed is discovered, so a repeated request is recognised.
    """
    cells = discovered.select("feed_type", F.col("date").cast("string").alias("date"), "feed_key").distinct()
    return cells.select(F.concat_ws("_", "feed_type", "date", "feed_key").alias("run_key"), *cells.columns)


def work_grid(known: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Every day of a range for every known feed: the days are generated per row, without a join."""
    days = F.sequence(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    return known.select("feed_type", "feed_key", F.explode(days).alias("date"))


def pending(grid: DataFrame, done: DataFrame) -> DataFrame:
    """Grid cells without a finished partition."""
    keys = ["feed_type", "feed_key", "date"]
    return grid.join(done.select(*keys), keys, "left_anti")
