"""SQL surface: the archive as views, or as catalogue tables whose partitions the runs add."""

from __future__ import annotations

from itertools import islice

from pyspark.sql import DataFrame, SparkSession, functions as F

from transitlake.schemas import FEED_TYPES, SCHEDULE_TABLES, TABLES
from transitlake.session import BROADCAST_ROWS, is_small
from transitlake.sinks.runs import Run, partition_stats, run_files
from transitlake.sources.raw import path_exists
from transitlake.sources.tables import read_partition, read_schedule_table, read_table, schedule_layouts

# Rows of a preview.
PREVIEW_ROWS = 100
# Parts of a feed where the dimension is too large to be broadcast.
FEED_SALTS = 16
# Partitions that one statement adds.
STATEMENT_PARTITIONS = 500


def register_views(spark: SparkSession, root: str) -> list[str]:
    """Views ``vehicle_positions``, ``trip_updates``, ``service_alerts`` and ``feeds``; returns their names."""
    names = []
    for feed_type in FEED_TYPES:
        read_table(spark, root, feed_type).createOrReplaceTempView(feed_type)
        names.append(feed_type)
    feeds = f"{root.rstrip('/')}/feeds.parquet"
    if path_exists(spark, feeds):
        spark.read.parquet(feeds).createOrReplaceTempView("feeds")
        names.append("feeds")
    return names


def register_schedule_views(spark: SparkSession, root: str) -> list[str]:
    """Views ``schedule_<table>`` for the schedule tables that hold data; returns their names."""
    names = []
    for table in SCHEDULE_TABLES:
        if any(schedule_layouts(spark, root, table)):
            read_schedule_table(spark, root, table).createOrReplaceTempView(f"schedule_{table}")
            names.append(f"schedule_{table}")
    return names


def create_tables(spark: SparkSession, root: str, database: str = "default") -> list[str]:
    """Tables of the catalogue over the compacted tables below ``root``; returns their names.

    The catalogue knows their partitions: a query on some days looks at the folders of these days and lists no other. It starts
    with the partitions that the runs put in place (``sinks.runs.partition_stats``); every later run adds its own by ``add_partitions``.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    names = []
    for feed_type in FEED_TYPES:
        columns = TABLES[feed_type].replace(" NOT NULL", "")
        name = f"`{database}`.{feed_type}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, date DATE, base64url STRING) USING parquet "
            f"PARTITIONED BY (date, base64url) LOCATION '{root.rstrip('/')}/{feed_type}'"
        )
        _add(spark, name, partition_stats(spark, root, [feed_type]))
        names.append(name)
    return names


def add_partitions(spark: SparkSession, run: Run, database: str = "default") -> None:
    """Tell the catalogue the partitions of a run, from its record."""
    _add(spark, f"`{database}`.{run.feed_type}", run_files(spark, run))
    spark.catalog.refreshTable(f"`{database}`.{run.feed_type}")


def _add(spark: SparkSession, name: str, partitions: DataFrame) -> None:
    """One statement for each ``STATEMENT_PARTITIONS`` of them: the driver passes names on, a few at a time."""
    rows = partitions.select("date", "base64url").distinct().toLocalIterator()
    while some := list(islice(rows, STATEMENT_PARTITIONS)):
        parts = " ".join(f"PARTITION (date = DATE'{row.date}', base64url = '{row.base64url}')" for row in some)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")


def preview(
    spark: SparkSession, root: str, feed_type: str, date: str, base64url: str, rows: int = PREVIEW_ROWS
) -> DataFrame:
    """First rows of one day of one feed, in time order."""
    return read_partition(spark, root, feed_type, date, base64url).orderBy("source_file").limit(rows)


def with_feed(fact: DataFrame, feeds: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Facts with the dimension columns of their feed, joined on base64url.

    The dimension is reduced to one row per key by the caller. Up to ``broadcast_rows`` of it are broadcast. A larger one is listed
    once for each of ``FEED_SALTS`` salts, which facts take from their provenance: one feed may hold a large part of them.
    """
    extra = [name for name in feeds.columns if name not in fact.columns]
    dimension = feeds.select("base64url", *extra)
    if is_small(dimension, broadcast_rows):
        return fact.join(F.broadcast(dimension), "base64url")
    salts = F.sequence(F.lit(0).cast("bigint"), F.lit(FEED_SALTS - 1).cast("bigint"))
    salted = fact.withColumn("salt", F.pmod(F.xxhash64(*fact.columns), F.lit(FEED_SALTS).cast("bigint")))
    return salted.join(dimension.select("*", F.explode(salts).alias("salt")), ["base64url", "salt"]).drop("salt")
