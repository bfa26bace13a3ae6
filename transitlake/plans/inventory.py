"""Inventory job: catalogue files of the archive from its listing and the figures that its runs kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from transitlake.operators.inventory import inventory, inventory_totals
from transitlake.operators.schedules import version_listing, version_totals
from transitlake.session import work_folder
from transitlake.sinks.catalogue import write_inventory, write_schedules
from transitlake.sinks.runs import partition_stats
from transitlake.sources.listing import partition_figures
from transitlake.sources.schedule import read_versions
from transitlake.sources.tables import read_feeds


def write_catalogue(spark: SparkSession, root: str) -> DataFrame:
    """Write ``inventory.json`` and ``schedules.json`` below ``root``; returns the totals.

    An archive without data gets two empty arrays.
    """
    root, work = root.rstrip("/"), work_folder(spark, "catalogue")
    # Both are small, and each is wanted several times: for the bounds of a document, its rows and the totals.
    files = _kept(partition_figures(spark, root, partition_stats(spark, root)), f"{work}/files")
    versions = _kept(version_listing(read_versions(spark, root)), f"{work}/versions")
    feeds = read_feeds(spark, root)
    write_inventory(inventory(files, feeds), f"{root}/inventory.json")
    write_schedules(versions, f"{root}/schedules.json")
    totals, schedule = inventory_totals(files, feeds), version_totals(versions)
    # Both frames are single rows of aggregates.
    return spark.createDataFrame(
        [(*totals.first(), *schedule.first())],
        "feeds_count BIGINT, files_processed BIGINT, total_records BIGINT, total_bytes BIGINT, "
        "schedule_feeds BIGINT, schedule_versions BIGINT",
    )


def _kept(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
