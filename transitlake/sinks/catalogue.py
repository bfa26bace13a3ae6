"""JSON catalogues. Written as sorted text, so that no task ever holds the whole document.

The part files, read in name order, are one valid JSON array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from transitlake.schemas import INVENTORY

_KEEP_NULLS = {"ignoreNullFields": "false"}


def _write_lines(spark: SparkSession, lines: DataFrame | None, path: str) -> None:
    if lines is None:
        lines = spark.createDataFrame([("[]",)], "line STRING")
    lines.select("line").write.mode("overwrite").text(path)


def write_inventory(feeds: DataFrame, path: str, key: str = "base64url") -> None:
    """Write rows as a JSON array, one record per line, sorted by a unique key."""
    low, high = feeds.agg(F.min(key), F.max(key)).first()
    if low is None:
        return _write_lines(feeds.sparkSession, None, path)
    record = F.to_json(F.struct(*feeds.columns), _KEEP_NULLS)
    line = F.concat(
        F.when(F.col(key) == low, "[").otherwise(""), record, F.when(F.col(key) == high, "]").otherwise(",")
    )
    _write_lines(feeds.sparkSession, feeds.select(key, line.alias("line")).orderBy(key), path)


def read_inventory(spark: SparkSession, path: str, schema: str = INVENTORY, pretty: bool = False) -> DataFrame:
    """Read an inventory: one record per line, or, when ``pretty``, one indented document per file."""
    if pretty:
        return spark.read.schema(schema).json(path, multiLine=True)
    text = F.trim("value")
    text = F.when(text.startswith("["), F.substring(text, F.lit(2), F.length(text))).otherwise(text)
    text = F.regexp_replace(text, r"[\],]$", "")
    records = spark.read.text(path).select(F.from_json(text, schema).alias("r"), text.alias("text"))
    return records.where(F.col("text") != "").select("r.*")


def _edge(rows: DataFrame, by: str, order: Column) -> DataFrame:
    """First and last order key per group: two rows per group, whatever its size."""
    return rows.groupBy(by).agg(F.min(order).alias("first_key"), F.max(order).alias("last_key"))


def write_schedules(versions: DataFrame, path: str) -> None:
    """Write versions as a JSON array of schedule URLs with their nested versions.

    A URL is opened by its first version and closed by its last one in sort order; the versions in
    between may lie in several part files.
    """
    order = F.struct("date_retrieved", "path", "_feed_digest")
    edges = _edge(versions, "schedule_url", order)
    low, high = versions.agg(F.min("schedule_url"), F.max("schedule_url")).first()
    if low is None:
        return _write_lines(versions.sparkSession, None, path)
    rows = versions.join(edges, "schedule_url").withColumn("k", order)
    first, last = F.col("k") == F.col("first_key"), F.col("k") == F.col("last_key")
    url = F.col("schedule_url")
    head = F.regexp_replace(
        F.to_json(F.struct("schedule_url", "base64url")), r"\}$", ',"versions":['
    )
    record = F.to_json(
        F.struct("_feed_digest", "date_retrieved", "feed_start_date", "feed_end_date"), _KEEP_NULLS
    )
    line = F.concat(
        F.when(first & (url == low), "[").otherwise(""),
        F.when(first, head).otherwise(""),
        record,
        F.when(last, F.concat(F.lit("]}"), F.when(url == high, "]").otherwise(","))).otherwise(","),
    )
    _write_lines(
        versions.sparkSession, rows.select("schedule_url", "k", line.alias("line")).orderBy("schedule_url", "k"), path
    )
