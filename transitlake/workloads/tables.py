"""Loading of the driver's tables, and the feed stand-ins derived from them row by row."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from transitlake.operators.batches import pieces, python_rows

# The time columns are stored without a zone. Declared as TIMESTAMP they are read as UTC instants,
# whatever the zone of the session is.
_DECLARED = {
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP, o_orderpriority STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(_DECLARED[name]) if name in _DECLARED else spark.read
    rows = reader.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if name in _DECLARED else rows


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a file stream. The glob lets the path be a single file or a folder of files."""
    return spark.readStream.schema(_DECLARED[name]).parquet(f"{sf_dir}/{name}.parque[t]")


# Feeds per day of the queries that write a folder for each: a local session starts a process for every
# folder it makes, which would be most of what is measured. All other queries have a feed for each key.
FOLDER_FEEDS = 4

FOLDED_EVENTS = f"(SELECT * REPLACE (user_id % {FOLDER_FEEDS} AS user_id) FROM events)"


def folded(events: DataFrame) -> DataFrame:
    """Events of few feeds; no event is left out."""
    return events.withColumn("user_id", F.col("user_id") % FOLDER_FEEDS)


def feed_url(key: Column) -> Column:
    """Stand-in feed URL, a feed for each key; every fifth feed is plain http."""
    scheme = F.when(key % 5 == 0, "http").otherwise("https")
    return F.concat(scheme, F.lit("://feeds.example.com/rt/"), key.cast("string"), F.lit("?format=pb>>>"))


def feed_url_sql(key: str) -> str:
    return (
        f"((CASE WHEN {key} % 5 = 0 THEN 'http' ELSE 'https' END) || '://feeds.example.com/rt/' || {key} || "
        "'?format=pb>>>')"
    )


def base64url_sql(text: str) -> str:
    return f"rtrim(translate(base64(encode({text})), '+/', '-_'), '=')"


def feed_key_sql(url: str) -> str:
    return (
        f"(CASE WHEN {url} LIKE 'http://%' THEN '~' || substr({url}, 8) "
        f"WHEN {url} LIKE 'https://%' THEN substr({url}, 9) ELSE {url} END)"
    )


def stamp_sql(ts: str) -> str:
    """Time stamp of a raw file name: milliseconds cut."""
    return f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S.') || lpad((epoch_us({ts}) // 1000 % 1000)::VARCHAR, 3, '0') || 'Z')"


def raw_path_sql(feed_type: str, url: str, ts: str, extension: str) -> str:
    return (
        f"({feed_type} || '/date=' || strftime({ts}, '%Y-%m-%d') || '/hour=' || "
        f"strftime({ts}, '%Y-%m-%dT%H:00:00Z') || '/base64url=' || {base64url_sql(url)} || '/' || "
        f"{stamp_sql(ts)} || '.{extension}')"
    )


# Rows for which a stand-in makes feeds or archives in one task.
TASK_ROWS = 50_000


def spread(rows: DataFrame) -> DataFrame:
    """Rows over all cores where the input is one small file, and over as many tasks as its rows ask for where it is large."""
    if rows.isStreaming:
        return rows
    wanted = _tasks(rows)
    return rows if rows.rdd.getNumPartitions() >= wanted else rows.repartition(wanted)


def _tasks(rows: DataFrame) -> int:
    return max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(rows.count() / TASK_ROWS))


def spread_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a file stream whose rows go to as many tasks as ``spread`` gives them: a large file can be a single row group."""
    rows = spark.read.schema(_DECLARED[name]).parquet(f"{sf_dir}/{name}.parquet")
    return stream(spark, sf_dir, name).repartition(_tasks(rows))


def encode_feeds(rows: DataFrame) -> DataFrame:
    """Replace the nested ``feed`` by its serialized ``content``: how the stand-ins get snapshots."""
    rest = rows.drop("feed")
    schema = T.StructType([*rest.schema.fields, T.StructField("content", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from transitlake.operators.realtime_proto import feed_message

        make = feed_message()
        for batch in pieces(batches):
            kept = batch.drop_columns(["feed"])
            content = [make(**feed).SerializeToString() for feed in python_rows(batch.column("feed"))]
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(content, pa.binary())], names=[*kept.schema.names, "content"]
            )

    return rows.select(*rest.columns, "feed").mapInArrow(run, schema)


def as_feed(header_timestamp: Column, entities: Column) -> Column:
    """Nested feed; entity fields that are not given stay unset."""
    return F.struct(F.struct(header_timestamp.alias("timestamp")).alias("header"), entities.alias("entity"))


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def rounded(column: Column, digits: int = 4) -> Column:
    return F.round(column.cast("double"), digits)
