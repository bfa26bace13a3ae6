"""Snapshots built from table rows, then decoded, flattened and compacted by the engine.

Every table row becomes its own snapshot, so building them needs no shuffle and no group.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from transitlake.functions import base64url_encode, path_stem, raw_path, utc_date, utc_stamp
from transitlake.functions.times import utc_iso
from transitlake.operators.decode import flatten_snapshots
from transitlake.operators.inventory import feed_lookup
from transitlake.plans.catalog import create_tables, preview, with_feed
from transitlake.plans.compaction import compact_run, compact_snapshots
from transitlake.session import work_folder
from transitlake.sinks.raw import drop_objects, fetch_record, sidecars, snapshot_rows, store_objects
from transitlake.sinks.runs import partition_stats
from transitlake.sources.listing import partition_figures
from transitlake.sources.raw import attach_fetch_time, sidecar_fetch_time
from transitlake.sources.tables import read_partition, read_table
from transitlake.workloads.tables import (
    FOLDER_FEEDS,
    FOLDED_EVENTS,
    as_feed,
    base64url_sql,
    encode_feeds,
    feed_key_sql,
    feed_url,
    feed_url_sql,
    folded,
    micros,
    raw_path_sql,
    rounded,
    spread,
    table,
)

# A header whose time stamp is 2^64 - 1; appended to a message it replaces the header's value.
HUGE_HEADER = "0A0B18FFFFFFFFFFFFFFFFFF01"

# The feed whose snapshots cannot be read any more in the second run of the queries that compact twice.
GONE_BAD = 3


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


# --- vehicle positions from events -----------------------------------------------------------


def vehicle_fetches(events: DataFrame) -> DataFrame:
    """One fetch per event with 1 to 4 vehicles; some also hold an alert, some cannot be read."""
    e, u, value = F.col("event_id"), F.col("user_id"), F.col("value")
    seconds = F.floor(F.unix_micros("ts") / 1_000_000)

    def vehicle(i: Column) -> Column:
        trip = F.struct(
            _unless(i == 1, F.concat(F.lit("trip-"), u.cast("string"))).alias("trip_id"),
            F.col("event_type").alias("route_id"),
            _unless(e % 2 == 1, i % 2).cast("bigint").alias("direction_id"),
            _unless(i == 2, F.lit("08:00:00")).alias("start_time"),
            _unless(e % 4 == 0, F.lit("20240101")).alias("start_date"),
            _unless(i == 0, F.lit(1)).alias("schedule_relationship"),
        )
        descriptor = F.struct(
            F.concat(F.lit("bus-"), u.cast("string")).alias("id"),
            _unless(i == 2, F.concat(F.lit("Bus "), i.cast("string"))).alias("label"),
            F.lit(None).cast("string").alias("license_plate"),
        )
        position = F.struct(
            value.cast("float").alias("latitude"),
            _unless(i == 3, -value).cast("float").alias("longitude"),
            _unless(e % 3 != 1, i * 90).cast("float").alias("bearing"),
            (value * 1000).alias("odometer"),
            _unless(e % 5 == 2, F.lit(0.0)).cast("float").alias("speed"),
        )
        body = F.struct(
            _unless((e + i) % 3 == 0, trip).alias("trip"),
            _unless((e + i) % 4 == 0, descriptor).alias("vehicle"),
            _unless((e + i) % 5 == 0, position).alias("position"),
            _unless(i >= 2, i).cast("bigint").alias("current_stop_sequence"),
            _unless(e % 2 == 0, F.concat(F.lit("stop-"), i.cast("string"))).alias("stop_id"),
            _unless(e % 6 == 0, i % 3).cast("int").alias("current_status"),
            _unless(i == 3, seconds + i).alias("timestamp"),
            (e % 5).cast("int").alias("congestion_level"),
            _unless(e % 8 == 4, e % 9).cast("int").alias("occupancy_status"),
            _unless(i == 1, e % 101).alias("occupancy_percentage"),
        )
        return F.struct(
            F.concat_ws("-", F.lit("v"), e.cast("string"), i.cast("string")).alias("id"),
            body.alias("vehicle"),
            F.lit(None).cast("struct<cause:int>").alias("alert"),
        )

    vehicles = F.transform(F.sequence(F.lit(0).cast("bigint"), e % 4), vehicle)
    # Every eighth snapshot holds an alert before its vehicles.
    alert = F.struct(
        F.concat(F.lit("a-"), e.cast("string")).alias("id"),
        F.get(vehicles, e % 4 + 1)["vehicle"].alias("vehicle"),
        F.struct(F.lit(1).alias("cause")).alias("alert"),
    )
    entities = F.when(e % 8 == 0, F.concat(F.array(alert), vehicles)).otherwise(vehicles)
    nested = as_feed(F.when(e % 10 == 0, F.lit(0)).otherwise(seconds), entities)
    encoded = encode_feeds(events.select("event_id", "ts", "user_id", nested.alias("feed")))
    content = F.col("content")
    broken = (
        F.when(F.col("event_id") % 7 == 3, F.lit("not valid protobuf data").cast("binary"))
        .when(F.col("event_id") % 50 == 1, F.concat(content, F.unhex(F.lit(HUGE_HEADER))))
        .when(F.col("event_id") % 50 == 2, F.lit("").cast("binary"))
        .otherwise(content)
    )
    return encoded.select(
        "event_id", F.lit("vehicle_positions").alias("feed_type"), feed_url(F.col("user_id")).alias("url"),
        F.col("ts").alias("fetch_ts"), broken.alias("content"),
    )


def vehicle_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_rows(vehicle_fetches(table(spark, sf_dir, "events")))


_VP_SOURCE = raw_path_sql("'vehicle_positions'", feed_url_sql("user_id"), "ts", "pb")

# Events whose snapshot can be read and is not empty, with one row per vehicle.
_VP_ROWS = f"""
rows AS (
  SELECT event_id AS e, user_id AS u, event_type, value, ts, i, epoch_us(ts) // 1000000 AS s,
         {_VP_SOURCE} AS source_file, {feed_url_sql('user_id')} AS feed_url,
         (event_id + i) % 3 <> 0 AS has_trip, (event_id + i) % 4 <> 0 AS has_vehicle,
         (event_id + i) % 5 <> 0 AS has_position
  FROM (SELECT *, unnest(range(0, event_id % 4 + 1)) AS i FROM events
        WHERE event_id % 7 <> 3 AND event_id % 50 NOT IN (1, 2)))"""


_FOLDED_ROWS = _VP_ROWS.replace("FROM events", f"FROM {FOLDED_EVENTS}")


def vehicle_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten_snapshots(vehicle_snapshots(spark, sf_dir), "vehicle_positions")
    floats = ("latitude", "longitude", "bearing", "odometer", "speed")
    plain = [
        rounded(F.col(name)).alias(name) if name in floats
        else micros(F.col(name)).alias("fetch_us") if name == "fetch_timestamp" else F.col(name)
        for name in flat.columns
        if name not in ("date", "base64url", "entity_pos", "child_pos")
    ]
    return flat.select(*plain)


VEHICLE_POSITIONS = f"""
WITH {_VP_ROWS}
SELECT source_file, feed_url, CASE WHEN e % 10 <> 0 THEN s END AS feed_timestamp, epoch_us(ts) AS fetch_us,
  'v-' || e || '-' || i AS entity_id,
  CASE WHEN has_trip THEN CASE WHEN i = 1 THEN '' ELSE 'trip-' || u END END AS trip_id,
  CASE WHEN has_trip THEN event_type END AS route_id,
  CASE WHEN has_trip AND e % 2 = 0 THEN i % 2 END AS direction_id,
  CASE WHEN has_trip THEN CASE WHEN i = 2 THEN '' ELSE '08:00:00' END END AS start_time,
  CASE WHEN has_trip THEN CASE WHEN e % 4 = 0 THEN '' ELSE '20240101' END END AS start_date,
  CASE WHEN has_trip THEN CASE WHEN i = 0 THEN 0 ELSE 1 END END AS schedule_relationship,
  CASE WHEN has_vehicle THEN 'bus-' || u END AS vehicle_id,
  CASE WHEN has_vehicle THEN CASE WHEN i = 2 THEN '' ELSE 'Bus ' || i END END AS vehicle_label,
  CASE WHEN has_vehicle THEN '' END AS license_plate,
  CASE WHEN has_position THEN round(value::FLOAT::DOUBLE, 4) END AS latitude,
  CASE WHEN has_position THEN CASE WHEN i = 3 THEN 0.0 ELSE round((-value)::FLOAT::DOUBLE, 4) END END AS longitude,
  CASE WHEN has_position AND e % 3 = 1 THEN (i * 90)::DOUBLE END AS bearing,
  CASE WHEN has_position THEN round(value * 1000, 4) END AS odometer,
  CASE WHEN has_position AND e % 5 <> 2 THEN 0.0::DOUBLE END AS speed,
  CASE WHEN i < 2 THEN i END AS current_stop_sequence,
  CASE WHEN e % 2 = 1 THEN 'stop-' || i END AS stop_id,
  CASE WHEN e % 6 <> 0 THEN i % 3 END::INT AS current_status,
  CASE WHEN i <> 3 THEN s + i END AS timestamp,
  (e % 5)::INT AS congestion_level,
  CASE WHEN e % 8 <> 4 THEN e % 9 END::INT AS occupancy_status,
  CASE WHEN i <> 1 THEN e % 101 END AS occupancy_percentage
FROM rows"""


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of a second run, in which the snapshots of one feed have gone bad; its stored rows do not hide them."""
    snapshots, root = _compacted(spark, sf_dir, "rejected")
    worse = _gone_bad(snapshots)
    bad = compact_snapshots(worse, root, "vehicle_positions", _sidecars(worse)).rejected
    return bad.select("source_file", F.split_part("error", F.lit(":"), F.lit(1)).alias("reason"))


REJECTED = f"""
SELECT {_VP_SOURCE} AS source_file,
       CASE WHEN event_id % 7 = 3 OR user_id = {GONE_BAD} THEN 'DecodeError' ELSE 'ValueError' END AS reason
FROM {FOLDED_EVENTS} WHERE event_id % 7 = 3 OR event_id % 50 = 1 OR user_id = {GONE_BAD}"""


def _sidecars(snapshots: DataFrame) -> DataFrame:
    return snapshots.select("feed_type", "date", "hour", "base64url", "stem", "fetch_timestamp")


def _gone_bad(snapshots: DataFrame) -> DataFrame:
    """The snapshots, those of one feed replaced by bytes that are no message."""
    gone = F.col("base64url") == base64url_encode(feed_url(F.lit(GONE_BAD)))
    content = F.when(gone, F.unhex(F.lit("FF"))).otherwise(F.col("content"))
    return snapshots.withColumn("content", content)


def _compacted(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, str]:
    """Snapshots landed as a table, then compacted with sidecars: the landed table and the archive root."""
    root = work_folder(spark, name)
    landed = f"{root}/snapshots"
    # Hour and feed are plain columns of the landed table here: one folder per type and day.
    fetches = vehicle_fetches(folded(table(spark, sf_dir, "events")))
    snapshot_rows(fetches).write.partitionBy("feed_type", "date").parquet(landed)
    snapshots = spark.read.parquet(landed)
    compact_snapshots(snapshots, f"{root}/archive", "vehicle_positions", _sidecars(snapshots))
    return snapshots, f"{root}/archive"


def compacted_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, root = _compacted(spark, sf_dir, "compacted-feeds")
    return read_table(spark, root, "vehicle_positions").groupBy("feed_url", F.col("date").cast("string").alias("date")).agg(
        F.count("*").alias("positions"),
        F.countDistinct("source_file").alias("snapshots"),
        F.count("latitude").alias("located"),
        F.max(micros(F.col("fetch_timestamp"))).alias("last_fetch_us"),
        F.min("entity_id").alias("first_entity"),
    )


COMPACTED_FEEDS = f"""
WITH {_FOLDED_ROWS}
SELECT feed_url, strftime(ts, '%Y-%m-%d') AS date, count(*) AS positions,
       count(DISTINCT source_file) AS snapshots, count(*) FILTER (WHERE has_position) AS located,
       max(epoch_us(ts)) AS last_fetch_us, min('v-' || e || '-' || i) AS first_entity
FROM rows GROUP BY ALL"""


def compaction_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records of a second run, in which the snapshots of one feed have gone bad: its old rows do not count."""
    snapshots, root = _compacted(spark, sf_dir, "compaction-runs")
    worse = _gone_bad(snapshots)
    runs = compact_snapshots(worse, root, "vehicle_positions", _sidecars(worse)).records
    written = F.col("output_path").isNotNull().alias("has_output")
    return runs.select("feed_type", "date", "feed", "feed_url", "files_processed", "records_written", written)


COMPACTION_RUNS = f"""
WITH {_FOLDED_ROWS},
w AS (SELECT feed_url, strftime(ts, '%Y-%m-%d') AS date, count(*) AS n FROM rows WHERE u <> {GONE_BAD} GROUP BY ALL),
f AS (SELECT {feed_url_sql('user_id')} AS feed_url, strftime(ts, '%Y-%m-%d') AS date, count(*) AS n
      FROM {FOLDED_EVENTS} GROUP BY ALL)
SELECT 'vehicle_positions' AS feed_type, f.date, {feed_key_sql('f.feed_url')} AS feed, f.feed_url,
       f.n AS files_processed, coalesce(w.n, 0) AS records_written, w.n IS NOT NULL AS has_output
FROM f LEFT JOIN w USING (feed_url, date)"""


# Snapshots of a raw archive that a query lands, works on and drops: each is a file, most have a second one beside them, and a file takes
# a block of the disk however short it is. Two such archives are there at a time. Files that live for seconds only are also dropped
# many times faster than those that reached the disk.
LANDED_SNAPSHOTS = 50_000


def archive_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose snapshots become objects: of few feeds, milliseconds from the key keep the names of one feed's snapshots apart."""
    events = folded(table(spark, sf_dir, "events").drop("props"))
    return events.withColumn("ts", F.timestamp_micros(F.unix_micros("ts") + F.col("event_id") * 1000))


def in_parts(events: DataFrame, key: Column, root: str) -> Iterator[tuple[DataFrame, str]]:
    """All events in parts, in the order of ``key``, each with its last key: whole keys, as many as have ``LANDED_SNAPSHOTS`` events together.

    Events are written once by part, so that every part reads its own only."""
    spark = events.sparkSession
    keyed = events.withColumn("key", F.coalesce(key, F.lit("")))
    numbers, last, held = [], [], 0
    for name, count in keyed.groupBy("key").count().orderBy("key").collect():
        if not last or held + count > LANDED_SNAPSHOTS:
            last.append(name)
            held = 0
        last[-1] = name
        held += count
        numbers.append((name, len(last) - 1))
    if not last:
        yield events, ""
        return
    placed = keyed.join(F.broadcast(spark.createDataFrame(numbers, "key STRING, part INT")), "key").drop("key")
    tasks = max(len(last), events.rdd.getNumPartitions())
    placed.repartitionByRange(tasks, "part", "event_id").write.partitionBy("part").parquet(f"{root}/events")
    for part, name in enumerate(last):
        yield spark.read.schema(events.schema).parquet(f"{root}/events/part={part}"), name


def land_archive(events: DataFrame, root: str) -> None:
    """The snapshots of events as objects of a raw archive, those with content beside a sidecar.

    The sidecar has the fetch time to the microsecond, the name of the snapshot to the millisecond."""
    # Both kinds of objects come from the snapshots: these are made once.
    snapshots = snapshot_rows(vehicle_fetches(events)).persist()
    record = F.to_json(F.struct(F.lit("x").alias("feed_id"), utc_iso(F.col("fetch_timestamp")).alias("fetch_timestamp")))
    try:
        store_objects(snapshots.select(F.col("source_file").alias("path"), "content"), root)
        store_objects(sidecars(snapshots.where("length > 0"), record), root)
    finally:
        snapshots.unpersist()


def by_parts(
    events: DataFrame, key: Column, root: str, work: Callable[[str, str], None], drop: Callable[[SparkSession, str], None]
) -> None:
    """``work`` on the raw archive (its root and last key) of each of ``in_parts``, one after the other.

    While one is worked on, the one before is dropped and the next is landed. There are two at a time: a third is landed when the first
    is gone."""

    def land(number: int, part: DataFrame) -> str:
        if number > 1:
            dropping[number - 2].result()
        land_archive(spread(part), f"{root}/raw-{number}")
        return f"{root}/raw-{number}"

    with ThreadPoolExecutor(1) as ahead, ThreadPoolExecutor(1) as behind:
        landing, dropping = [], []

        def follow(landed: Future, last: str) -> None:
            raw = landed.result()
            work(raw, last)
            dropping.append(behind.submit(drop, events.sparkSession, raw))

        for number, (part, last) in enumerate(in_parts(events, key, root)):
            landing.append((ahead.submit(land, number, part), last))
            if number:
                follow(*landing[number - 1])
        follow(*landing[-1])
        for dropped in dropping:
            dropped.result()


def archive_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records of a raw archive that is listed and read in tasks; empty snapshots have no sidecar and count all the same.

    Days of feeds are landed, compacted and dropped in parts, so that the raw files on the disk stay bounded."""
    root = work_folder(spark, "archive-runs")
    day_and_feed = F.concat_ws("/", utc_date(F.col("ts")).cast("string"), F.col("user_id").cast("string"))

    def compacted(raw: str, _: str) -> None:
        runs = compact_run(spark, raw, f"{root}/archive", "vehicle_positions").records
        runs.write.mode("append").parquet(f"{root}/records")

    by_parts(archive_events(spark, sf_dir), day_and_feed, root, compacted, drop_objects)
    runs = spark.read.parquet(f"{root}/records")
    written = F.col("output_path").isNotNull().alias("has_output")
    return runs.select("feed_type", "date", "feed", "feed_url", "files_processed", "records_written", written)


ARCHIVE_EVENTS = f"(SELECT * REPLACE (user_id % {FOLDER_FEEDS} AS user_id, ts + to_milliseconds(event_id) AS ts) FROM events)"
ARCHIVE_ROWS = _VP_ROWS.replace("FROM events", f"FROM {ARCHIVE_EVENTS}")

ARCHIVE_RUNS = f"""
WITH {ARCHIVE_ROWS},
w AS (SELECT feed_url, strftime(ts, '%Y-%m-%d') AS date, count(*) AS n FROM rows GROUP BY ALL),
f AS (SELECT {feed_url_sql('user_id')} AS feed_url, strftime(ts, '%Y-%m-%d') AS date, count(*) AS n FROM {ARCHIVE_EVENTS} GROUP BY ALL)
SELECT 'vehicle_positions' AS feed_type, f.date, {feed_key_sql('f.feed_url')} AS feed, f.feed_url,
       f.n AS files_processed, coalesce(w.n, 0) AS records_written, w.n IS NOT NULL AS has_output
FROM f LEFT JOIN w USING (feed_url, date)"""


def archive_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every partition after two runs, from the figures that the runs kept: no footer is opened."""
    snapshots, root = _compacted(spark, sf_dir, "archive-figures")
    worse = _gone_bad(snapshots).where(F.col("date") < "2024-01-10")
    compact_snapshots(worse, root, "vehicle_positions", _sidecars(worse))
    kept = partition_stats(spark, root)
    return partition_figures(spark, root, kept).select("feed_type", "date", "base64url", "row_count")


ARCHIVE_FIGURES = f"""
WITH {_FOLDED_ROWS}
SELECT 'vehicle_positions' AS feed_type, strftime(ts, '%Y-%m-%d') AS date, {base64url_sql('feed_url')} AS base64url, count(*) AS row_count
FROM rows GROUP BY ALL"""


def catalog_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL on a catalogue table whose partitions the run added."""
    _, root = _compacted(spark, sf_dir, "catalog-sql")
    database = f"archive_{uuid.uuid4().hex}"
    create_tables(spark, root, database)
    return spark.sql(
        f"SELECT feed_url, count(*) AS positions, count(trip_id) AS on_trip, max(timestamp) AS last_stamp "
        f"FROM `{database}`.vehicle_positions WHERE date BETWEEN DATE'2024-01-05' AND DATE'2024-01-20' GROUP BY feed_url"
    )


CATALOG_SQL = f"""
WITH {_FOLDED_ROWS}
SELECT feed_url, count(*) AS positions, count(*) FILTER (WHERE has_trip) AS on_trip, max(CASE WHEN i <> 3 THEN s + i END) AS last_stamp
FROM rows WHERE strftime(ts, '%Y-%m-%d') BETWEEN '2024-01-05' AND '2024-01-20' GROUP BY feed_url"""


def partition_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of every feed, each read as the partition that it is."""
    _, root = _compacted(spark, sf_dir, "partition-read")
    feeds = [base64url_of(spark, key) for key in range(FOLDER_FEEDS)]
    days = [read_partition(spark, root, "vehicle_positions", "2024-01-15", feed) for feed in feeds]
    return functools.reduce(DataFrame.unionByName, days).groupBy("base64url", F.col("date").cast("string").alias("date")).agg(
        F.count("*").alias("rows"), F.sum("occupancy_percentage").alias("occupancy")
    )


PARTITION_READ = f"""
WITH {_FOLDED_ROWS}
SELECT {base64url_sql('feed_url')} AS base64url, strftime(ts, '%Y-%m-%d') AS date, count(*) AS rows,
       sum(CASE WHEN i <> 1 THEN e % 101 END)::BIGINT AS occupancy
FROM rows WHERE strftime(ts, '%Y-%m-%d') = '2024-01-15' GROUP BY ALL"""


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of one day of every feed: as many as a preview has, and the snapshots they come from."""
    _, root = _compacted(spark, sf_dir, "preview")
    feeds = [base64url_of(spark, key) for key in range(FOLDER_FEEDS)]
    first = [preview(spark, root, "vehicle_positions", "2024-01-15", feed, rows=7) for feed in feeds]
    return functools.reduce(DataFrame.unionByName, first).groupBy("feed_url").agg(
        F.count("*").alias("rows"), F.min("source_file").alias("first_file"), F.max("source_file").alias("last_file")
    )


PREVIEW_ROWS = f"""
WITH {_FOLDED_ROWS},
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY feed_url ORDER BY source_file) AS pos
  FROM rows WHERE strftime(ts, '%Y-%m-%d') = '2024-01-15')
SELECT feed_url, count(*) AS rows, min(source_file) AS first_file, max(source_file) AS last_file
FROM ordered WHERE pos <= 7 GROUP BY feed_url"""


def base64url_of(spark: SparkSession, key: int) -> str:
    return spark.range(1).select(base64url_encode(feed_url(F.lit(key)))).first()[0]


def agency_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions per agency: the facts joined with the feed dimension. Nations name the feeds."""
    flat = flatten_snapshots(vehicle_snapshots(spark, sf_dir), "vehicle_positions")
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    named = nations.select(
        base64url_encode(feed_url(F.col("n_nationkey"))).alias("base64url"), feed_url(F.col("n_nationkey")).alias("url"),
        F.lower("n_name").alias("agency_id"), F.col("n_name").alias("agency_name"),
        F.lower("r_name").alias("system_id"), F.col("r_name").alias("system_name"),
        F.lit("vehicle_positions").alias("feed_type"), F.col("n_nationkey").alias("load_order"),
    )
    # Added up per feed first, so that the join moves a row per feed.
    per_feed = flat.groupBy("base64url").agg(F.count("*").alias("n"), F.count("vehicle_id").alias("v"))
    return with_feed(per_feed, feed_lookup(named)).groupBy("agency_id", "system_name").agg(
        F.sum("n").alias("positions"), F.sum("v").alias("with_vehicle")
    )


AGENCY_POSITIONS = f"""
WITH {_VP_ROWS},
named AS (SELECT {feed_url_sql('n_nationkey')} AS feed_url, lower(n_name) AS agency_id, r_name AS system_name,
                 row_number() OVER (PARTITION BY {feed_url_sql('n_nationkey')} ORDER BY n_nationkey DESC) AS pos
          FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT agency_id, system_name, count(*) AS positions, count(*) FILTER (WHERE has_vehicle) AS with_vehicle
FROM rows JOIN named USING (feed_url) WHERE pos = 1 GROUP BY ALL"""


# --- trip updates from orders ----------------------------------------------------------------


def trip_fetches(orders: DataFrame) -> DataFrame:
    """One fetch per order: a trip update with 0 to 3 stops."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    seconds = F.floor(F.unix_micros("o_orderdate") / 1_000_000)

    def stop(i: Column) -> Column:
        def event(shift: int) -> Column:
            return F.struct(
                _unless((k + i) % 4 == 1, (k % 600) - 300 + shift).cast("int").alias("delay"),
                _unless((k + i) % 6 == 5, seconds + i * 60 + shift).alias("time"),
                _unless(i == 2, i * 5).cast("int").alias("uncertainty"),
            )

        return F.struct(
            _unless(i == 3, i).alias("stop_sequence"),
            _unless(k % 7 == 0, F.concat(F.lit("stop-"), i.cast("string"))).alias("stop_id"),
            _unless((k + i) % 3 == 0, event(0)).alias("arrival"),
            _unless((k + i) % 5 == 0, event(30)).alias("departure"),
            _unless(k % 2 == 0, i % 4).cast("int").alias("schedule_relationship"),
        )

    stops = F.when(
        k % 4 > 0, F.transform(F.sequence(F.lit(1).cast("bigint"), k % 4), stop)
    ).otherwise(F.slice(F.transform(F.sequence(F.lit(1).cast("bigint"), F.lit(1).cast("bigint")), stop), 1, 0))
    trip = F.struct(
        F.concat(F.lit("trip-"), k.cast("string")).alias("trip_id"),
        _unless(k % 3 == 0, F.col("o_orderpriority")).alias("route_id"),
        _unless(k % 5 == 0, k % 2).alias("direction_id"),
        F.lit(None).cast("string").alias("start_time"),
        F.replace(utc_date(F.col("o_orderdate")).cast("string"), F.lit("-"), F.lit("")).alias("start_date"),
        _unless(k % 6 == 0, F.lit(3)).cast("int").alias("schedule_relationship"),
    )
    vehicle = F.struct(
        F.concat(F.lit("bus-"), c.cast("string")).alias("id"), F.lit(None).cast("string").alias("label"),
        F.lit(None).cast("string").alias("license_plate"),
    )
    update = F.struct(
        trip.alias("trip"), _unless(k % 4 == 2, vehicle).alias("vehicle"),
        _unless(k % 9 == 0, seconds).alias("timestamp"), _unless(k % 8 == 1, k % 100).cast("int").alias("delay"),
        stops.alias("stop_time_update"),
    )
    entity = F.struct(
        F.concat(F.lit("tu-"), k.cast("string")).alias("id"), update.alias("trip_update")
    )
    rows = orders.select("o_orderkey", "o_custkey", "o_orderdate", as_feed(seconds, F.array(entity)).alias("feed"))
    # Milliseconds from the key keep the names of one customer's snapshots apart.
    fetched = F.timestamp_micros(F.unix_micros("o_orderdate") + F.col("o_orderkey") * 1000)
    return encode_feeds(rows).select(
        F.lit("trip_updates").alias("feed_type"), feed_url(F.col("o_custkey")).alias("url"),
        fetched.alias("fetch_ts"), "content",
    )


def trip_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = snapshot_rows(trip_fetches(table(spark, sf_dir, "orders")))
    flat = flatten_snapshots(snapshots, "trip_updates")
    return flat.withColumn("fetch_us", micros(F.col("fetch_timestamp"))).drop(
        "fetch_timestamp", "date", "base64url", "entity_pos"
    )


def _event_sql(name: str, missing: str, shift: int) -> str:
    there = f"i IS NOT NULL AND {missing}"
    return f"""
  CASE WHEN {there} AND (k + i) % 4 <> 1 THEN k % 600 - 300 + {shift} END::INT AS {name}_delay,
  CASE WHEN {there} AND (k + i) % 6 <> 5 THEN s + i * 60 + {shift} END AS {name}_time,
  CASE WHEN {there} AND i <> 2 THEN i * 5 END::INT AS {name}_uncertainty"""


_TU_FETCHED = "(o_orderdate + to_milliseconds(o_orderkey))"

TRIP_UPDATES = f"""
WITH o AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderpriority, epoch_us(o_orderdate) // 1000000 AS s, o_orderdate,
         {feed_url_sql('o_custkey')} AS feed_url,
         {raw_path_sql("'trip_updates'", feed_url_sql('o_custkey'), _TU_FETCHED, 'pb')} AS source_file
  FROM orders),
stops AS (SELECT o_orderkey AS k, unnest(range(1, o_orderkey % 4 + 1)) AS i FROM orders)
SELECT source_file, feed_url, s AS feed_timestamp, epoch_us(o_orderdate) + k * 1000 AS fetch_us,
  'tu-' || k AS entity_id, 'trip-' || k AS trip_id,
  CASE WHEN k % 3 = 0 THEN '' ELSE o_orderpriority END AS route_id,
  CASE WHEN k % 5 <> 0 THEN k % 2 END AS direction_id, '' AS start_time,
  strftime(o_orderdate, '%Y%m%d') AS start_date,
  CASE WHEN k % 6 = 0 THEN 0 ELSE 3 END AS schedule_relationship,
  CASE WHEN k % 4 <> 2 THEN 'bus-' || c END AS vehicle_id,
  CASE WHEN k % 4 <> 2 THEN '' END AS vehicle_label,
  CASE WHEN k % 9 <> 0 THEN s END AS trip_timestamp,
  CASE WHEN k % 8 <> 1 THEN k % 100 END::INT AS trip_delay,
  CASE WHEN i <> 3 THEN i END AS stop_sequence,
  CASE WHEN k % 7 <> 0 AND i IS NOT NULL THEN 'stop-' || i END AS stop_id,
  {_event_sql('arrival', '(k + i) % 3 <> 0', 0)},
  {_event_sql('departure', '(k + i) % 5 <> 0', 30)},
  CASE WHEN k % 2 <> 0 THEN i % 4 END::INT AS stop_schedule_relationship,
  coalesce(i - 1, 0)::INT AS child_pos
FROM o LEFT JOIN stops USING (k)"""


# --- service alerts from documents -----------------------------------------------------------


def alert_fetches(documents: DataFrame) -> DataFrame:
    """One fetch per document: an alert whose description is the whole text."""
    d = F.col("doc_id")
    text = F.col("text")

    def translated(*parts: Column) -> Column:
        return F.struct(F.array(*(F.struct(part.alias("text")) for part in parts)).alias("translation"))

    none_yet = F.struct(F.slice(F.array(F.struct(F.lit("").alias("text"))), 1, 0).alias("translation"))

    def period(start: Column, end: Column) -> Column:
        return F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"))

    periods = F.slice(
        F.array(period(d * 100, _unless(d % 3 == 1, d * 100 + 50)), period(F.lit(1), F.lit(2))), 1, (d % 3).cast("int")
    )

    def informed(i: Column) -> Column:
        trip = F.struct(
            _unless(i == 2, F.concat(F.lit("trip-"), d.cast("string"))).alias("trip_id"),
            F.lit(None).cast("string").alias("route_id"), _unless(d % 2 == 0, i).alias("direction_id"),
            F.lit(None).cast("string").alias("start_time"), F.lit(None).cast("string").alias("start_date"),
            F.lit(None).cast("int").alias("schedule_relationship"),
        )
        return F.struct(
            _unless(i == 1, F.col("source")).alias("agency_id"), _unless(d % 3 == 0, F.col("lang")).alias("route_id"),
            _unless(i == 3, i + 1).cast("int").alias("route_type"),
            _unless(i != 2, F.concat(F.lit("stop-"), d.cast("string"))).alias("stop_id"),
            _unless((d + i) % 3 == 0, trip).alias("trip"),
        )

    one = F.lit(1).cast("bigint")
    entities = F.slice(F.transform(F.sequence(one, F.lit(3).cast("bigint")), informed), 1, (d % 4).cast("int"))
    alert = F.struct(
        _unless(d % 5 == 0, d % 12 + 1).cast("int").alias("cause"),
        _unless(d % 6 == 0, d % 11 + 1).cast("int").alias("effect"),
        _unless(d % 7 == 0, d % 4 + 1).cast("int").alias("severity_level"),
        periods.alias("active_period"),
        _unless(d % 4 == 0, translated(F.concat_ws(" ", "source", "lang"), F.lit("second"))).alias("header_text"),
        translated(text).alias("description_text"),
        F.when(d % 3 == 0, translated(F.concat(F.lit("https://alerts.example.com/"), d.cast("string"))))
        .when(d % 3 == 1, none_yet).alias("url"),
        entities.alias("informed_entity"),
    )
    entity = F.struct(
        F.concat(F.lit("alert-"), d.cast("string")).alias("id"), alert.alias("alert")
    )
    rows = spread(documents).select("doc_id", as_feed(d + 1_700_000_000, F.array(entity)).alias("feed"))
    fetched = F.timestamp_micros((F.col("doc_id") + 1_700_000_000) * 1_000_000)
    return encode_feeds(rows).select(
        F.lit("service_alerts").alias("feed_type"), feed_url(F.col("doc_id")).alias("url"),
        fetched.alias("fetch_ts"), "content",
    )


def service_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = snapshot_rows(alert_fetches(table(spark, sf_dir, "documents")))
    flat = flatten_snapshots(snapshots, "service_alerts")
    return flat.withColumn("fetch_us", micros(F.col("fetch_timestamp"))).drop(
        "fetch_timestamp", "date", "base64url", "entity_pos"
    )


_SA_FETCHED = "make_timestamp((doc_id + 1700000000) * 1000000)"

SERVICE_ALERTS = f"""
WITH d AS (
  SELECT doc_id AS d, text, lang, source, {feed_url_sql('doc_id')} AS feed_url,
         {raw_path_sql("'service_alerts'", feed_url_sql('doc_id'), _SA_FETCHED, 'pb')} AS source_file
  FROM documents),
ie AS (SELECT doc_id AS d, unnest(range(1, doc_id % 4 + 1)) AS i FROM documents)
SELECT source_file, feed_url, d + 1700000000 AS feed_timestamp, (d + 1700000000) * 1000000 AS fetch_us,
  'alert-' || d AS entity_id,
  CASE WHEN d % 5 <> 0 THEN d % 12 + 1 END::INT AS cause,
  CASE WHEN d % 6 <> 0 THEN d % 11 + 1 END::INT AS effect,
  CASE WHEN d % 7 <> 0 THEN d % 4 + 1 END::INT AS severity_level,
  CASE WHEN d % 3 > 0 THEN d * 100 END AS active_period_start,
  CASE WHEN d % 3 = 2 THEN d * 100 + 50 END AS active_period_end,
  CASE WHEN d % 4 <> 0 THEN source || ' ' || lang END AS header_text,
  text AS description_text,
  CASE WHEN d % 3 = 0 THEN 'https://alerts.example.com/' || d END AS url,
  CASE WHEN i <> 1 THEN source END AS agency_id,
  CASE WHEN i IS NOT NULL AND d % 3 <> 0 THEN lang END AS route_id,
  CASE WHEN i <> 3 THEN i + 1 END::INT AS route_type,
  CASE WHEN i = 2 THEN 'stop-' || d END AS stop_id,
  CASE WHEN (d + i) % 3 <> 0 THEN CASE WHEN i = 2 THEN '' ELSE 'trip-' || d END END AS trip_id,
  CASE WHEN (d + i) % 3 <> 0 THEN '' END AS trip_route_id,
  CASE WHEN (d + i) % 3 <> 0 AND d % 2 <> 0 THEN i END AS trip_direction_id,
  coalesce(i - 1, 0)::INT AS child_pos
FROM d LEFT JOIN ie USING (d)"""


# --- sidecars and fetch records --------------------------------------------------------------


def sidecar_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots with the fetch time of their sidecar: every fifth is missing, others are malformed."""
    e, ts = F.col("event_id"), F.col("ts")
    path = raw_path(F.lit("vehicle_positions"), feed_url(F.col("user_id")), ts)
    events = table(spark, sf_dir, "events")
    snapshots = events.select("event_id", path_stem(path).alias("stem"))
    document = (
        F.when(e % 11 == 0, F.lit('{"fetch_timestamp": '))
        .when(e % 13 == 0, F.lit('{"fetch_timestamp": "yesterday"}'))
        .when(e % 17 == 0, F.lit('{"feed_id": "x"}'))
        .otherwise(F.to_json(F.struct(F.lit("x").alias("feed_id"), utc_stamp(ts).alias("fetch_timestamp"))))
    )
    # The sidecar of every fifth snapshot lies under another name.
    beside = F.when(e % 5 == 0, F.concat(path_stem(path), F.lit("-other"))).otherwise(path_stem(path))
    sidecars = events.select(beside.alias("stem"), sidecar_fetch_time(document).alias("fetch_timestamp"))
    joined = attach_fetch_time(snapshots, sidecars)
    return joined.select("event_id", "stem", micros(F.col("fetch_timestamp")).alias("fetch_us"))


SIDECAR_JOIN = f"""
SELECT event_id, {raw_path_sql("'vehicle_positions'", feed_url_sql('user_id'), 'ts', 'pb')[1:-1]
                  .removesuffix(" || '.pb'")} AS stem,
       CASE WHEN event_id % 5 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 THEN NULL
            ELSE epoch_us(ts) // 1000 * 1000 END AS fetch_us
FROM events"""


def fetch_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch records written as JSON and read back, with the headers that were kept."""
    e = F.col("event_id")
    headers = F.create_map(
        F.lit("Content-Type"), F.col("event_type"), F.lit("ETag"), F.concat(F.lit("tag-"), e.cast("string")),
        F.lit("X-Cache"), F.lit("hit"), F.lit("content-length"), F.col("user_id").cast("string"),
    )
    fetches = table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("feed-"), F.col("user_id").cast("string")).alias("feed_id"),
        F.lit("agency").alias("agency_id"), F.lit("Agency").alias("agency_name"),
        F.lit(None).cast("string").alias("system_id"), F.lit(None).cast("string").alias("system_name"),
        F.lit(None).cast("string").alias("schedule_url"), feed_url(F.col("user_id")).alias("url"),
        F.col("ts").alias("fetch_ts"), F.col("value").alias("duration_ms"), F.lit(200).alias("status_code"),
        F.length("props").cast("bigint").alias("content_length"), headers.alias("headers"),
    )
    from transitlake.schemas import SIDECAR

    text = fetches.select("event_id", fetch_record(fetches).alias("document"))
    back = text.select(
        "event_id", F.from_json("document", SIDECAR).alias("r"),
        F.col("document").contains('"system_id":null').alias("keeps_nulls"),
    )
    kept = F.array_join(
        F.array_sort(F.transform(F.map_entries("r.headers"), lambda h: F.concat_ws("=", h["key"], h["value"]))), ";"
    )
    return back.select(
        "event_id", "r.feed_id", "r.url", "r.fetch_timestamp", "r.duration_ms", "r.response_code",
        "r.content_length", "r.content_type", kept.alias("kept_headers"), "keeps_nulls",
    )


FETCH_RECORDS = f"""
SELECT event_id, 'feed-' || user_id AS feed_id, {feed_url_sql('user_id')} AS url,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
         CASE WHEN epoch_us(ts) % 1000000 > 0 THEN '.' || lpad((epoch_us(ts) % 1000000)::VARCHAR, 6, '0') ELSE '' END
         || '+00:00' AS fetch_timestamp,
       value AS duration_ms, 200 AS response_code, length(props) AS content_length, event_type AS content_type,
       'Content-Type=' || event_type || ';ETag=tag-' || event_id || ';content-length=' || user_id AS kept_headers,
       true AS keeps_nulls
FROM events"""

QUERIES = {
    "vehicle_positions": vehicle_positions,
    "trip_updates": trip_updates,
    "service_alerts": service_alerts,
    "rejected_snapshots": rejected,
    "compacted_feeds": compacted_feeds,
    "compaction_runs": compaction_runs,
    "partition_read": partition_read,
    "archive_runs": archive_runs,
    "archive_figures": archive_figures,
    "catalog_sql": catalog_sql,
    "preview_rows": preview_rows,
    "agency_positions": agency_positions,
    "sidecar_join": sidecar_join,
    "fetch_records": fetch_records,
}

ORACLES = {
    "vehicle_positions": VEHICLE_POSITIONS,
    "trip_updates": TRIP_UPDATES,
    "service_alerts": SERVICE_ALERTS,
    "rejected_snapshots": REJECTED,
    "compacted_feeds": COMPACTED_FEEDS,
    "compaction_runs": COMPACTION_RUNS,
    "partition_read": PARTITION_READ,
    "archive_runs": ARCHIVE_RUNS,
    "archive_figures": ARCHIVE_FIGURES,
    "catalog_sql": CATALOG_SQL,
    "preview_rows": PREVIEW_ROWS,
    "agency_positions": AGENCY_POSITIONS,
    "sidecar_join": SIDECAR_JOIN,
    "fetch_records": FETCH_RECORDS,
}
