"""Catalogue and discovery checks: events as data files and listings, customers as the feed lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from transitlake.functions import base64url_encode, feed_key, utc_date
from transitlake.functions.codec import base64url_decode
from transitlake.operators.discovery import (
    feeds_over_days,
    new_feeds,
    pending,
    present_feeds,
    run_requests,
    work_grid,
)
from transitlake.operators.inventory import (
    agency_rollup,
    archive_stats,
    feed_listing,
    inventory,
    inventory_totals,
    unmapped,
)
from transitlake.session import work_folder
from transitlake.sinks.catalogue import read_inventory, write_inventory
from transitlake.workloads.scalar import BYTE_UNITS, NUMBER_UNITS, compact_sql
from transitlake.workloads.tables import base64url_sql, feed_key_sql, table

# --- stand-ins -------------------------------------------------------------------------------


def _url(number: Column) -> Column:
    text = number.cast("string")
    return F.concat(F.when(number % 7 == 0, "http").otherwise("https"), F.lit("://data.example.com/"), text)


def _url_sql(number: str) -> str:
    return f"((CASE WHEN {number} % 7 = 0 THEN 'http' ELSE 'https' END) || '://data.example.com/' || {number})"


def data_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One data file per event type, day and user; its rows are events and its size their values."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("feed_type"), utc_date(F.col("ts")).cast("string").alias("date"),
        base64url_encode(_url(F.col("user_id"))).alias("base64url"),
        F.round(F.col("value") * 100000).cast("bigint").alias("bytes"),
    )
    return events.groupBy("feed_type", "date", "base64url").agg(
        F.count("*").alias("row_count"), F.sum("bytes").alias("size_bytes")
    )


_KINDS = ("vehicle_positions", "trip_updates", "service_alerts", "shapes")


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifteen customers name each feed, the last one wins; users beyond them, or named without URL, are unmapped."""
    c = F.col("c_custkey")
    n = F.floor(c / 15)
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return customers.select(
        base64url_encode(_url(n)).alias("base64url"),
        F.when(n % 13 == 5, "").otherwise(_url(n)).alias("url"),
        F.when(c % 17 != 0, F.concat(F.lit("agency-"), F.col("n_regionkey").cast("string"))).alias("agency_id"),
        F.concat(F.lit("Agency "), F.col("n_regionkey").cast("string")).alias("agency_name"),
        F.when(c % 5 != 0, F.col("c_mktsegment")).alias("system_id"),
        F.when(c % 5 != 0, F.initcap("c_mktsegment")).alias("system_name"),
        F.element_at(F.array(*map(F.lit, _KINDS)), (c % 4 + 1).cast("int")).alias("feed_type"),
        c.alias("load_order"),
    )


_FILES = f"""
files AS (
  SELECT event_type AS feed_type, strftime(ts, '%Y-%m-%d') AS date, {base64url_sql(_url_sql('user_id'))} AS base64url,
         count(*) AS row_count, sum(round(value * 100000)::BIGINT)::BIGINT AS size_bytes
  FROM events GROUP BY ALL),
named AS (
  SELECT {base64url_sql(_url_sql('(c_custkey // 15)'))} AS base64url,
         CASE WHEN (c_custkey // 15) % 13 = 5 THEN '' ELSE {_url_sql('(c_custkey // 15)')} END AS url,
         CASE WHEN c_custkey % 17 <> 0 THEN 'agency-' || n_regionkey END AS agency_id,
         'Agency ' || n_regionkey AS agency_name,
         CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS system_id,
         CASE WHEN c_custkey % 5 <> 0 THEN upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) END AS system_name,
         CASE c_custkey % 4 WHEN 0 THEN 'vehicle_positions' WHEN 1 THEN 'trip_updates' WHEN 2 THEN 'service_alerts'
              ELSE 'shapes' END AS feed_type,
         row_number() OVER (PARTITION BY c_custkey // 15 ORDER BY c_custkey DESC) AS pos
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
totals AS (
  SELECT base64url, min(date) AS date_min, max(date) AS date_max, sum(row_count)::BIGINT AS total_records,
         sum(size_bytes)::BIGINT AS total_bytes, count(*) AS n_files
  FROM files GROUP BY base64url),
joined AS (
  SELECT t.*, n.url, n.agency_id, n.agency_name, n.system_id, n.system_name, n.feed_type,
         coalesce(n.url, '') <> '' AS mapped
  FROM totals t LEFT JOIN (SELECT * FROM named WHERE pos = 1) n USING (base64url)),
inv AS (
  SELECT url, base64url, agency_id, agency_name, system_id, system_name, feed_type, date_min, date_max,
         total_records, total_bytes
  FROM joined WHERE mapped)"""


def _inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory(data_files(spark, sf_dir), lookup(spark, sf_dir))


def inventory_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory, written as its JSON document and read back."""
    path = f"{work_folder(spark, 'inventory')}/inventory.json"
    write_inventory(_inventory(spark, sf_dir), path)
    return read_inventory(spark, path)


def unmapped_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unmapped(data_files(spark, sf_dir), lookup(spark, sf_dir))


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory_totals(data_files(spark, sf_dir), lookup(spark, sf_dir))


TOTALS = f"""
WITH {_FILES}
SELECT count(*) FILTER (WHERE mapped) AS feeds_count, sum(n_files)::BIGINT AS files_processed,
       (sum(total_records) FILTER (WHERE mapped))::BIGINT AS total_records,
       (sum(total_bytes) FILTER (WHERE mapped))::BIGINT AS total_bytes
FROM joined"""

_NUMBER = compact_sql("total_records", NUMBER_UNITS, "")
_BYTES = compact_sql("total_bytes", BYTE_UNITS, " B")
_RANGE = "replace(date_min[6:], '-', '/') || ' – ' || replace(date_max[6:], '-', '/')"


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_stats(_inventory(spark, sf_dir))


STATS = f"""
WITH {_FILES},
s AS (SELECT count(DISTINCT coalesce(agency_id, '')) AS agencies, count(*) AS feeds,
             sum(total_records)::BIGINT AS total_records, sum(total_bytes)::BIGINT AS total_bytes,
             min(date_min) AS date_min, max(date_max) AS date_max FROM inv)
SELECT *, {_NUMBER} AS records_text, {_BYTES} AS size_text, {_RANGE} AS range_text FROM s"""


def agencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agency_rollup(_inventory(spark, sf_dir))


AGENCIES = f"""
WITH {_FILES},
a AS (SELECT agency_id, min(agency_name) AS agency_name, count(*) AS feeds, sum(total_records)::BIGINT AS total_records,
             sum(total_bytes)::BIGINT AS total_bytes, count(DISTINCT nullif(system_id, '')) > 1 AS multiple_systems
      FROM inv GROUP BY agency_id)
SELECT *, {_NUMBER} AS records_text, {_BYTES} AS size_text FROM a"""


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_listing(_inventory(spark, sf_dir))


LISTING = f"""
WITH {_FILES},
l AS (SELECT *, CASE feed_type WHEN 'vehicle_positions' THEN 'Vehicle Positions' WHEN 'trip_updates' THEN 'Trip Updates'
                     WHEN 'service_alerts' THEN 'Service Alerts' ELSE feed_type END AS name FROM inv)
SELECT agency_id, agency_name, system_name, feed_type, base64url,
       name || coalesce(' / ' || nullif(system_name, ''), '') AS label,
       CASE feed_type WHEN 'vehicle_positions' THEN 0 WHEN 'trip_updates' THEN 1 WHEN 'service_alerts' THEN 2 ELSE 3 END AS type_rank,
       {_RANGE} AS range_text, {_NUMBER} AS records_text, {_BYTES} AS size_text, date_max AS preview_date
FROM l"""

# --- discovery -------------------------------------------------------------------------------


def raw_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listed snapshot per event; the folder name of every 50th user is not base64url."""
    u = F.col("user_id")
    name = F.when(u % 50 == 49, "@@").otherwise(base64url_encode(_url(u)))
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("feed_type"), utc_date(F.col("ts")).alias("date"), name.alias("base64url")
    )


def _keyed(listing: DataFrame) -> DataFrame:
    key = feed_key(base64url_decode(F.col("base64url")))
    return present_feeds(listing).select("feed_type", "date", key.alias("feed_key")).where(F.col("feed_key").isNotNull())


_PRESENT = f"""
present AS (
  SELECT DISTINCT event_type AS feed_type, strftime(ts, '%Y-%m-%d') AS date, {feed_key_sql(_url_sql('user_id'))} AS feed_key
  FROM events WHERE user_id % 50 <> 49)"""


def discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = feeds_over_days(raw_listing(spark, sf_dir), "2024-01-30", 30)
    return found.select("feed_type", "feed_key", "n_dates", F.array_join("dates", ",").alias("dates"))


DISCOVERED = f"""
WITH {_PRESENT}
SELECT feed_type, feed_key, count(*)::INT AS n_dates, string_agg(date, ',' ORDER BY date) AS dates
FROM present GROUP BY ALL"""


def unknown_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _keyed(raw_listing(spark, sf_dir))
    day = F.lit("2024-01-04").cast("date")
    return new_feeds(keyed.where(F.col("date") >= day), keyed.where(F.col("date") < day))


UNKNOWN_FEEDS = f"""
WITH {_PRESENT}
SELECT DISTINCT feed_type, feed_key FROM present p WHERE date >= '2024-01-04' AND NOT EXISTS (
  SELECT 1 FROM present q WHERE q.date < '2024-01-04' AND q.feed_type = p.feed_type AND q.feed_key = p.feed_key)"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_requests(_keyed(raw_listing(spark, sf_dir)))


REQUESTS = f"""
WITH {_PRESENT}
SELECT feed_type || '_' || date || '_' || feed_key AS run_key, feed_type, date, feed_key FROM present"""


def pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of January without data, for every feed known by then."""
    keyed = _keyed(raw_listing(spark, sf_dir))
    known = keyed.select("feed_type", "feed_key").distinct()
    open_cells = pending(work_grid(known, "2024-01-01", "2024-01-31"), keyed)
    return open_cells.select("feed_type", "feed_key", F.col("date").cast("string").alias("date"))


PENDING_WORK = f"""
WITH {_PRESENT},
grid AS (SELECT feed_type, feed_key, strftime(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)), '%Y-%m-%d') AS date
         FROM (SELECT DISTINCT feed_type, feed_key FROM present))
SELECT * FROM grid EXCEPT SELECT feed_type, feed_key, date FROM present"""


QUERIES = {
    "inventory": inventory_document,
    "inventory_unmapped": unmapped_feeds,
    "inventory_totals": totals,
    "archive_stats": stats,
    "agency_rollup": agencies,
    "feed_listing": listing,
    "discovered_feeds": discovered,
    "new_feeds": unknown_feeds,
    "run_requests": requests,
    "pending_work": pending_work,
}

ORACLES = {
    "inventory": f"WITH {_FILES} SELECT * FROM inv",
    "inventory_unmapped": f"WITH {_FILES} SELECT base64url, n_files, total_records, total_bytes FROM joined WHERE NOT mapped",
    "inventory_totals": TOTALS,
    "archive_stats": STATS,
    "agency_rollup": AGENCIES,
    "feed_listing": LISTING,
    "discovered_feeds": DISCOVERED,
    "new_feeds": UNKNOWN_FEEDS,
    "run_requests": REQUESTS,
    "pending_work": PENDING_WORK,
}
