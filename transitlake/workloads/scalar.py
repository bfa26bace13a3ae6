"""Checks of the column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import transitlake.functions as fn
from transitlake.workloads.tables import (
    base64url_sql,
    feed_key_sql,
    feed_url,
    feed_url_sql,
    micros,
    raw_path_sql,
    table,
)


def base64url_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = fn.base64url_encode(F.col("url"))
    return table(spark, sf_dir, "pages").select(
        "page_id", encoded.alias("base64url"), fn.base64url_decode(encoded).alias("decoded")
    )


BASE64URL_ROUNDTRIP = f"SELECT page_id, {base64url_sql('url')} AS base64url, url AS decoded FROM pages"


def feed_key_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = fn.feed_key(F.col("url"))
    bare = F.regexp_replace("url", "^https?://", "")
    return table(spark, sf_dir, "pages").select(
        "page_id", key.alias("feed_key"), fn.feed_key_url(key).alias("url_again"),
        fn.feed_key_url(fn.feed_key(bare)).alias("schemeless_again"),
    )


FEED_KEY_ROUNDTRIP = f"""
SELECT page_id, {feed_key_sql('url')} AS feed_key, url AS url_again,
       'https://' || regexp_replace(url, '^https?://', '') AS schemeless_again
FROM pages"""


def raw_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = feed_url(F.col("user_id"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        fn.raw_path(F.col("event_type"), url, F.col("ts")).alias("snapshot_path"),
        fn.raw_path(F.col("event_type"), url, F.col("ts"), "meta").alias("sidecar_path"),
    )


RAW_PATH = f"""
SELECT event_id,
       {raw_path_sql('event_type', feed_url_sql('user_id'), 'ts', 'pb')} AS snapshot_path,
       {raw_path_sql('event_type', feed_url_sql('user_id'), 'ts', 'meta')} AS sidecar_path
FROM events"""


def path_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = fn.base64url_encode(feed_url(F.col("user_id")))
    day = fn.utc_date(F.col("ts")).cast("string")
    # One path in nine has another file name, and matches nothing.
    name = F.when(F.col("event_id") % 9 == 0, "part-0.parquet").otherwise("data.parquet")
    compacted = F.concat_ws(
        "/", "event_type", F.concat(F.lit("date="), day), F.concat(F.lit("base64url="), url), name
    )
    version = F.concat_ws(
        "/", F.lit("schedules"), F.concat(F.lit("base64url="), url),
        F.concat(F.lit("_feed_digest="), F.md5("event_type")), F.lit("metadata.json"),
    )
    parsed = table(spark, sf_dir, "events").select(
        "event_id",
        fn.compacted_path_parts(compacted).alias("c"),
        fn.schedule_path_parts(version).alias("s"),
        fn.base64url_segment(compacted).alias("segment"),
        fn.path_stem(compacted).alias("stem"),
    )
    return parsed.select(
        "event_id", F.col("c.feed_type"), F.col("c.date"), F.col("c.base64url"),
        F.col("s.feed_digest"), "segment", "stem",
    )


PATH_PARSE = f"""
WITH p AS (
  SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS day,
         {base64url_sql(feed_url_sql('user_id'))} AS b, event_id % 9 = 0 AS other
  FROM events)
SELECT event_id,
       CASE WHEN other THEN NULL ELSE event_type END AS feed_type,
       CASE WHEN other THEN NULL ELSE day END AS date,
       CASE WHEN other THEN NULL ELSE b END AS base64url,
       md5(event_type) AS feed_digest,
       b AS segment,
       event_type || '/date=' || day || '/base64url=' || b || '/' ||
         CASE WHEN other THEN 'part-0' ELSE 'data' END AS stem
FROM p"""


def _fold_sql(text: str, divisor: str) -> str:
    digits = (
        f"list_transform(range(1, 33), lambda k: (instr('0123456789abcdef', substr(md5({text}), k::INT, 1)) - 1)::BIGINT)"
    )
    return f"list_reduce({digits}, lambda a, x: (a * 16 + x) % {divisor})"


def shard_and_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = F.concat(F.lit("feed-"), F.col("event_id").cast("string"))
    interval = F.when(F.col("event_type") == "view", 60).otherwise(20)
    return table(spark, sf_dir, "events").select(
        "event_id",
        fn.md5_mod(feed, F.lit(7)).alias("shard"),
        fn.in_shard(feed, 2, 4).alias("in_shard_2_of_4"),
        fn.in_shard(feed, 0, 1).alias("in_only_shard"),
        fn.start_offset(feed, interval).alias("start_offset"),
    )


SHARD_AND_OFFSET = f"""
WITH f AS (SELECT event_id, 'feed-' || event_id AS id,
                  CASE WHEN event_type = 'view' THEN 60 ELSE 20 END AS n FROM events)
SELECT event_id, {_fold_sql('id', '7')} AS shard,
       {_fold_sql('id', '4')} = 2 AS in_shard_2_of_4, true AS in_only_shard,
       {_fold_sql('id', 'n')} AS start_offset
FROM f"""


def time_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    text = (
        F.when(F.col("event_id") % 7 == 0, "not a time")
        .when(F.col("event_id") % 5 == 0, F.concat(F.substring(fn.utc_stamp(ts), 1, 23), F.lit("+02:00")))
        .otherwise(fn.utc_stamp(ts))
    )
    now = F.timestamp_micros(F.lit(1_706_745_600_000_000))
    return table(spark, sf_dir, "events").select(
        "event_id",
        fn.utc_date(ts).cast("string").alias("day"),
        fn.utc_hour(ts).alias("hour"),
        fn.previous_day(ts).cast("string").alias("day_before"),
        micros(fn.iso_timestamp(text)).alias("parsed_us"),
        fn.seconds_since(ts, now).alias("seconds_ago"),
    )


TIME_FUNCTIONS = """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%dT%H:00:00Z') AS hour,
       strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') AS day_before,
       CASE WHEN event_id % 7 = 0 THEN NULL
            WHEN event_id % 5 = 0 THEN epoch_us(ts) // 1000 * 1000 - 7200000000
            ELSE epoch_us(ts) // 1000 * 1000 END AS parsed_us,
       round((1706745600000000 - epoch_us(ts)) / 1e6, 1) AS seconds_ago
FROM events"""


def display_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Prices in cents, thousandths of a cent and so on reach every size class.
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    scaled = cents * F.element_at(F.array(*map(F.lit, (1, 10, 1000, 100000))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    value = F.when(F.col("o_orderkey") % 11 == 0, cents % 1000).otherwise(scaled)
    kinds = F.array(*map(F.lit, ("vehicle_positions", "trip_updates", "service_alerts", "shapes")))
    kind = F.element_at(kinds, (F.col("o_orderkey") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", value.alias("value"),
        fn.compact_number(value).alias("number_text"),
        fn.compact_bytes(value).alias("bytes_text"),
        fn.month_day(fn.utc_date(F.col("o_orderdate")).cast("string")).alias("month_day"),
        fn.feed_type_label(kind).alias("label"),
        fn.feed_type_rank(kind).alias("rank"),
    )


def one_decimal_sql(value: str, scale: int) -> str:
    """One decimal with ties of the exact binary value rounded up, in whole numbers."""
    x = f"({value} / {scale}.0::DOUBLE)"
    tenths = f"(((({x} - floor({x})) * 4503599627370496)::BIGINT * 20 + 4503599627370496) >> 53)"
    total = f"(floor({x})::BIGINT * 10 + {tenths})"
    return f"(({total} // 10)::VARCHAR || '.' || ({total} % 10)::VARCHAR)"


def compact_sql(value: str, units: tuple[str, str, str], plain: str) -> str:
    giga, mega, kilo = units
    return f"""(CASE WHEN {value} >= 1000000000 THEN {one_decimal_sql(value, 10**9)} || '{giga}'
       WHEN {value} >= 1000000 THEN {one_decimal_sql(value, 10**6)} || '{mega}'
       WHEN {value} >= 1000 THEN {one_decimal_sql(value, 10**3)} || '{kilo}'
       ELSE {value}::VARCHAR || '{plain}' END)"""


NUMBER_UNITS = ("B", "M", "K")
BYTE_UNITS = (" GB", " MB", " KB")

DISPLAY_FORMS = f"""
WITH v AS (
  SELECT o_orderkey, o_orderdate, round(o_totalprice * 100)::BIGINT AS cents, o_orderkey % 4 AS k FROM orders),
w AS (
  SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN cents % 1000
                 ELSE cents * (CASE k WHEN 0 THEN 1 WHEN 1 THEN 10 WHEN 2 THEN 1000 ELSE 100000 END) END AS value
  FROM v)
SELECT o_orderkey, value, {compact_sql('value', NUMBER_UNITS, '')} AS number_text,
       {compact_sql('value', BYTE_UNITS, ' B')} AS bytes_text,
       strftime(o_orderdate, '%m/%d') AS month_day,
       CASE k WHEN 0 THEN 'Vehicle Positions' WHEN 1 THEN 'Trip Updates' WHEN 2 THEN 'Service Alerts'
              ELSE 'shapes' END AS label,
       k::INT AS rank
FROM w"""

QUERIES = {
    "base64url_roundtrip": base64url_roundtrip,
    "feed_key_roundtrip": feed_key_roundtrip,
    "raw_path": raw_path,
    "path_parse": path_parse,
    "shard_and_offset": shard_and_offset,
    "time_functions": time_functions,
    "display_forms": display_forms,
}

ORACLES = {
    "base64url_roundtrip": BASE64URL_ROUNDTRIP,
    "feed_key_roundtrip": FEED_KEY_ROUNDTRIP,
    "raw_path": RAW_PATH,
    "path_parse": PATH_PARSE,
    "shard_and_offset": SHARD_AND_OFFSET,
    "time_functions": TIME_FUNCTIONS,
    "display_forms": DISPLAY_FORMS,
}
