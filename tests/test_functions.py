from __future__ import annotations

import base64
import hashlib
from datetime import datetime, timezone

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import transitlake.functions as fn


URL = "https://ferries.example/quay-3.pb"


def column(spark, values, make, kind="STRING"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [row["out"] for row in df.select("i", make(F.col("v")).alias("out")).orderBy("i").collect()]


def test_base64url_known_values(spark):
    urls = ["http://harbour.example/trams", "https://ferries.example/quay-3?key=~~~>>>", "ü"]
    expected = [base64.urlsafe_b64encode(url.encode()).decode().rstrip("=") for url in urls]
    assert column(spark, urls, fn.base64url_encode) == expected
    padded = [base64.urlsafe_b64encode(url.encode()).decode() for url in urls]
    assert column(spark, expected + padded, fn.base64url_decode) == urls + urls


def test_base64url_rejects_what_is_no_text(spark):
    assert column(spark, ["!!", "_w", "a", "abcde", None], fn.base64url_decode) == [None] * 5


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=("Cs",)), max_size=120), min_size=20, max_size=60))
def test_base64url_round_trip(spark, texts):
    encoded = column(spark, texts, fn.base64url_encode)
    assert encoded == [base64.urlsafe_b64encode(t.encode()).decode().rstrip("=") for t in texts]
    assert column(spark, encoded, fn.base64url_decode) == texts


def test_feed_keys(spark):
    urls = ["https://example.com/feed", "http://example.com/feed", "example.com/feed", "http://https://x", "~odd"]
    keys = column(spark, urls, fn.feed_key)
    assert keys == ["example.com/feed", "~example.com/feed", "example.com/feed", "~https://x", "~odd"]
    again = column(spark, keys, fn.feed_key_url)
    assert again == ["https://example.com/feed", "http://example.com/feed", "https://example.com/feed", "http://https://x", "http://odd"]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.from_regex(r"https?://[a-z]{1,8}\.com/[A-Za-z0-9_?=&~-]{0,40}", fullmatch=True), min_size=10, max_size=40))
def test_feed_key_round_trip(spark, urls):
    assert column(spark, column(spark, urls, fn.feed_key), fn.feed_key_url) == urls
    assert column(spark, column(spark, urls, fn.base64url_encode), fn.feed_url) == urls


def at(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_raw_path_in_any_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        times = [at(2025, 1, 15, 14, 20, 30, 123999), at(2025, 1, 15, 14, 59, 59, 999000), at(2025, 3, 9, 7, 30)]
        paths = column(
            spark, times, lambda ts: fn.raw_path(F.lit("vehicle_positions"), F.lit(URL), ts), "TIMESTAMP"
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    b64 = base64.urlsafe_b64encode(URL.encode()).decode().rstrip("=")
    assert paths == [
        f"vehicle_positions/date=2025-01-15/hour=2025-01-15T14:00:00Z/base64url={b64}/2025-01-15T14:20:30.123Z.pb",
        f"vehicle_positions/date=2025-01-15/hour=2025-01-15T14:00:00Z/base64url={b64}/2025-01-15T14:59:59.999Z.pb",
        f"vehicle_positions/date=2025-03-09/hour=2025-03-09T07:00:00Z/base64url={b64}/2025-03-09T07:30:00.000Z.pb",
    ]


def test_path_parts(spark):
    paths = [
        "trip_updates/date=2025-01-15/base64url=ab_-9/data.parquet",
        "trip_updates/date=2025-01-15/base64url=ab/other.parquet",
        "schedules/base64url=ab/_feed_digest=ff00/metadata.json",
        "schedules/base64url=ab/_feed_digest=ff00/stops.parquet",
    ]
    compacted = column(spark, paths, fn.compacted_path_parts)
    assert [tuple(c) for c in compacted] == [("trip_updates", "2025-01-15", "ab_-9")] + [(None, None, None)] * 3
    versions = column(spark, paths, fn.schedule_path_parts)
    assert [tuple(v) for v in versions] == [(None, None)] * 2 + [("ab", "ff00")] + [(None, None)]
    assert column(spark, paths, fn.base64url_segment) == ["ab_-9", "ab", "ab", "ab"]


def test_iso_timestamps(spark):
    texts = [
        "2025-01-15T14:20:30.123456+00:00", "2025-01-15T14:20:30", "2025-01-15", "2025-01-15T14:20:30+02:00",
        "2025-01-15T14:20:30Z", "12:30", "yesterday", "", None, "2025-13-15",
    ]
    micros = column(spark, texts, lambda t: F.unix_micros(fn.iso_timestamp(t)))
    base = 1736950830_000000
    assert micros == [base + 123456, base, 1736899200_000000, base - 7200_000000, base] + [None] * 5


def test_shards_match_md5(spark):
    ids = [f"agency-{i}-vehicle-positions" for i in range(100)]
    numbers = [int(hashlib.md5(i.encode()).hexdigest(), 16) for i in ids]
    assert column(spark, ids, lambda c: fn.start_offset(c, F.lit(20))) == [n % 20 for n in numbers]
    assert column(spark, ids, lambda c: fn.start_offset(c, F.lit(2**31 - 1))) == [n % (2**31 - 1) for n in numbers]
    owners = [column(spark, ids, lambda c, s=s: fn.in_shard(c, s, 4)) for s in range(4)]
    assert all(sum(flags) == 1 for flags in zip(*owners))
    assert all(column(spark, ids, lambda c: fn.in_shard(c, 0, 1)))


def test_names(spark):
    cases = [
        (("harbour", None, "trip_updates", "Harbour Line", None, None), ("harbour-trip-updates", "Harbour Line Trip Updates")),
        (("valley", "lift", "service_alerts", "Valley", "Cliff Lift", None), ("valley-lift-service-alerts", "Valley Cliff Lift Service Alerts")),
        (("valley", "", "vehicle_positions", "Valley", "", "Where trams are"), ("valley-vehicle-positions", "Where trams are")),
    ]
    df = spark.createDataFrame([c[0] for c in cases], "a STRING, s STRING, t STRING, an STRING, sn STRING, n STRING")
    rows = df.select(
        fn.feed_id(F.col("a"), F.col("s"), F.col("t")).alias("id"),
        fn.feed_name(F.col("n"), F.col("an"), F.col("sn"), F.col("t")).alias("name"),
    ).collect()
    assert [tuple(r) for r in rows] == [c[1] for c in cases]


def test_display(spark):
    numbers = [0, 999, 1000, 1150, 1250, 999_950, 1_250_000, 123_456_789_012]
    assert column(spark, numbers, fn.compact_number, "BIGINT") == [
        "0", "999", "1.0K", "1.1K", "1.3K", "1000.0K", "1.3M", "123.5B"
    ]
    assert column(spark, [12, 1500, 2_000_000, 3_000_000_000], fn.compact_bytes, "BIGINT") == ["12 B", "1.5 KB", "2.0 MB", "3.0 GB"]
    assert column(spark, ["2025-01-15"], fn.month_day) == ["01/15"]
    assert column(spark, ["trip_updates", "other"], fn.feed_type_label) == ["Trip Updates", "other"]
    assert column(spark, ["service_alerts", "other"], fn.feed_type_rank) == [2, 3]
