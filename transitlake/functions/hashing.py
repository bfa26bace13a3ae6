"""Stable placement of feeds by the remainder of their 128-bit MD5."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def md5_mod(text: Column, divisor: Column) -> Column:
    """MD5 of ``text`` as one 128-bit number, modulo ``divisor``.

    The digest is read in four 32-bit words; each step stays below 2^63 for divisors under 2^31.
    """
    digest = F.md5(text)
    rest = F.lit(0).cast("bigint")
    for start in (1, 9, 17, 25):
        word = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
        rest = F.pmod(rest * F.lit(1 << 32) + word, divisor.cast("bigint"))
    return rest


def start_offset(feed_id: Column, interval_seconds: Column) -> Column:
    """Seconds by which a feed is shifted inside its polling interval."""
    return md5_mod(feed_id, interval_seconds)


def in_shard(feed_id: Column, shard: int, shards: int) -> Column:
    """Whether a feed belongs to one of ``shards`` workers; a single worker takes every feed."""
    if shards <= 1:
        return F.lit(True)
    return md5_mod(feed_id, F.lit(shards)) == shard
