"""Feed URL codecs: unpadded base64url and the short feed key.

Each function uses its argument once or on cheap tests only, because Catalyst copies an argument to
every place where it is used.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Marker of plain-http feeds in a feed key.
HTTP_MARK = "~"


def base64url_encode(url: Column) -> Column:
    """URL-safe base64 without padding. Spark breaks long base64 into lines; the breaks go too."""
    return F.translate(F.base64(F.encode(url, "UTF-8")), "+/=\r\n", "-_")


def base64url_decode(encoded: Column) -> Column:
    """Text behind a base64url string, padded or not; NULL when it is not base64 or not UTF-8."""
    # A lone character in the last group of four carries less than a byte.
    valid = encoded.rlike(r"^(?:[A-Za-z0-9_-]{4})*(?:[A-Za-z0-9_-]{2,3}=*)?$")
    binary = F.unbase64(F.translate(encoded, "-_=", "+/"))
    return F.when(valid, F.try_validate_utf8(binary.cast("string")))


def feed_key(url: Column) -> Column:
    """Short key of a feed URL: https is dropped, http becomes a mark, anything else stays."""
    marked = F.regexp_replace(url, "^http://", HTTP_MARK)
    return F.regexp_replace(marked, "^https://", "")


def feed_key_url(key: Column) -> Column:
    """URL behind a feed key. A key without scheme or mark is read as https."""
    return F.regexp_replace(F.concat(F.lit("https://"), key), f"^https://{HTTP_MARK}", "http://")


def feed_url(base64url: Column) -> Column:
    """Feed URL of an encoded folder name, by way of its key: without a scheme it becomes https."""
    return feed_key_url(feed_key(base64url_decode(base64url)))
