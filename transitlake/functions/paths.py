"""Builders and parsers of object paths in the archive."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from transitlake.functions.codec import base64url_encode
from transitlake.functions.times import utc_date, utc_hour, utc_stamp

# The layouts of the compacted and the schedule layer.
COMPACTED_PATH = r"^([^/]+)/date=(\d{4}-\d{2}-\d{2})/base64url=([A-Za-z0-9_-]+)/data\.parquet$"
SCHEDULE_PATH = r"^schedules/base64url=([A-Za-z0-9_-]+)/_feed_digest=([^/]+)/metadata\.json$"
SEGMENT = r"base64url=([A-Za-z0-9_-]+)/"


def raw_path(feed_type: Column, url: Column, fetched: Column, extension: str = "pb") -> Column:
    """Raw object path: type / date / hour / encoded URL / time stamp, all from the fetch start."""
    return F.concat_ws(
        "/",
        feed_type,
        F.concat(F.lit("date="), utc_date(fetched).cast("string")),
        F.concat(F.lit("hour="), utc_hour(fetched)),
        F.concat(F.lit("base64url="), base64url_encode(url)),
        F.concat(utc_stamp(fetched), F.lit("." + extension)),
    )


def _group(path: Column, pattern: str, index: int) -> Column:
    return F.when(path.rlike(pattern), F.regexp_extract(path, pattern, index))


def compacted_path_parts(path: Column) -> Column:
    """STRUCT(feed_type, date, base64url) of a compacted file; fields are NULL for other paths."""
    return F.struct(
        *(
            _group(path, COMPACTED_PATH, i).alias(name)
            for i, name in enumerate(("feed_type", "date", "base64url"), start=1)
        )
    )


def schedule_path_parts(path: Column) -> Column:
    """STRUCT(base64url, feed_digest) of a version record; fields are NULL for other paths."""
    return F.struct(
        *(
            _group(path, SCHEDULE_PATH, i).alias(name)
            for i, name in enumerate(("base64url", "feed_digest"), start=1)
        )
    )


def base64url_segment(path: Column) -> Column:
    """Encoded URL anywhere in a path, NULL when there is none."""
    return _group(path, SEGMENT, 1)


def path_stem(path: Column) -> Column:
    """Path without its last extension: what a snapshot and its sidecar have in common."""
    return F.regexp_replace(path, r"\.[^./]+$", "")
