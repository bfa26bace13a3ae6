"""Feed identifiers and display names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def feed_id(agency: Column, system: Column, feed_type: Column) -> Column:
    """agency[-system]-type, with hyphens in the type."""
    return F.concat_ws("-", agency, F.nullif(system, F.lit("")), F.replace(feed_type, F.lit("_"), F.lit("-")))


def feed_name(name: Column, agency: Column, system: Column, feed_type: Column) -> Column:
    """The given name, else agency [system] and the type in title case."""
    title = F.initcap(F.replace(feed_type, F.lit("_"), F.lit(" ")))
    made = F.concat_ws(" ", agency, F.nullif(system, F.lit("")), title)
    return F.coalesce(F.nullif(name, F.lit("")), made)
