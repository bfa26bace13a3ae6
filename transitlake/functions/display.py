"""Short forms for reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Labels and ranks of the feed types.
FEED_TYPE_LABELS = {
    "vehicle_positions": "Vehicle Positions",
    "trip_updates": "Trip Updates",
    "service_alerts": "Service Alerts",
}
FEED_TYPE_RANKS = {"vehicle_positions": 0, "trip_updates": 1, "service_alerts": 2}
OTHER_RANK = 3


def _one_decimal(value: Column) -> Column:
    """A positive double with one decimal, ties of its exact binary value rounded up.

    ``format_string`` rounds the shortest decimal text instead, which differs for values such as
    1.15. The fraction is scaled by 2^52, where it is a whole number, and rounded in integers.
    """
    whole = F.floor(value)
    scaled = ((value - whole) * F.lit(float(1 << 52))).cast("bigint")
    tenths = F.shiftright(scaled * 20 + F.lit(1 << 52), 53)
    total = whole.cast("bigint") * 10 + tenths
    return F.concat_ws(".", F.floor(total / 10).cast("string"), F.pmod(total, F.lit(10)).cast("string"))


def _scaled(value: Column, units: tuple[str, str, str], plain: Column) -> Column:
    giga, mega, kilo = (F.lit(unit) for unit in units)
    return (
        F.when(value >= 1_000_000_000, F.concat(_one_decimal(value / 1e9), giga))
        .when(value >= 1_000_000, F.concat(_one_decimal(value / 1e6), mega))
        .when(value >= 1_000, F.concat(_one_decimal(value / 1e3), kilo))
        .otherwise(plain)
    )


def compact_number(value: Column) -> Column:
    """1.2K / 3.4M / 5.6B; below a thousand the number itself."""
    return _scaled(value, ("B", "M", "K"), value.cast("string"))


def compact_bytes(value: Column) -> Column:
    """1.2 KB / 3.4 MB / 5.6 GB in powers of ten."""
    return _scaled(value, (" GB", " MB", " KB"), F.concat(value.cast("string"), F.lit(" B")))


def month_day(iso: Column) -> Column:
    """``YYYY-MM-DD`` text as ``MM/DD``."""
    return F.concat_ws("/", F.split_part(iso, F.lit("-"), F.lit(2)), F.split_part(iso, F.lit("-"), F.lit(3)))


def _lookup(values: dict, key: Column) -> Column:
    found = F.lit(None)
    for name, value in values.items():
        found = F.when(key == name, F.lit(value)).otherwise(found)
    return found


def feed_type_label(feed_type: Column) -> Column:
    """Display label of a feed type; an unknown type shows as it is."""
    return F.coalesce(_lookup(FEED_TYPE_LABELS, feed_type), feed_type)


def feed_type_rank(feed_type: Column) -> Column:
    """Sort rank of a feed type; unknown types come last."""
    return F.coalesce(_lookup(FEED_TYPE_RANKS, feed_type), F.lit(OTHER_RANK))
