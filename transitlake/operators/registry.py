"""Agency registry to flat feeds: inheritance, validity, the feed dimension, schedule URLs."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from transitlake.functions.codec import base64url_encode
from transitlake.functions.naming import feed_id, feed_name
from transitlake.schemas import FEEDS, FEED_TYPES, struct
from transitlake.sources.registry import DEFAULT_INTERVALS, DEFAULT_RETRY, DEFAULT_TIMEOUT

DEFAULTS: dict[str, Any] = {
    "intervals": DEFAULT_INTERVALS,
    "timeout_seconds": DEFAULT_TIMEOUT,
    "retry": DEFAULT_RETRY,
}

# What a registry may hold.
ID_PATTERN = r"^[a-z0-9-]+$"
SECRET_PATTERN = r"^[a-zA-Z0-9_-]+$"
AUTH_TYPES = ("header", "query")
INTERVAL_RANGE = (5, 3600)
TIMEOUT_RANGE = (1, 120)
ATTEMPTS_RANGE = (1, 10)
BACKOFF_BASE_RANGE = (0.1, 10.0)
BACKOFF_MAX_RANGE = (1.0, 60.0)


def http_url(url: Column) -> Column:
    """URL in its normal form: scheme and host in lower case, no default port, never an empty path."""
    head = F.lower(F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]*", 0))
    head = F.regexp_replace(head, r"^(https://.*):443$|^(http://.*):80$", "$1$2")
    tail = F.regexp_replace(url, r"^[A-Za-z]+://[^/?#]*", "")
    return F.regexp_replace(F.concat(head, tail), r"^([a-z]+://[^/?#]+)(?=[?#]|$)", "$1/")


def schedule_url_list(url: Column, urls: Column) -> Column:
    """One list of schedule URLs: a single URL becomes a list, or leads the list that lacks it."""
    single = F.array_compact(F.array(http_url(url)))
    # The list is searched once it is normal as well; array_except would drop repeated entries.
    listed = F.transform(urls, http_url)
    return F.when(urls.isNull(), single).otherwise(
        F.concat(F.filter(single, lambda u: ~F.array_contains(listed, u)), listed)
    )


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row.

    Catalyst copies a projected expression into every place that uses it; as the output of a
    generator it is a plain attribute instead.
    """
    values = F.struct(*(column.alias(name) for name, column in columns.items()))
    return df.select("*", F.inline(F.array(values)))


def _owners(agencies: DataFrame) -> DataFrame:
    """One row per owner of feeds: each system of an agency, else the agency itself."""
    has_systems = F.coalesce(F.size("systems"), F.lit(0)) > 0
    owner = agencies.schema["systems"].dataType.elementType
    agency_itself = F.struct(
        F.lit(None).cast("string").alias("id"),
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("schedule_url"),
        F.lit(None).cast("array<string>").alias("schedule_urls"),
        F.lit(None).cast(owner["auth"].dataType).alias("auth"),
        F.col("feeds").alias("feeds"),
    )
    owners = F.when(has_systems, F.col("systems")).otherwise(F.array(agency_itself))
    rows = agencies.select(
        "agency_pos",
        F.col("id").alias("agency_id"),
        F.col("name").alias("agency_name"),
        F.col("auth").alias("agency_auth"),
        "schedule_url",
        "schedule_urls",
        F.posexplode(owners).alias("system_pos", "owner"),
    )
    return once(
        rows,
        agency_urls=schedule_url_list(F.col("schedule_url"), F.col("schedule_urls")),
        system_urls=schedule_url_list(F.col("owner.schedule_url"), F.col("owner.schedule_urls")),
    )


def flatten_registry(agencies: DataFrame, defaults: dict[str, Any] = DEFAULTS) -> DataFrame:
    """One row per feed with everything inherited, in registry order.

    Feed settings win over type and global defaults; auth comes from feed, system or agency, in this
    order; schedule URLs come from the system or else the agency. Narrow: nothing is shuffled.
    """
    rows = _owners(agencies).select(
        "agency_pos", "system_pos", "agency_id", "agency_name", "agency_auth",
        F.col("owner.id").alias("system_id"),
        F.col("owner.name").alias("system_name"),
        F.col("owner.auth").alias("system_auth"),
        F.when(F.size("system_urls") > 0, F.col("system_urls")).otherwise(F.col("agency_urls")).alias("urls"),
        F.posexplode("owner.feeds").alias("feed_pos", "feed"),
    )
    interval = F.lit(None).cast("int")
    for feed_type, seconds in defaults["intervals"].items():
        interval = F.when(F.col("feed.feed_type") == feed_type, F.lit(seconds)).otherwise(interval)
    retry = F.struct(
        F.lit(defaults["retry"]["max_attempts"]).cast("int").alias("max_attempts"),
        F.lit(defaults["retry"]["backoff_base"]).cast("double").alias("backoff_base"),
        F.lit(defaults["retry"]["backoff_max"]).cast("double").alias("backoff_max"),
    )
    agency, system, kind = F.col("agency_id"), F.col("system_id"), F.col("feed.feed_type")
    flat = once(
        rows,
        feed_id=feed_id(agency, system, kind),
        feed_name=feed_name(F.col("feed.name"), F.col("agency_name"), F.col("system_name"), kind),
        url=http_url(F.col("feed.url")),
        feed_type=kind,
        schedule_url=F.get("urls", F.lit(0)),
        schedule_urls=F.col("urls"),
        interval_seconds=F.coalesce("feed.interval_seconds", interval),
        timeout_seconds=F.coalesce("feed.timeout_seconds", F.lit(defaults["timeout_seconds"])),
        retry=F.coalesce("feed.retry", retry),
        auth=F.coalesce("feed.auth", "system_auth", "agency_auth"),
    )
    return flat.drop("feed", "urls", "agency_auth", "system_auth")


def feeds_dimension(feeds: DataFrame) -> DataFrame:
    """The twelve columns of the feed dimension from flat feeds."""
    # The list is kept as JSON text with a space after each comma.
    listed = F.concat(F.lit('["'), F.array_join("schedule_urls", '", "'), F.lit('"]'))
    rows = feeds.select(
        base64url_encode(F.col("url")).alias("base64url"),
        "url", "feed_type", "feed_id", "feed_name", "agency_id", "agency_name", "system_id",
        "system_name", "interval_seconds", "schedule_url",
        F.when(F.size("schedule_urls") > 0, listed).alias("schedule_urls"),
    )
    return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in struct(FEEDS)))


def _rule(name: str, broken: Column) -> Column:
    return F.when(F.coalesce(broken, F.lit(False)), F.lit(name))


def _outside(value: Column, bounds: tuple) -> Column:
    return value.isNotNull() & ~value.between(*bounds)


def _auth_rules(auth: Column) -> list[Column]:
    return [
        _rule("auth_type", auth.isNotNull() & ~F.coalesce(auth["type"].isin(*AUTH_TYPES), F.lit(False))),
        _rule(
            "auth_secret_name",
            auth.isNotNull() & ~F.coalesce(auth["secret_name"].rlike(SECRET_PATTERN), F.lit(False)),
        ),
        _rule("auth_key", auth.isNotNull() & auth["key"].isNull()),
    ]


def _bad_id(value: Column) -> Column:
    return value.isNull() | ~value.rlike(ID_PATTERN)


def _bad_url(value: Column) -> Column:
    return value.isNotNull() & ~value.rlike(r"(?i)^https?://[^/?#\s]+")


def _broken(frame: DataFrame, scope: str, key: Column, rules: list[Column]) -> DataFrame:
    return frame.select(
        F.lit(scope).alias("scope"), key.alias("id"), F.explode(F.array_compact(F.array(*rules))).alias("rule")
    )


def registry_violations(agencies: DataFrame) -> DataFrame:
    """Broken rules as (scope, id, rule); a valid registry gives no rows."""
    n_feeds = F.coalesce(F.size("feeds"), F.lit(0))
    n_systems = F.coalesce(F.size("systems"), F.lit(0))
    at_agency = _broken(
        agencies, "agency", F.col("id"),
        [
            _rule("id_pattern", _bad_id(F.col("id"))),
            _rule("name_missing", F.col("name").isNull()),
            _rule("feeds_and_systems", (n_feeds > 0) & (n_systems > 0)),
            _rule("no_feeds_or_systems", (n_feeds == 0) & (n_systems == 0)),
            _rule("schedule_url", _bad_url(F.col("schedule_url"))),
            *_auth_rules(F.col("auth")),
        ],
    )
    systems = agencies.select(F.col("id").alias("agency_id"), F.explode("systems").alias("system"))
    at_system = _broken(
        systems, "system", F.concat_ws("/", F.col("agency_id"), F.col("system.id")),
        [
            _rule("id_pattern", _bad_id(F.col("system.id"))),
            _rule("name_missing", F.col("system.name").isNull()),
            _rule("no_feeds", F.coalesce(F.size("system.feeds"), F.lit(0)) == 0),
            _rule("schedule_url", _bad_url(F.col("system.schedule_url"))),
            *_auth_rules(F.col("system.auth")),
        ],
    )
    own = agencies.select(F.col("id").alias("owner"), F.explode("feeds").alias("feed"))
    inner = systems.select(
        F.concat_ws("/", "agency_id", "system.id").alias("owner"), F.explode("system.feeds").alias("feed")
    )
    feed = F.col("feed")
    at_feed = _broken(
        own.unionByName(inner), "feed", F.concat_ws("/", F.col("owner"), feed["feed_type"]),
        [
            _rule("feed_type", ~F.coalesce(feed["feed_type"].isin(*FEED_TYPES), F.lit(False))),
            _rule("url", feed["url"].isNull() | _bad_url(feed["url"])),
            _rule("interval_range", _outside(feed["interval_seconds"], INTERVAL_RANGE)),
            _rule("timeout_range", _outside(feed["timeout_seconds"], TIMEOUT_RANGE)),
            _rule("attempts_range", _outside(feed["retry"]["max_attempts"], ATTEMPTS_RANGE)),
            _rule("backoff_base_range", _outside(feed["retry"]["backoff_base"], BACKOFF_BASE_RANGE)),
            _rule("backoff_max_range", _outside(feed["retry"]["backoff_max"], BACKOFF_MAX_RANGE)),
            *_auth_rules(feed["auth"]),
        ],
    )
    return at_agency.unionByName(at_system).unionByName(at_feed)


def default_violations(defaults: dict[str, Any]) -> list[str]:
    """Broken ranges in the global defaults."""
    checks = [(f"interval_{name}", value, INTERVAL_RANGE) for name, value in defaults["intervals"].items()]
    checks += [
        ("timeout_range", defaults["timeout_seconds"], TIMEOUT_RANGE),
        ("attempts_range", defaults["retry"]["max_attempts"], ATTEMPTS_RANGE),
        ("backoff_base_range", defaults["retry"]["backoff_base"], BACKOFF_BASE_RANGE),
        ("backoff_max_range", defaults["retry"]["backoff_max"], BACKOFF_MAX_RANGE),
    ]
    return [name for name, value, (low, high) in checks if not low <= value <= high]


def schedule_urls(feeds: DataFrame) -> DataFrame:
    """Distinct schedule URLs, each with the auth of the first feed that names it, sorted.

    Feeds without auth count as naming it too: the first feed decides, also when it has none.
    """
    named = feeds.select(
        F.explode("schedule_urls").alias("schedule_url"),
        F.struct("agency_pos", "system_pos", "feed_pos").alias("seen"),
        F.struct("feed_id", "auth").alias("by"),
    )
    first = named.groupBy("schedule_url").agg(F.min_by("by", "seen").alias("by"))
    return first.select("schedule_url", "by.feed_id", "by.auth").orderBy("schedule_url")
