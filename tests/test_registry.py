from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from transitlake.operators.registry import (
    default_violations,
    feeds_dimension,
    flatten_registry,
    http_url,
    registry_violations,
    schedule_urls,
)
from transitlake.operators.telemetry import active_feeds
from transitlake.session import settings
from transitlake.sinks.compacted import write_feeds
from transitlake.sinks.registry import write_registry
from transitlake.sources.registry import agencies_frame, defaults_of, known_feeds, read_registry, read_registry_lines
from transitlake.sources.tables import read_feeds

HARBOUR = "https://harbour.example.com"
# Two invented operators: a harbour line without systems and a valley with a tram and a lift.
DOCUMENT = {
    "defaults": {
        "timeout_seconds": 33,
        "retry": {"max_attempts": 4, "backoff_base": 1.5, "backoff_max": 12},
        "intervals": {"vehicle_positions": 25, "trip_updates": 40, "service_alerts": 75},
    },
    "agencies": [
        {
            "id": "harbour", "name": "Harbour Line",
            "feeds": [
                {"feed_type": "trip_updates", "url": "http://Live.Harbour.example:80", "interval_seconds": 15,
                 "retry": {"max_attempts": 2}},
            ],
        },
        {
            "id": "valley", "name": "Valley", "schedule_url": f"{HARBOUR}/valley.zip",
            "auth": {"type": "header", "secret_name": "of-agency", "key": "token"},
            "systems": [
                {"id": "lift", "name": "Cliff Lift",
                 "feeds": [{"feed_type": "service_alerts", "url": f"{HARBOUR}/lift/alerts", "name": "Lift notices"}]},
                {"id": "tram", "name": "Tram", "schedule_url": f"{HARBOUR}/tram.zip",
                 "schedule_urls": [f"{HARBOUR}/night.zip"],
                 "auth": {"type": "query", "secret_name": "of-system", "key": "token"},
                 "feeds": [
                     {"feed_type": "vehicle_positions", "url": f"{HARBOUR}/tram/where", "timeout_seconds": 9,
                      "auth": {"type": "query", "secret_name": "of-feed", "key": "token"}},
                     {"feed_type": "service_alerts", "url": f"{HARBOUR}/tram/alerts"},
                 ]},
            ],
        },
    ],
}


@pytest.fixture(scope="module")
def feeds(spark):
    flat = flatten_registry(agencies_frame(spark, DOCUMENT), defaults_of(DOCUMENT))
    return {row.feed_id: row for row in flat.collect()}


def test_ids_names_and_order(feeds):
    assert list(feeds) == [
        "harbour-trip-updates", "valley-lift-service-alerts", "valley-tram-vehicle-positions", "valley-tram-service-alerts"
    ]
    assert [f.feed_name for f in feeds.values()] == [
        "Harbour Line Trip Updates", "Lift notices", "Valley Tram Vehicle Positions", "Valley Tram Service Alerts"
    ]


def test_inheritance(feeds):
    ferry, lift, where, alerts = feeds.values()
    assert [f.interval_seconds for f in feeds.values()] == [15, 75, 25, 75]
    assert [f.timeout_seconds for f in feeds.values()] == [33, 33, 9, 33]
    assert [f.auth and f.auth.secret_name for f in feeds.values()] == [None, "of-agency", "of-feed", "of-system"]
    # A retry of its own replaces the default as a whole.
    assert tuple(where.retry) == (4, 1.5, 12.0) and ferry.retry.max_attempts == 2 and ferry.retry.backoff_base == 1.0
    assert where.schedule_urls == alerts.schedule_urls == [f"{HARBOUR}/tram.zip", f"{HARBOUR}/night.zip"]
    assert lift.schedule_urls == [f"{HARBOUR}/valley.zip"] and ferry.schedule_urls == []
    assert (where.schedule_url, ferry.schedule_url) == (f"{HARBOUR}/tram.zip", None)
    assert ferry.url == "http://live.harbour.example/" and ferry.system_id is None


def test_normal_urls(spark):
    cases = {
        "https://Example.com": "https://example.com/", "HTTPS://example.com:443/A?b=C": "https://example.com/A?b=C",
        "http://example.com:8080?x": "http://example.com:8080/?x", "http://example.com:443/": "http://example.com:443/",
        "not a url": "not a url",
    }
    df = spark.createDataFrame([(u,) for u in cases], "u STRING")
    assert {r.u: r.n for r in df.select("u", http_url(F.col("u")).alias("n")).collect()} == cases


def test_dimension_and_lookup(spark, feeds, tmp_path):
    flat = flatten_registry(agencies_frame(spark, DOCUMENT), defaults_of(DOCUMENT))
    dimension = feeds_dimension(flat)
    assert len(dimension.columns) == 12
    write_feeds(dimension, str(tmp_path))
    rows = {r.feed_id: r for r in spark.read.parquet(f"{tmp_path}/feeds.parquet").collect()}
    urls = feeds["valley-tram-service-alerts"].schedule_urls
    assert rows["valley-tram-service-alerts"].schedule_urls == json.dumps(urls)
    assert rows["harbour-trip-updates"].schedule_urls is None
    order = [r.url for r in read_feeds(spark, str(tmp_path)).orderBy("load_order").collect()]
    assert order == [f.url for f in feeds.values()]
    assert known_feeds(dimension).where("feed_key = '~live.harbour.example/'").count() == 1


def test_unique_schedule_urls(spark):
    flat = flatten_registry(agencies_frame(spark, DOCUMENT), defaults_of(DOCUMENT))
    found = schedule_urls(flat).collect()
    assert [r.schedule_url.rsplit("/", 1)[1] for r in found] == ["night.zip", "tram.zip", "valley.zip"]
    assert [r.auth.secret_name for r in found] == ["of-feed", "of-feed", "of-agency"]
    assert tuple(active_feeds(flat).first()) == (4, 4)


def test_valid_registry_has_no_violations(spark):
    assert registry_violations(agencies_frame(spark, DOCUMENT)).count() == 0
    assert default_violations(defaults_of(DOCUMENT)) == []
    assert default_violations(defaults_of({"defaults": {"timeout_seconds": 0}})) == ["timeout_range"]


@pytest.mark.parametrize(
    ("change", "expected"),
    [
        ({"id": "Bad_Id"}, ("agency", "id_pattern")),
        ({"name": None}, ("agency", "name_missing")),
        ({"feeds": []}, ("agency", "no_feeds_or_systems")),
        ({"feeds": None}, ("agency", "no_feeds_or_systems")),
        ({"schedule_url": "ftp://x"}, ("agency", "schedule_url")),
        ({"auth": {"type": "cookie", "secret_name": "s", "key": "k"}}, ("agency", "auth_type")),
        ({"auth": {"type": "query", "secret_name": "s/x", "key": "k"}}, ("agency", "auth_secret_name")),
        ({"auth": {"type": "query", "secret_name": "s"}}, ("agency", "auth_key")),
        ({"feed": {"interval_seconds": 4}}, ("feed", "interval_range")),
        ({"feed": {"timeout_seconds": 121}}, ("feed", "timeout_range")),
        ({"feed": {"retry": {"max_attempts": 11}}}, ("feed", "attempts_range")),
        ({"feed": {"retry": {"backoff_base": 0.05}}}, ("feed", "backoff_base_range")),
        ({"feed": {"retry": {"backoff_max": 61}}}, ("feed", "backoff_max_range")),
        ({"feed": {"feed_type": "shapes"}}, ("feed", "feed_type")),
        ({"feed": {"url": "example.com"}}, ("feed", "url")),
        ({"systems": [{"id": "s", "name": "S", "feeds": []}]}, ("system", "no_feeds")),
    ],
)
def test_each_rule(spark, change, expected):
    feed = {"feed_type": "trip_updates", "url": "https://example.com/x", **change.pop("feed", {})}
    agency = {"id": "ok", "name": "Ok", "feeds": [feed], **change}
    if "systems" in agency:
        agency["feeds"] = None
    found = registry_violations(agencies_frame(spark, {"agencies": [agency]})).collect()
    assert [(r.scope, r.rule) for r in found] == [expected]


def test_yaml(spark, tmp_path):
    yaml = pytest.importorskip("yaml")
    path = tmp_path / "agencies.yaml"
    path.write_text(yaml.safe_dump(DOCUMENT))
    agencies, defaults = read_registry(spark, str(path))
    assert agencies.count() == 2 and defaults["intervals"]["service_alerts"] == 75
    assert flatten_registry(agencies, defaults).count() == 4


def test_a_document_of_lines_is_the_yaml_document(spark, tmp_path):
    """Written and read in tasks, over several part files; the files in name order are the document that YAML reads."""
    rows = agencies_frame(spark, DOCUMENT).repartition(2)
    path = tmp_path / "agencies.yaml"
    with settings(spark, spark__sql__adaptive__enabled="false"):
        write_registry(rows, str(path))
    parts = sorted(path.glob("part-*"))
    assert len(parts) > 1
    (tmp_path / "whole.yaml").write_text("".join(part.read_text() for part in parts))
    lines, whole = read_registry_lines(spark, str(path)), read_registry(spark, str(tmp_path / "whole.yaml"))[0]
    assert sorted(lines.collect()) == sorted(whole.collect()) == sorted(rows.select(*lines.columns).collect())


def test_a_registry_of_many_agencies_stays_out_of_the_driver(spark, tmp_path, monkeypatch):
    """The query neither loads the document on the driver nor collects it into one row."""
    from transitlake.sources import registry
    from transitlake.workloads.registry import registry_document

    def load(*_):
        raise AssertionError("the document is read by the driver")

    monkeypatch.setattr(registry, "load_yaml", load)
    assert registry_document(spark, "/root/testdata/sf0.001").count() > 0
