"""Landed feeds, id lists, items; Kafka options."""

import json

import pytest

from feedstream.operators.enrich import attach_feed, feed_registry, first_ids, lookup_items, parse_id_lists
from feedstream.plans import ingest
from feedstream.session import work_dir
from feedstream.sources import feeds, kafka
from feedstream.sources.files import read_records
from feedstream.streaming.sinks import file_sink

RSS = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0"><channel><title>Feed</title>
<item><title>A &amp; B</title><link>http://a</link><guid isPermaLink="false">g1</guid>
  <description>first <![CDATA[<b>text</b>]]></description><pubDate>Mon, 01 Jan 2024</pubDate></item>
<item><title>No guid</title><link>http://b</link></item>
</channel></rss>"""

ATOM = """<?xml version="1.0" encoding="UTF-8"?>
<feed xmlns="http://www.w3.org/2005/Atom"><title>Feed</title>
<entry><id>e1</id><title>One</title><link rel="self" href="http://self"/><link href="http://one"/>
  <summary>sum</summary><published>2024-01-01</published></entry>
<entry><id>e2</id><title>Two</title></entry>
</feed>"""

ITEMS = [
    {"id": 3, "title": "three", "url": "u3", "by": "b", "score": 1, "time": 9, "type": "story"},
    None,
    {"id": 1, "title": "one"},
    {"id": 7, "title": "not listed"},
]


@pytest.fixture
def landed(tmp_path):
    rss, atom, hn = tmp_path / "rss" / "feed_ord=4", tmp_path / "atom" / "feed_ord=1", tmp_path / "hn"
    for folder in (rss, atom, hn):
        folder.mkdir(parents=True)
    (rss / "feed.xml").write_text(RSS)
    (atom / "feed.xml").write_text(ATOM)
    (hn / "items.json").write_text("\n".join(map(json.dumps, ITEMS)))
    return tmp_path


def test_rss(spark, landed):
    got = feeds.rss_entries(spark, str(landed / "rss")).orderBy("title").collect()
    assert [(r.feed_ord, r.title, r.link, r.summary, r.published) for r in got] == [
        (4, "A & B", "http://a", "first <b>text</b>", "Mon, 01 Jan 2024"),
        (4, "No guid", "http://b", None, None),
    ]
    assert got[1].id is None


def test_rss_guid_with_an_attribute(spark, landed):
    first = feeds.rss_entries(spark, str(landed / "rss")).where("title = 'A & B'").first()
    assert first.id == "g1"


def test_atom(spark, landed):
    got = feeds.atom_entries(spark, str(landed / "atom")).orderBy("id").collect()
    assert [tuple(r) for r in got] == [
        (1, "e1", "One", "http://one", "sum", "2024-01-01"), (1, "e2", "Two", None, None, None),
    ]


def test_fields_that_stand_in(spark, tmp_path):
    for kind, text in (
        ("rss", "<rss><channel><item><title>a</title><content:encoded>full</content:encoded><dc:date>d1</dc:date></item>"
                "</channel></rss>"),
        ("atom", "<feed><entry><id>1</id><content>body</content><updated>d2</updated></entry></feed>"),
    ):
        folder = tmp_path / kind / "feed_ord=2"
        folder.mkdir(parents=True)
        (folder / "f.xml").write_text(text)
    [rss] = feeds.rss_entries(spark, str(tmp_path / "rss")).collect()
    [atom] = feeds.atom_entries(spark, str(tmp_path / "atom")).collect()
    assert (rss.summary, rss.published, atom.summary, atom.published) == ("full", "d1", "body", "d2")


def test_articles_of_both_forms_and_of_a_list(spark, landed):
    listed = first_ids(parse_id_lists(spark.createDataFrame([("[3, 2]",)], "json string")))
    got = ingest.articles(
        spark, str(landed / "rss"), str(landed / "hn"), atom_path=str(landed / "atom"), item_ids=listed)
    assert sorted((r.source, r.id) for r in got.collect()) == [
        ("hn", "3"), ("rss", "e1"), ("rss", "e2"), ("rss", "g1"), ("rss", "http://b")]


def test_feed_category_from_the_folder(spark, landed):
    entries = feeds.rss_entries(spark, str(landed / "rss"))
    got = attach_feed(entries, feed_registry(spark), "feed_ord").select("feed_category", "feed_url").distinct().collect()
    assert [r.feed_category for r in got] == ["Technologie"]


def test_registry(spark):
    registry = feed_registry(spark)
    assert {r.feed_category: r["count"] for r in registry.groupBy("feed_category").count().collect()} == {
        "Actualité": 4, "Technologie": 4, "Finance": 2, "Science": 2, "Startups": 2,
    }
    plan = registry.join(registry.select("feed_ord"), "feed_ord")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_items_and_lists(spark, landed):
    items = feeds.hn_items(spark, str(landed / "hn"))
    lists = spark.createDataFrame([("[3, 2, 1]",)], "json string")
    ids = first_ids(parse_id_lists(lists))
    got = lookup_items(ids, items).orderBy("pos").collect()
    assert [(r.pos, r.id, r.title) for r in got] == [(0, 3, "three"), (2, 1, "one")]


def test_first_ids_keeps_list_order(spark):
    lists = spark.createDataFrame([(list(range(300, 0, -1)),), ([5],)], "ids array<bigint>")
    ids = first_ids(lists)
    assert ids.count() == 201
    assert sorted(r.id for r in ids.where("pos < 2").collect()) == [5, 299, 300]


def test_articles_as_table_and_stream(spark, landed, rows, drain):
    keep = ["source", "id", "title", "by", "category"]
    paths = str(landed / "rss"), str(landed / "hn")
    table = ingest.articles(spark, *paths).select(keep)
    assert rows(table) == sorted([
        ("rss", "g1", "A & B", None, "Technologie"),
        ("rss", "http://b", "No guid", None, "Technologie"),
        ("hn", "3", "three", "b", "HN"), ("hn", "1", "one", "", "HN"),
        ("hn", "7", "not listed", "", "HN"),
    ], key=repr)
    stream = ingest.articles(spark, *paths, streaming=True).select(keep)
    drain(file_sink(stream, f"{landed}/out", f"{landed}/checkpoint"))
    assert rows(spark.read.schema(stream.schema).parquet(f"{landed}/out")) == rows(table)


def test_stream_needs_a_schema(spark, tmp_path):
    with pytest.raises(ValueError):
        read_records(spark, str(tmp_path), "json", streaming=True)


def test_kafka_options():
    source = kafka.source_options("b:9092", "t", max_per_trigger=100, min_partitions=64)
    assert source == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "t", "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "100", "minPartitions": "64",
    }
    assert kafka.publish_options("b:9092", "t") == {
        "kafka.bootstrap.servers": "b:9092", "topic": "t", "kafka.linger.ms": "500",
    }


def test_work_dir_is_under_the_named_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    made = work_dir(spark, "x")
    assert made != work_dir(spark, "x")
    if base:
        assert made.startswith(base)

