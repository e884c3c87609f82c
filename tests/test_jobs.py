"""The jobs from landed files to the tables of the view."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from feedstream.__main__ import arguments
from feedstream.operators import metrics
from feedstream.operators.enrich import enrich_hn
from feedstream.operators.parse import parse_results
from feedstream.plans import jobs
from feedstream.plans.ingest import ARRIVAL
from feedstream.schemas import HN_ITEM_SCHEMA, RESULT_COLUMNS
from feedstream.sources import kafka
from feedstream.sources.feeds import hn_items
from feedstream.sources.files import arrival, read_records
from feedstream.sources.ledger import read_ledger
from feedstream.streaming import sinks
from feedstream.streaming.jobs import start

TITLES = ["A good day for software", "malware and phishing news", "short", "good stock market deal",
          "bad covid virus spreads", "", "good health for all people"]


@pytest.fixture
def landed(tmp_path):
    folder = tmp_path / "items"
    folder.mkdir()
    items = [{"id": i, "title": t, "by": "me"} for i, t in enumerate(TITLES)]
    (folder / "items.json").write_text("\n".join(map(json.dumps, [*items, items[0], None])))
    return folder


def lines(spark, path):
    read = read_records(spark, path, "text", "json string", streaming=True)
    return read.select("json", placed())


def placed():
    return arrival().alias(ARRIVAL)


def finish(queries):
    for query in queries if isinstance(queries, list) else [queries]:
        query.awaitTermination()


def test_from_items_to_the_view(spark, landed, tmp_path):
    at = lambda name: f"{tmp_path}/{name}"
    once = {"every": None, "available_now": True}
    articles = enrich_hn(hn_items(spark, str(landed), streaming=True, keep=[placed()]), keep=[ARRIVAL])
    finish(jobs.start_ingest(
        articles, at("ledger"), sinks.batch_json_lines(at("topic")), at("c1"), **once
    ))
    assert spark.read.text(at("topic")).count() == len(TITLES)

    finish(jobs.start_analysis(lines(spark, at("topic")), sinks.batch_json_lines(at("results")), at("c2"), **once))
    results = parse_results(read_records(spark, at("results"), "text", "json string"))
    assert results.columns == RESULT_COLUMNS
    got = {r.id: (r.sentiment, r.predicted_category) for r in results.collect()}
    assert got == {
        "0": ("positive", "Technology"), "1": ("neutral", "Cybersecurity"),
        "3": ("positive", "Finance & Crypto"), "4": ("negative", "Health & Medicine"),
        "6": ("positive", "Health & Medicine"),
    }

    finish(jobs.start_view(lines(spark, at("results")), at("view"), at("c3"), **once))
    view = jobs.read_view(spark, at("view"))
    totals = view["totals"].first()
    assert (totals.total, totals.positive, totals.sources, totals.categories) == (5, 3, 1, 4)
    assert totals.positive_rate == 60.0
    assert [tuple(r) for r in view["by_source"].collect()] == [("hn", 5)]
    assert [r.n for r in view["top_categories"].collect()] == [1, 1, 1, 2]
    assert sum(r.n for r in view["timeline"].collect()) == 5
    assert view["recent"].columns == ["time", "source", "title", "sentiment", "category"]
    assert view["recent"].count() == 5
    assert {r.sentiment: round(r.share, 6) for r in view["by_sentiment"].collect()} == {
        "positive": 0.6, "neutral": 0.2, "negative": 0.2,
    }


def test_older_job_and_quarantine(spark, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    (topic / "a.json").write_text('{"id": "1", "text_combined": "tennis"}\nnot json\n')
    query = jobs.start_older_analysis(lines(spark, str(topic)), f"{tmp_path}/c", available_now=True)
    finish(query)
    assert query.name == "older_analysis"
    assert sum(p.numInputRows for p in query.recentProgress) == 2
    finish(jobs.start_quarantine(
        lines(spark, str(topic)), sinks.batch_files(f"{tmp_path}/bad"), f"{tmp_path}/d",
        every=None, available_now=True,
    ))
    assert [r.raw for r in spark.read.parquet(f"{tmp_path}/bad").collect()] == ["not json"]


def test_arrival_time(spark):
    df = spark.createDataFrame([("{}",)], "json string")
    shown = metrics.result_view(parse_results(df), F.current_timestamp())
    assert shown.first().timestamp is not None


def test_arguments():
    args = arguments(["analyze", "--servers", "b:1", "--folder", "/f"])
    assert (args.input_topic, args.results_topic, args.max_per_trigger) == (
        "rss_hn_feed", "analyzed_results", None,
    )


def test_kafka_is_asked_for(spark, tmp_path):
    """Without the connector Spark names it as missing; with it no broker is reached here."""
    try:
        kafka.read_topic(spark, "localhost:1", "t")
    except AnalysisException as error:
        assert "kafka" in str(error)
    else:
        pytest.skip("the connector is installed")
    items = spark.createDataFrame([], HN_ITEM_SCHEMA)
    items.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(HN_ITEM_SCHEMA).parquet(f"{tmp_path}/in")
    writer = sinks.kafka_sink(stream, kafka.sink_options("localhost:1", "t"), f"{tmp_path}/c")
    with pytest.raises(AnalysisException, match="kafka"):
        start(writer)


def test_recent_follows_arrival(spark, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    (topic / "a.json").write_text("".join(f'{{"id": "m{i}", "title": "m{i}"}}\n' for i in range(600)))
    finish(jobs.start_view(lines(spark, str(topic)), f"{tmp_path}/v", f"{tmp_path}/c", every=None, available_now=True))
    shown = jobs.read_view(spark, f"{tmp_path}/v")["recent"]
    assert [r.title for r in shown.collect()] == [f"m{i}" for i in range(585, 600)]
    with pytest.raises(ValueError):
        jobs.read_view(spark, f"{tmp_path}/v", shown=501)


def test_ledger_outlives_a_checkpoint(spark, tmp_path):
    folder = tmp_path / "items"
    folder.mkdir()
    at = lambda name: f"{tmp_path}/{name}"
    for run, ids in enumerate(([1, 2], [1, 3], [1, 2, 3])):
        for old in folder.iterdir():
            old.write_text("")
        (folder / f"{run}.json").write_text("".join(f'{{"id": {i}, "title": "t"}}\n' for i in ids))
        articles = enrich_hn(hn_items(spark, str(folder), streaming=True, keep=[placed()]), keep=[ARRIVAL])
        finish(jobs.start_ingest(
            articles, at("ledger"), sinks.batch_json_lines(at("topic")), at(f"c{run}"), every=None, available_now=True))
    assert sorted(json.loads(r.value)["id"] for r in spark.read.text(at("topic")).collect()) == ["1", "2", "3"]
    assert sorted(r.id for r in read_ledger(spark, at("ledger")).collect()) == ["1", "2", "3"]
