"""Streams against tables, restarts, replays, several sinks."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedstream.operators import dedup, metrics
from feedstream.operators.parse import flag_corrupt
from feedstream.sources.ledger import create_ledger, mark_sent, read_ledger
from feedstream.streaming import jobs, sinks

START = datetime(2024, 5, 1)
VIEW = "timestamp timestamp, seq int, source string, sentiment string, category string"


def records(start, n):
    return [
        (START + timedelta(seconds=37 * i), i, f"s{i % 3}",
         ["positive", "neutral", "negative"][i % 3], f"c{i % 4}")
        for i in range(start, start + n)
    ]


class Topic:
    """A folder of files that a stream reads, one file per batch."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, f"{path}/in", schema

    def add(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.path)

    def table(self):
        return self.spark.read.schema(self.schema).parquet(self.path)


@pytest.fixture
def topic(spark, tmp_path):
    made = Topic(spark, tmp_path, VIEW)
    for start in (0, 20, 40):
        made.add(records(start, 20))
    return made


def test_counters_over_batches_and_restart(spark, topic, tmp_path, rows, drain):
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    for more in ([], records(60, 10)):
        if more:
            topic.add(more)
        drain(jobs.running_counters(topic.stream(), out, checkpoint))
        got = jobs.latest_version(spark, out)
        assert rows(got) == rows(metrics.counters(topic.table()))
    assert rows(metrics.kpi_totals(got)) == rows(metrics.kpi_totals(metrics.counters(topic.table())))


def test_timeline_complete_and_bounded(spark, topic, tmp_path, rows, drain):
    want = rows(metrics.timeline(topic.table()))
    drain(jobs.running_timeline(topic.stream(), f"{tmp_path}/a", f"{tmp_path}/ca"))
    assert rows(jobs.latest_version(spark, f"{tmp_path}/a")) == want
    topic.add([(START - timedelta(days=9), 99, "late", "positive", "c")])
    want = rows(metrics.timeline(topic.table()))
    drain(jobs.running_timeline_parts(topic.stream(), f"{tmp_path}/b", f"{tmp_path}/cb"))
    assert rows(jobs.merged_counts(spark, f"{tmp_path}/b", "minute", "sentiment")) == want


def test_recent_over_batches_and_restart(spark, topic, tmp_path, rows, drain):
    order, out, checkpoint = ["timestamp", "seq"], f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    drain(jobs.running_recent(topic.stream(), order, out, checkpoint, n=25))
    assert rows(jobs.latest_version(spark, out).drop(jobs.ROW)) == rows(metrics.recent(topic.table(), order, 25))
    topic.add(records(100, 3))
    drain(jobs.running_recent(topic.stream(), order, out, checkpoint, n=25))
    got = jobs.latest_version(spark, out).drop(jobs.ROW)
    assert rows(got) == rows(metrics.recent(topic.table(), order, 25))
    assert got.count() == 25


ARTICLE = "ord int, id string, source string, title string, link string"


def article(ord, id):
    return (ord, id, "rss", f"t{ord}", f"l{ord}")


def published(spark, path):
    return sorted((r.batch_id, r.ord) for r in spark.read.parquet(path).collect())


def test_ingest_remembers_over_batches_and_restart(spark, tmp_path, drain):
    topic = Topic(spark, tmp_path, ARTICLE)
    ledger, out, checkpoint = (f"{tmp_path}/{n}" for n in ("ledger", "out", "checkpoint"))

    def run():
        drain(jobs.ingest(topic.stream(), ["ord"], ledger, sinks.batch_files(out), checkpoint))

    topic.add([article(0, "a"), article(1, "a"), article(2, None), article(3, "b")])
    run()
    assert published(spark, out) == [(0, 0), (0, 2), (0, 3)]
    topic.add([article(4, "b"), article(5, None), article(6, "c")])
    run()
    assert published(spark, out) == [(0, 0), (0, 2), (0, 3), (1, 5), (1, 6)]
    assert sorted(r.id for r in read_ledger(spark, ledger).collect()) == ["a", "b", "c"]


def test_ingest_by_state_remembers_over_restart(spark, tmp_path, drain):
    topic = Topic(spark, tmp_path, ARTICLE)
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    for batch in ([article(0, "a"), article(1, None), article(2, "b")],
                  [article(3, "b"), article(4, None), article(5, "c")]):
        topic.add(batch)
        drain(jobs.ingest_by_state(topic.stream(), sinks.batch_files(out), checkpoint))
    assert sorted(o for _, o in published(spark, out)) == [0, 1, 2, 4, 5]


def test_replayed_batch_publishes_the_same(spark, tmp_path):
    """A batch that failed after its ledger entry was written comes again with its number."""
    ledger = f"{tmp_path}/ledger"
    create_ledger(spark, ledger)
    batch = spark.createDataFrame([article(0, "a"), article(1, "b")], ARTICLE)
    for _ in range(2):
        seen = read_ledger(spark, ledger, before_batch=0)
        fresh = dedup.first_unseen(batch, seen, ["ord"])
        assert sorted(r.ord for r in fresh.collect()) == [0, 1]
        mark_sent(fresh, ledger, 0)
    assert read_ledger(spark, ledger).count() == 2
    later = dedup.first_unseen(batch, read_ledger(spark, ledger, before_batch=1), ["ord"])
    assert later.count() == 0


def test_state_dedup(spark, tmp_path, drain):
    topic = Topic(spark, tmp_path, "id string, at timestamp, n int")
    topic.add([("a", START, 0), ("b", START, 1), (None, START, 2), (None, START, 2)])
    topic.add([("a", START, 3), ("c", START, 4), (None, START, 5)])
    for name, watermark in (("plain", None), ("bounded", ("at", "1 hour"))):
        kept = dedup.drop_repeats(topic.stream(), watermark=watermark)
        drain(sinks.file_sink(kept, f"{tmp_path}/{name}", f"{tmp_path}/c-{name}"))
        got = spark.read.parquet(f"{tmp_path}/{name}")
        assert sorted(r.n for r in got.where("id is null").collect()) == [2, 2, 5]
        assert sorted(r.id for r in got.where("id is not null").collect()) == ["a", "b", "c"]


def test_two_sinks_from_one_reading(spark, topic, tmp_path, drain):
    counted = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def model(seq):
        counted.add(1)
        return seq

    analysed = topic.stream().withColumn("score", model("seq"))
    writes = [sinks.batch_files(f"{tmp_path}/a"), sinks.batch_json_lines(f"{tmp_path}/b"), sinks.batch_console()]
    drain(jobs.publish_results(analysed, writes, f"{tmp_path}/checkpoint"))
    assert spark.read.parquet(f"{tmp_path}/a").count() == 60
    assert spark.read.text(f"{tmp_path}/b").count() == 60
    assert counted.value == 60


def test_corrupt_records_go_to_their_own_place(spark, tmp_path, drain):
    topic = Topic(spark, tmp_path, "json string")
    topic.add([('{"id": "1"}',), ("broken {",), ('{"id": "2"}',)])
    flagged = flag_corrupt(topic.stream())

    def good(batch, batch_id):
        sinks.batch_files(f"{tmp_path}/good")(batch.where("not is_corrupt").drop("is_corrupt", "raw"), batch_id)

    def bad(batch, batch_id):
        sinks.batch_files(f"{tmp_path}/bad")(batch.where("is_corrupt").select("raw"), batch_id)

    drain(jobs.publish_results(flagged, [good, bad], f"{tmp_path}/checkpoint"))
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/good").collect()) == ["1", "2"]
    assert [r.raw for r in spark.read.parquet(f"{tmp_path}/bad").collect()] == ["broken {"]


def test_console_and_triggers(spark, topic, tmp_path):
    query = jobs.start(sinks.console_sink(topic.stream(), f"{tmp_path}/c"), "shown", available_now=True)
    query.awaitTermination()
    assert query.name == "shown"
    progress = [p for p in query.recentProgress if p.numInputRows]
    assert sum(p.numInputRows for p in progress) == 60
    assert "ConsoleTable" in progress[0].sink.description
    ticking = jobs.start(sinks.file_sink(topic.stream(), f"{tmp_path}/o", f"{tmp_path}/d"), every="1 second")
    try:
        ticking.processAllAvailable()
        assert spark.read.parquet(f"{tmp_path}/o").count() == 60
    finally:
        ticking.stop()


def test_empty_stream(spark, tmp_path, drain):
    topic = Topic(spark, tmp_path, VIEW)
    topic.add([])
    drain(jobs.running_recent(topic.stream(), ["timestamp"], f"{tmp_path}/o", f"{tmp_path}/c"))


def test_a_failed_query_is_noticed(spark, topic, tmp_path):
    def fail(batch, batch_id):
        raise RuntimeError("sink down")

    writer = jobs.publish_results(topic.stream(), [fail], f"{tmp_path}/c")
    spark.streams.resetTerminated()
    jobs.start(writer, available_now=True)
    with pytest.raises(Exception, match="sink down"):
        jobs.await_any(spark)
    spark.streams.resetTerminated()
