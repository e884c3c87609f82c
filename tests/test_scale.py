"""What must not grow with the input: tasks of a batch, batches, what one task reads or holds."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feedstream.operators import classify
from feedstream.sources.ledger import read_ledger
from feedstream.streaming import jobs, sinks
from workload import catalog, inputs


@pytest.fixture
def tables(spark, tmp_path):
    """Tables of 400 documents from two sources, in eight files, 60 items and 300 events."""
    spark.range(400).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("title "), "id", F.lit("\nthe text of it")).alias("text"),
        F.lit("en").alias("lang"), F.concat(F.lit("src"), F.col("id") % 2).alias("source"),
        F.lit(20).cast("long").alias("n_chars")).repartition(8).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(60).select(
        F.col("id").alias("conv_id"), F.lit(1).alias("turn"), F.lit("user").alias("role"),
        F.concat(F.lit("a long enough text "), "id").alias("text")).write.parquet(f"{tmp_path}/conversations.parquet")
    spark.range(300).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 30 + 10**9).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 9).alias("user_id"), F.element_at(F.array(*map(F.lit, ["click", "signup", "error"])), (
            F.col("id") % 3 + 1).cast("int")).alias("event_type"), F.lit(1.0).alias("value"),
        F.concat(F.lit('{"k": '), F.col("id") % 4, F.lit("}")).alias("props")).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def files(path, pattern="part-*"):
    return [f for f in Path(path).rglob(pattern) if f.stat().st_size]


def test_files_of_a_topic_grow_with_the_tables(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "PIECE_BYTES", 500)
    lines = inputs.text_topic(spark, tables, inputs.article_json(spark, tables), f"{tmp_path}/topic")
    written = files(tmp_path / "topic")
    assert len(written) > 8
    seen = []
    jobs.start(sinks.batch_sink(lines, lambda b, i: seen.append(b.count()), f"{tmp_path}/c"), available_now=True).awaitTermination()
    assert len(seen) == 4 and sum(seen) == 460


@pytest.mark.parametrize("name, rows", [("job_analysis", 460), ("job_isolation", 860)])
def test_jobs_over_many_files(spark, tables, monkeypatch, name, rows):
    monkeypatch.setattr(inputs, "PIECE_BYTES", 500)
    written = []
    plain = inputs.text_topic

    def topic(spark, sf_dir, lines, path, **more):
        found = plain(spark, sf_dir, lines, path, **more)
        written.extend(files(path))
        return found

    monkeypatch.setattr(inputs, "text_topic", topic)
    assert catalog.QUERIES[name](spark, tables).count() == rows
    assert len(written) > 8


def test_events_in_more_files_and_as_many_batches(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "RESULT_BYTES", 100)
    lines = inputs.result_topic(spark, tables, f"{tmp_path}/topic")
    assert len(files(tmp_path / "topic", "*.parquet")) > 6
    seen = []
    jobs.start(sinks.batch_sink(lines, lambda b, i: seen.append(b.count()), f"{tmp_path}/c"), available_now=True).awaitTermination()
    assert len(seen) == 3 and sum(seen) == 300


def test_feed_files_do_not_follow_the_partitions(spark, tables, tmp_path, monkeypatch):
    inputs.landed_feeds(spark, tables, f"{tmp_path}/few")
    assert [len(files(f"{tmp_path}/few/{form}")) for form in ("rss", "atom")] == [1, 1]
    monkeypatch.setattr(inputs, "FEED_RECORDS", 30)
    inputs.landed_feeds(spark, tables, f"{tmp_path}/cut")
    cut = files(f"{tmp_path}/cut/rss")
    assert len(cut) == 7 and sum(len(re.findall("<item>", f.read_text())) for f in cut) == 200


def test_a_kept_batch_has_no_file_per_shuffle_partition(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        rows = spark.range(500).select(F.col("id").cast("string").alias("id"), F.lit("s").alias("source"),
                                       F.lit("t").alias("title"), F.lit("l").alias("link"), "id", F.col("id").alias("n")).toDF(
            "id", "source", "title", "link", "copy", "n").drop("copy")
        rows.repartition(2).write.parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
        publish = sinks.batch_files(f"{tmp_path}/topic")
        writer = jobs.ingest(stream, ["n"], f"{tmp_path}/ledger", publish, f"{tmp_path}/c")
        jobs.start(writer, available_now=True).awaitTermination()
        assert len(files(tmp_path / "topic", "*.parquet")) < 10
        assert len(files(tmp_path / "ledger/segments", "*.parquet")) < 10
        assert spark.read.parquet(f"{tmp_path}/topic").count() == read_ledger(spark, f"{tmp_path}/ledger").count() == 500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_counters_hold_no_state(spark, tmp_path):
    view = spark.createDataFrame(
        [("a", "x", None), ("a", "x", None), ("b", None, "c")], "source string, sentiment string, category string")
    out = f"{tmp_path}/table"
    for turn in range(3):
        view.write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(view.schema).parquet(f"{tmp_path}/in")
        query = jobs.start(jobs.running_counters(stream, out, f"{tmp_path}/c"), available_now=True)
        query.awaitTermination()
        assert not query.lastProgress.stateOperators
        found = {tuple(r) for r in jobs.latest_version(spark, out).collect()}
        assert found == {("a", "x", None, 2 * turn + 2), ("b", None, "c", turn + 1)}


def test_models_get_texts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(classify, "TEXTS", 3)

    def factory():
        def score(texts):
            if len(texts) > 3:
                raise ValueError("too many at once")
            return [[0, 1, 0] if t == "b" else [1, 0, 0] for t in texts]

        return score

    label = classify.sentiment_udf(factory, labels=("x", "y", "z"), max_chars=1)
    table = spark.createDataFrame([(i, t) for i, t in enumerate(["bc", None, "a", "b", "", "b", "c"])], "id long, t string")
    found = table.coalesce(1).select("id", label(F.col("t")).alias("l")).orderBy("id").collect()
    assert "".join(r["l"] for r in found) == "yxxyxyx"
    assert table.where("id < 0").select(label(F.col("t"))).collect() == []
