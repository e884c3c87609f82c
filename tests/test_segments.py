"""Tables in merging segments: counts, the ledger, replays and failures in the middle of a merge."""

import json
import os
import time

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from feedstream.operators import alerts
from feedstream.plans import ingest, jobs as wired
from feedstream.sources import ledger, segments
from feedstream.sources.files import read_records
from feedstream.streaming import jobs, sinks
from feedstream.streaming.sinks import BatchId


@pytest.fixture
def small_fan(monkeypatch):
    monkeypatch.setattr(segments, "FAN", 3)


@given(st.integers(0, 10**6))
def test_segments_cover_the_batches(n):
    spans = sorted((number * segments.FAN**level, (number + 1) * segments.FAN**level) for level, number in segments.covering(n))
    assert [a for a, _ in spans] == [0, *(b for _, b in spans)][:-1] if spans else n == 0
    assert not spans or spans[-1][1] == n
    assert len(spans) <= (segments.FAN - 1) * 8


def counts(spark, b):
    return spark.createDataFrame([("x", 1), (f"k{b % 4}", b)], "key string, n long")


def totals(df):
    return {r["key"]: r["n"] for r in df.groupBy("key").agg(F.sum("n").alias("n")).collect()}


def expected(batches):
    out = {}
    for b in batches:
        for key, n in (("x", 1), (f"k{b % 4}", b)):
            out[key] = out.get(key, 0) + n
    return out


def test_a_failure_in_a_merge_changes_no_sum(spark, tmp_path, small_fan, monkeypatch):
    path = f"{tmp_path}/counts"
    write = segments.write_plain
    for b in range(10):
        batch = BatchId(b, "r")
        if b in (2, 8):  # these complete a segment of level 1, or of 1 and 2: fail before and after it is written
            for fails in (1, 2):
                def broken(rows, to, level, at=fails):
                    if level == at:
                        write(rows, to, level)
                        raise OSError("lost")
                    write(rows, to, level)

                try:
                    segments.append(counts(spark, b), path, batch, lambda x: jobs.roll_up(x, "key"), write=broken)
                except OSError:
                    assert totals(segments.read_run(spark, path)) == expected(range(b))
        jobs.append_counts(counts(spark, b), path, batch, "key")
        assert totals(segments.read_run(spark, path)) == expected(range(b + 1))
        assert not b or totals(segments.read_run(spark, path, "r", b)) == expected(range(b))  # what a replay reads
    assert totals(jobs.merged_counts(spark, path, "key")) == expected(range(10))


def test_the_last_run_counts(spark, tmp_path):
    path = f"{tmp_path}/counts"
    for run, batches in (("old", 3), ("new", 2)):
        for b in range(batches):
            jobs.append_counts(counts(spark, b), path, BatchId(b, run), "key")
    assert totals(jobs.merged_counts(spark, path, "key")) == expected(range(2))
    assert totals(jobs.merged_counts(spark, path, "key", run="old", batches=3)) == expected(range(3))


def article(i):
    return (str(i), "rss", f"t{i}", f"l{i}")


def test_ledger_over_many_batches(spark, tmp_path, small_fan, monkeypatch):
    path = f"{tmp_path}/ledger"
    ledger.create_ledger(spark, path)
    schema = "id string, source string, title string, link string"
    for b in range(12):
        rows = spark.createDataFrame([article(10 * b + k) for k in range(10)] + [(None, "rss", "t", "l")], schema)
        for _ in range(2 if b in (2, 8) else 1):  # replays of batches that merge
            seen = ledger.read_ledger(spark, path, before_batch=BatchId(b, "r"), ids=rows.select("id"))
            assert seen.join(rows.select("id"), "id").count() == 0
            ledger.mark_sent(rows, path, BatchId(b, "r"))
    ids = lambda *x: spark.createDataFrame([(str(i),) for i in x], "id string")
    assert sorted(int(r.id) for r in ledger.read_ledger(spark, path).collect()) == list(range(120))
    few = ledger.read_ledger(spark, path, ids=ids(3, 77, 500))
    assert {r.id for r in few.where("id in ('3', '77', '500')").collect()} == {"3", "77"}
    assert few.count() < 60  # whole recent batches, and of the merged ones what the ids hash to
    monkeypatch.setattr(ledger, "PROBE", 1)
    by_bucket = ledger.read_ledger(spark, path, ids=ids(3, 77, 500))
    assert {r.id for r in by_bucket.where("id in ('3', '77')").collect()} == {"3", "77"}
    ledger.mark_sent(spark.createDataFrame([article(999)], schema), path, BatchId(0, "other"))
    assert ledger.read_ledger(spark, path).count() == 121
    assert ledger.read_ledger(spark, path, before_batch=BatchId(5, "r")).count() == 51


def windows(spark, *n):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    rows = [("a", k, v) for k, v in enumerate(n) if v is not None]
    return spark.createDataFrame(rows, "key string, k int, n long").select(
        "key", (start + F.make_interval(hours="k")).alias("win"), "n")


def test_a_window_exactly_at_the_limit_is_no_anomaly(spark):
    quiet = windows(spark, 2, 2, 4, 6, 6, 8)  # mean 4, squares 16, variance 4, so 8 lies at 2
    assert alerts.anomalies(quiet, 5, 2.0, "1 hour").collect() == []
    over = alerts.anomalies(windows(spark, 2, 2, 4, 6, 6, 9), 5, 2.0, "1 hour").first()
    assert (over.n, over.mean, over.spread, over.z) == (9, 4.0, 2.0, 2.5)
    assert alerts.anomalies(windows(spark, 2, 2, 4, 6, 6, 9), 5, 2.5, "1 hour").collect() == []
    big = [10**8 * x for x in (2, 2, 4, 6, 6, 8)]
    assert alerts.anomalies(windows(spark, *big), 5, 2.0, "1 hour").collect() == []
    assert alerts.anomalies(windows(spark, *big[:5], big[5] + 1), 5, 2.0, "1 hour").count() == 1


def results(spark, folder, name, hours):
    rows = [{"source": "a", "processing_time": f"2024-01-01T{h:02d}:00:00Z"} for h in hours]
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def alerted(spark, folder, path, checkpoint):
    lines = read_records(spark, str(folder), "text", "json string", streaming=True, maxFilesPerTrigger=1)
    wired.start_alerts(
        lines, path, checkpoint, [("count", ">", 3.0, "high")], run=3, threshold=1, width="1 hour", history=3,
        every=None, available_now=True).awaitTermination()
    return sorted((r.win.hour, r.n, r.alert) for r in wired.read_alerts(spark, path).collect())


def test_late_records_judge_later_windows_again(spark, tmp_path):
    topic, path, checkpoint = tmp_path / "topic", f"{tmp_path}/alerts", f"{tmp_path}/c"
    results(spark, topic, "1.json", [0, 0, 2, 2, 3, 3])
    assert alerted(spark, topic, path, checkpoint) == []
    results(spark, topic, "2.json", [1, 1])  # closes the gap: two runs become one
    assert alerted(spark, topic, path, checkpoint) == [(2, 2, "pattern"), (3, 2, "pattern")]
    results(spark, topic, "3.json", [1, 4, 4, 4, 4, 4])  # now hour 1 gives a spread to what follows
    got = alerted(spark, topic, path, checkpoint)
    assert got == [(2, 2, "pattern"), (3, 2, "pattern"), (4, 5, "anomaly"), (4, 5, "high"), (4, 5, "pattern")]
    assert alerted(spark, topic, path, f"{tmp_path}/again") == got  # a new checkpoint counts anew


def test_items_that_lists_name(spark, tmp_path):
    lists, items = tmp_path / "lists", tmp_path / "items"
    lists.mkdir(), items.mkdir()
    now = time.time()

    def put(folder, name, text, ago=0):
        (folder / name).write_text(text)
        os.utime(folder / name, (now - ago, now - ago))

    item = lambda i: json.dumps({"id": i, "title": f"t{i}"})
    put(lists, "a", json.dumps(list(range(1, 250))))
    put(lists, "b", json.dumps([7, 8, 300]) + "\nnot json\n[]\n[null]", 60)
    put(items, "a", "\n".join(item(i) for i in (1, 7, 8, 200, 201, 249, 999)))
    put(items, "b", item(300) + "\nnull\n\n" + item(8), 30)
    put(items, "late", item(2), 2 * 3600)
    articles = ingest.listed_articles(spark, str(lists), str(items), within="1 hour", maxFilesPerTrigger=1)
    wired.start_ingest(articles, f"{tmp_path}/ledger", sinks.batch_json_lines(f"{tmp_path}/topic"), f"{tmp_path}/c",
                       every=None, available_now=True).awaitTermination()
    sent = sorted(int(json.loads(r.value)["id"]) for r in spark.read.text(f"{tmp_path}/topic").collect())
    assert sent == [1, 7, 8, 200, 300]  # of the first 200 only, each once, not what landed two hours before
