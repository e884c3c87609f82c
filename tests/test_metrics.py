"""Counters, top lists, timelines, alerts."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedstream.operators import alerts, metrics

START = datetime(2024, 5, 1, 12, 0, 0)
VIEW = "timestamp timestamp, seq int, source string, title string, sentiment string, category string, by string, word_count int"


def view(spark, rows):
    data = [
        (START + timedelta(seconds=s), i, source, f"t{i}", sentiment, category, "me", 1)
        for i, (s, source, sentiment, category) in enumerate(rows)
    ]
    return spark.createDataFrame(data, VIEW)


@pytest.fixture
def shown(spark):
    return view(spark, [
        (0, "rss", "positive", "A"), (10, "rss", "neutral", "B"), (59, "hn", "positive", "B"),
        (60, "hn", "negative", "C"), (61, "rss", "negative", "C"), (200, "rss", "negative", "D"),
        (200, "x", "neutral", "E"), (200, "x", "neutral", "F"),
    ])


def test_kpi(shown):
    row = metrics.kpi_totals(metrics.counters(shown)).first()
    assert (row.total, row.positive, row.sources, row.categories) == (8, 2, 3, 6)
    assert (row.positive_rate, row.positive_rate_shown) == (25.0, 25.0)


def test_kpi_of_nothing(shown):
    row = metrics.kpi_totals(metrics.counters(shown.where("seq > 99"))).first()
    assert tuple(row) == (0, 0, 0, 0, 0.0, 0.0)


def test_counts_and_shares(shown, rows):
    counts = metrics.counters(shown)
    assert rows(metrics.roll_up(counts, "source")) == [("hn", 2), ("rss", 4), ("x", 2)]
    assert rows(metrics.count_by(shown, "source")) == [("hn", 2), ("rss", 4), ("x", 2)]
    shares = {r.sentiment: r.share for r in metrics.share(counts, "sentiment").collect()}
    assert shares == {"positive": 2 / 8, "neutral": 3 / 8, "negative": 3 / 8}


def test_top_is_shown_ascending_and_ties_go_by_name(shown):
    got = [tuple(r) for r in metrics.top(metrics.counters(shown)).collect()]
    assert got == [("E", 1), ("D", 1), ("A", 1), ("C", 2), ("B", 2)]


def test_recent(shown):
    last = metrics.recent(shown, ["timestamp", "seq"], 3)
    assert [r.seq for r in last.collect()] == [7, 6, 5]
    assert metrics.recent(shown, ["timestamp", "seq"], 99).count() == 8


def test_recent_shown_is_oldest_first(shown):
    got = [tuple(r) for r in metrics.recent_shown(shown, ["timestamp", "seq"], 2).collect()]
    assert got == [
        ("12:03:20", "x", "t6", "neutral", "E"), ("12:03:20", "x", "t7", "neutral", "F"),
    ]


def test_timeline(shown, rows):
    minute = lambda m: START + timedelta(minutes=m)
    assert sorted(tuple(r) for r in metrics.timeline(shown).collect()) == [
        (minute(0), "neutral", 1), (minute(0), "positive", 2), (minute(1), "negative", 2),
        (minute(3), "negative", 1), (minute(3), "neutral", 2),
    ]
    got = [tuple(r) for r in metrics.timeline_last(shown, ["timestamp", "seq"], 4).collect()]
    assert got == [
        (minute(1), "negative", 1), (minute(3), "negative", 1), (minute(3), "neutral", 2),
    ]


def days(spark, counts, key="k"):
    data = [(key, START + timedelta(days=i), n) for i, n in enumerate(counts)]
    return spark.createDataFrame(data, "key string, win timestamp, n bigint")


def test_anomaly_needs_a_full_history(spark):
    quiet = days(spark, [10, 11, 10, 11, 10, 11, 10, 50, 10])
    assert [r.n for r in alerts.anomalies(quiet).collect()] == [50]
    early = days(spark, [10, 11, 50])
    assert alerts.anomalies(early).collect() == []
    flat = days(spark, [10] * 7 + [50])
    assert alerts.anomalies(flat).collect() == []
    assert alerts.anomalies(quiet.where(F.col("win") != START + timedelta(days=3))).collect() == []


def test_threshold_alerts(spark):
    rules = [
        ("count", ">", 20.0, "high"), ("count", ">", 30.0, "higher"), ("count", "<", 5.0, "low"),
        ("other", ">", 0.0, "never"),
    ]
    got = alerts.threshold_alerts(days(spark, [4, 5, 20, 21, 31]), rules)
    assert sorted((r.n, r.level) for r in got.collect()) == [
        (4, "low"), (21, "high"), (31, "high"), (31, "higher"),
    ]
    with pytest.raises(ValueError, match=">="):
        alerts.threshold_alerts(days(spark, [4]), [("count", ">=", 1.0, "x")])


def test_pattern_alerts(spark):
    both = days(spark, [9, 9, 9, 9, 1, 9, 9]).union(days(spark, [1, 9, 9, 1, 9], "j"))
    got = alerts.pattern_alerts(both, threshold=5, run=3).collect()
    assert sorted((r.key, (r.win - START).days) for r in got) == [("k", 2), ("k", 3)]
    gaps = days(spark, [9] * 20).where(F.dayofmonth("win").isin(1, 2, 20))
    assert alerts.pattern_alerts(gaps, threshold=5, run=3).collect() == []


def test_time_series_by_date(spark, tmp_path, shown):
    series = alerts.time_series(shown, "timestamp", ["source"], ["seq", "word_count"])
    assert series.count() == 16
    for _ in range(2):
        alerts.write_time_series(series, f"{tmp_path}/s", "a")
    later = shown.withColumn("timestamp", F.expr("timestamp + interval 1 day"))
    alerts.write_time_series(
        alerts.time_series(later, "timestamp", ["source"], ["seq"]), f"{tmp_path}/s", "b"
    )
    stored = spark.read.parquet(f"{tmp_path}/s")
    one_day = stored.where("date = date'2024-05-02'")
    assert one_day.count() == 8
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
