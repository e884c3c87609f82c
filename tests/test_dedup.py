"""First-seen and ledger rules; NULL ids; hot ids."""

import pytest
from pyspark.sql import functions as F

from feedstream.operators import dedup

SCHEMA = "ord bigint, id string, title string"
ROWS = [(0, "a", "t0"), (1, None, "t1"), (2, "a", "t2"), (3, None, "t1"), (4, "b", "t4")]


@pytest.fixture
def articles(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(4)


def ords(df):
    return sorted(r.ord for r in df.select("ord").collect())


def test_first_seen(articles):
    assert ords(dedup.first_seen(articles, ["ord"])) == [0, 1, 3, 4]
    assert dedup.first_seen(articles, ["ord"]).columns == ["ord", "id", "title"]


def test_first_seen_by_feed_then_entry(spark):
    df = spark.createDataFrame([(1, 0, "a"), (0, 9, "a"), (0, 3, "a")], "feed int, entry int, id string")
    assert [tuple(r) for r in dedup.first_seen(df, ["feed", "entry"]).collect()] == [(0, 3, "a")]


def test_ledger(spark, articles):
    ledger = spark.createDataFrame([("b",), ("z",), (None,)], "id string")
    assert ords(dedup.unseen(articles, ledger.where("id is not null"))) == [0, 1, 2, 3]
    assert ords(dedup.first_unseen(articles, ledger, ["ord"])) == [0, 1, 3]


def test_twice_is_once(articles):
    once = dedup.first_seen(articles, ["ord"])
    assert ords(dedup.first_seen(once, ["ord"])) == ords(once)


def test_records_without_an_id_stay_even_if_equal(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (1, "a", "x"), (1, "a", "x")], SCHEMA)
    assert dedup.first_seen(df, ["ord"]).count() == 3


def test_hot_id_leaves_each_task_once(spark):
    """A third of all rows share an id: the exchange carries one of them per map task."""
    n, tasks = 30_000, 6
    df = spark.range(0, n, 1, tasks).select(
        F.col("id").alias("ord"),
        F.when(F.col("id") < n // 3, "hot").otherwise(F.col("id").cast("string")).alias("id"),
    )
    first = dedup.first_seen(df, ["ord"])
    assert first.count() == n - n // 3 + 1
    assert first.where("id = 'hot'").first().ord == 0
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_first_unseen_shuffles_articles_once(spark, articles):
    ledger = spark.createDataFrame([("b",)], "id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = dedup.first_unseen(articles.select("*"), ledger, ["ord"])
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # articles once, ledger once; the join adds no exchange of its own
    assert text.count("Exchange hashpartitioning") == 2
