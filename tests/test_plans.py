"""What the plans must look like: pruned scans, one parse, partial sums, no cross joins."""

import re

import pytest
from pyspark.sql import functions as F

from feedstream.operators import metrics, parse
from feedstream.operators.clean import clean
from feedstream.plans.analysis import MAIN, WHOLE_TEXT, analyze
from workload import catalog, inputs

QUERIES = catalog.QUERIES
BATCH = sorted(n for n in QUERIES if not n.startswith(("stream_", "job_")) and n != "results_scan")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_json_is_parsed_once(spark, sf_dir):
    parsed = parse.parse_articles(inputs.article_json(spark, sf_dir))
    text = plan(clean(parsed, 10).select("id", "word_count"))
    assert text.count("from_json(") == 1


def test_unused_columns_stop_before_the_python_model(spark, sf_dir):
    from dataclasses import replace

    from feedstream.operators.classify import sentiment_udf
    from workload.catalog import word_list_scorer

    articles = spark.read.schema(
        "source string, id string, title string, link string, by string, score string, "
        "time string, type string, text_combined string, category string"
    ).parquet(sf_dir + "/documents.parquet")
    variant = replace(WHOLE_TEXT, sentiment=sentiment_udf(word_list_scorer()))
    text = plan(analyze(articles, variant))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "source", "id", "title", "link", "by", "text_combined",
    }
    # the length filter runs below the model
    assert text.index("ArrowEvalPython") < text.index("Filter (")


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["count_by_source"](spark, sf_dir))
    assert "ReadSchema: struct<event_type:string>" in text
    clicks = metrics.result_view(inputs.results(spark, sf_dir).where("source = 'click'"))
    text = plan(clicks.select("source", "word_count"))
    assert "EqualTo(event_type,click)" in text
    assert "ReadSchema: struct<event_type:string,props:string>" in text


@pytest.mark.parametrize("name, shuffles", [
    ("keyword_category", 0),
    ("sentiment_lexicon", 0),
    ("predicted_category", 0),
    ("argmax_label", 0),
    ("count_by_source", 1),
    ("kpi_totals", 2),
    ("dedup_first_seen", 1),
    ("recent_500", 0),
    ("timeline_minute", 1),
    ("anomaly_zscore", 2),
    ("timeseries_long", 0),
])
def test_number_of_shuffles(spark, sf_dir, name, shuffles):
    text = plan(QUERIES[name](spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == shuffles, text


def test_counts_are_summed_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["timeline_minute"](spark, sf_dir))
    assert "partial_count" in text
    assert "partial_sum" in plan(QUERIES["kpi_totals"](spark, sf_dir))


def test_recent_is_a_top_k(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["recent_500"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan(QUERIES["top5_categories"](spark, sf_dir))


def test_classifying_does_not_shuffle(spark):
    articles = spark.range(10).select(
        *[F.lit("x").alias(c) for c in ("source", "id", "title", "link", "by", "text_combined")]
    )
    assert "Exchange" not in plan(analyze(articles, MAIN))
