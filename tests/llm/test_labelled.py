"""Texts of labelled rows for op8_quality's selection of features."""

from pyspark.sql import functions as F

from feedstream.llm import quality


def test_few_unlabelled_texts_reach_the_join(spark):
    texts = spark.range(4000).select(F.col("id").cast("string").alias("doc_id"), F.lit("a text").alias("text"))
    texts = texts.union(texts.where("doc_id < 20")).union(spark.createDataFrame([(None, "x")], "doc_id string, text string"))
    named = texts.where("doc_id % 10 = 0").select("doc_id", F.lit(1).alias("good")).distinct()
    assert 402 <= quality.likely(texts, named).count() < 450
    found = quality.labelled_texts(texts, named)
    assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 402 and found.where("cast(doc_id as int) % 10 != 0").count() == 0
    assert quality.labelled_texts(texts, named.where("good = 0")).count() == 0
