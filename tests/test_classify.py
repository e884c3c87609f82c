"""Classifiers against brute force, ties, plug-ins and variants."""

import math
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from feedstream.functions.categories import category_vectors
from feedstream.functions.vectors import argmax_index, argmax_label, cosine
from feedstream.operators import classify
from feedstream.plans.analysis import MAIN, OLDER, analyze
from feedstream.reference_data import CATEGORIES_MAIN, CATEGORIES_OLDER, SENTIMENT_LABELS
from feedstream.schemas import ARTICLE_SCHEMA, RESULT_COLUMNS

DOCS = "n int, text string"


def classified(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    return classify.classify_words(df, **options).orderBy("n").collect()


def test_sentiment_signs(spark):
    got = classified(spark, ["good good bad", "bad", "good bad", "", None, "Great!"])
    assert [r.sentiment for r in got] == [
        "positive", "negative", "neutral", "neutral", "neutral", "positive",
    ]


def test_categories(spark):
    got = classified(spark, [
        "deep neural learning", "phishing and malware", "the stock price", "covid vaccine",
        "cloud api code", "quantum physics", "nothing here", None,
    ])
    names = list(CATEGORIES_MAIN)
    assert [r.predicted_category for r in got] == [*names, names[0], names[0]]


def test_unmatched_label(spark):
    got = classified(spark, ["nothing", "malware"], unmatched_label="none")
    assert [r.predicted_category for r in got] == ["none", "Cybersecurity"]


def test_equal_scores_go_to_the_first(spark):
    tie = {"b": ["x"], "a": ["y"]}
    got = classified(spark, ["x y", "y x", "y y x"], categories=tie)
    assert [r.predicted_category for r in got] == ["b", "b", "a"]


def test_categories_against_brute_force(spark):
    rng = random.Random(5)
    vectors = category_vectors(CATEGORIES_OLDER)
    vocabulary = sorted({w for v in vectors.values() for w in v})
    texts = [" ".join(rng.choices([*vocabulary, "other", "words"], k=rng.randint(0, 40))) for _ in range(200)]

    def best(text):
        counts = [text.split(" ").count(w) for w in vocabulary]
        size = math.sqrt(sum(c * c for c in counts))

        def score(v):
            if not size:
                return 0.0
            dot = sum(c * v.get(w, 0) for w, c in zip(vocabulary, counts))
            return round(dot / (size * math.hypot(*v.values())), 9)

        scores = {name: score(v) for name, v in vectors.items()}
        return max(scores, key=scores.get)

    got = classified(spark, texts, categories=CATEGORIES_OLDER, sentiment=False)
    assert [r.predicted_category for r in got] == [best(t) for t in texts]


def test_scaling_a_category_changes_nothing(spark):
    texts = ["ai stock", "stock stock ai", "price of ai", "virus"]
    scaled = {name: words * 3 for name, words in CATEGORIES_OLDER.items()}
    plain = classified(spark, texts, categories=CATEGORIES_OLDER)
    assert [r.predicted_category for r in plain] == [
        r.predicted_category for r in classified(spark, texts, categories=scaled)
    ]


def test_argmax(spark):
    df = spark.createDataFrame([([0.1, 0.9, 0.9],), ([2.0, 1.0, 0.0],), ([-1.0, -2.0, -0.5],)], "s array<double>")
    got = df.select(argmax_index(F.col("s")), argmax_label(F.col("s"), SENTIMENT_LABELS)).collect()
    assert [tuple(r) for r in got] == [(1, "neutral"), (0, "negative"), (2, "positive")]


def test_cosine(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(cosine(F.col("a"), F.col("b"))).collect()] == [0.96, None]


def test_cosine_in_batches(spark):
    rng = random.Random(1)
    pairs = [([rng.uniform(-1, 1) for _ in range(5)], [rng.uniform(-1, 1) for _ in range(5)]) for _ in range(50)]
    pairs += [([0.0] * 5, [1.0] * 5), (None, [1.0] * 5)]
    df = spark.createDataFrame(pairs, "a array<double>, b array<double>")
    a, b = F.col("a"), F.col("b")
    both = df.select(cosine(a, b), classify.cosine_udf()(a, b)).collect()
    assert [r[1] for r in both[:50]] == pytest.approx([r[0] for r in both[:50]])
    assert [tuple(r) for r in both[50:]] == [(None, None), (None, None)]


def test_nearest_category(spark):
    rng = random.Random(3)
    vectors = [[rng.uniform(-1, 1) for _ in range(4)] for _ in range(60)]
    centres = [[rng.uniform(-1, 1) for _ in range(4)] for _ in range(5)]
    centres.append(centres[0])  # an exact tie: the smaller ord wins

    def cos(a, b):
        return round(sum(x * y for x, y in zip(a, b)) / (math.hypot(*a) * math.hypot(*b)), 9)

    want = [max(range(6), key=lambda c: (cos(v, centres[c]), -c)) for v in vectors]
    df = spark.createDataFrame(list(enumerate(vectors)), "n int, embedding array<double>")
    categories = spark.createDataFrame(
        [(i, f"c{i}", v) for i, v in enumerate(centres)], "ord int, category string, vector array<double>"
    )
    got = classify.nearest_category(df, categories).orderBy("n").collect()
    assert [r.category for r in got] == [f"c{i}" for i in want]
    assert got[0].score == pytest.approx(cos(vectors[0], centres[want[0]]))
    plan = classify.nearest_category(df, categories)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_too_many_categories_raise(spark, monkeypatch):
    monkeypatch.setattr(classify, "MAX_CATEGORIES", 3)
    df = spark.createDataFrame([(0, [1.0])], "n int, embedding array<double>")
    few = spark.createDataFrame([(i, f"c{i}", [1.0]) for i in range(4)], "ord int, category string, vector array<double>")
    assert classify.nearest_category(df, few.where("ord < 3")).first().category == "c0"
    for wrong in (few, few.limit(0)):
        with pytest.raises(ValueError, match="categories"):
            classify.nearest_category(df, wrong)


def test_nearest_category_of_a_vector_without_length(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0]), (1, None), (2, [0.0, -1.0])], "n int, embedding array<double>")
    categories = spark.createDataFrame([(1, "b", [0.0, 1.0]), (0, "a", [1.0, 1.0])], "ord int, category string, vector array<double>")
    got = classify.nearest_category(df, categories).orderBy("n").collect()
    assert [(r.category, r.score) for r in got[:2]] == [("a", None), ("a", None)]
    assert (got[2].category, got[2].score) == ("a", pytest.approx(-math.sqrt(0.5)))


def test_centroids(spark):
    df = spark.createDataFrame([(1, [1.0, 5.0]), (1, [3.0, 7.0]), (2, [0.0, 1.0])], "label int, embedding array<float>")
    got = sorted(tuple(r) for r in classify.category_centroids(df).collect())
    assert got == [(1, [2.0, 6.0], 2), (2, [0.0, 1.0], 1)]


def test_sentiment_plug_in(spark):
    df = spark.createDataFrame([(0, None), (1, ""), (2, "abc"), (3, "abcdef")], DOCS)

    def factory():  # local, so that it travels with the function
        return lambda texts: [
            [1, 0, 0] if not t else [0, 1, 0] if len(t) < 5 else [0, 0, 1] for t in texts
        ]

    label = classify.sentiment_udf(factory)
    got = df.select("n", label(F.col("text")).alias("s")).orderBy("n").collect()
    assert [r.s for r in got] == ["negative", "negative", "neutral", "positive"]
    assert df.where("n > 9").select(label(F.col("text"))).collect() == []


def test_embedding_plug_in(spark):
    def embedder():
        def embed(texts):
            return [[t.count("a") + 0.0, t.count("b") + 0.0] for t in texts]

        return embed

    categories = {"As": ["aa", "a"], "Bs": ["b"]}
    labels = classify.embedded_labels(spark, embedder(), categories)
    df = spark.createDataFrame([(0, "aab"), (1, "bba"), (2, "ab")], DOCS)
    embedded = df.withColumn("embedding", classify.embedding_udf(embedder)(F.col("text")))
    got = classify.nearest_category(embedded, labels).orderBy("n").collect()
    assert [r.category for r in got] == ["As", "Bs", "As"]


def test_embedded_category_in_the_analysis(spark):
    def embedder():
        return lambda texts: [[t.count("a") + 0.0, t.count("b") + 0.0] for t in texts]

    category = classify.embedded_category(embedder, {"As": ["aa", "a"], "Bs": ["b"]}, max_chars=12)
    df = analyze(articles(spark, "aab aab aab aab bbbbbbbbbb", "bbbbbbbbbbb"), replace(MAIN, category=category))
    assert [r.predicted_category for r in df.orderBy("id").collect()] == ["As", "Bs"]


def articles(spark, *texts):
    rows = [("rss", str(i), "t", "l", None, "0", "0", None, t, "c", "0") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, ARTICLE_SCHEMA)


def test_main_variant(spark):
    df = analyze(articles(spark, "malware " * 100, "short", None), MAIN)
    assert df.columns == RESULT_COLUMNS
    assert [(r.id, r.predicted_category) for r in df.collect()] == [("0", "Cybersecurity")]


def test_older_variant(spark):
    rows = analyze(articles(spark, "nba soccer", "short", None), OLDER).orderBy("id").collect()
    assert [r.categories for r in rows] == [["Sports"], ["AI"], ["AI"]]
    assert set(rows[0].asDict()) == set(ARTICLE_SCHEMA.names) | {
        "text", "text_lower", "word_count", "text_length", "sentiment", "categories",
    }


def test_cut_is_a_switch(spark):
    df = articles(spark, "x" * 511 + " good and malware")
    assert analyze(df, replace(MAIN, max_chars=512)).first().sentiment == "neutral"
    whole = analyze(df, MAIN).first()
    assert (whole.sentiment, whole.predicted_category) == ("positive", "Cybersecurity")
    assert whole.text_length == 511 + len(" good and malware")


def test_variant_with_plug_ins(spark):
    variant = replace(MAIN, sentiment=lambda t: F.upper(t), category=lambda t: F.lit("own"))
    row = analyze(articles(spark, "twelve chars"), variant).first()
    assert (row.sentiment, row.predicted_category) == ("TWELVE CHARS", "own")
