"""Toxicity by a chain of linear classifiers, each fed with the probabilities of those before."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from feedstream.llm.common import stored
from feedstream.llm.learn import (
    ROWS, Matrix, best_threshold, bounded_sample, feature_reader, fit, folds_of, out_of_fold, select_features, sigmoid,
    with_features)

SAMPLE = 10_000  # labelled rows that models are fitted on, at most about
FEATURES = 512
FOLDS = 3


def fit_chain(rows, categories, features, folds=FOLDS):
    """Models of the categories in order, and the threshold of the last. A later model learns from
    out-of-fold scores of the earlier ones, so it sees them as they will be on new rows."""
    import numpy as np

    matrix = Matrix(rows["x"].tolist(), features)
    fold = folds_of(rows["doc_id"], folds)
    chain, score, y = [], np.zeros(0), np.zeros(0)
    for name in categories:
        y = rows[name].to_numpy(dtype=float)
        chain.append(fit(matrix, y))
        score = out_of_fold(matrix, y, fold, folds)
        matrix = matrix.plus(sigmoid(score))
    return {"chain": chain, "threshold": best_threshold(sigmoid(score), y)}


def train(docs, labels, categories, sample=SAMPLE, features=FEATURES, id_col="doc_id", text_col="text"):
    """A model of the categories, 0/1 columns of labels, in chain order.

    Fitted on a sample of at most about `sample` labelled rows. Null labels count as 0; labels of
    rows that docs lack are passed over; of repeated labels of an id the largest holds. Without
    rows of both classes a category gets a constant probability.
    """
    flags = labels.groupBy(F.col(id_col).alias("doc_id")).agg(
        *[F.max(F.coalesce(F.col(c).cast("int"), F.lit(0))).alias(c) for c in categories])
    chosen = bounded_sample(flags.where(F.col("doc_id").isNotNull()), sample, 5)
    rows = stored(
        docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .join(chosen, "doc_id").dropDuplicates(["doc_id"]), "toxicity-sample")
    number = select_features(rows, list(categories), features)
    model = fit_chain(with_features(rows, number).toPandas(), categories, max(len(number), 1))
    return model | {"number": number, "categories": list(categories)}


def scorer(spark, model):
    """text column -> struct of p_<category> doubles and `toxic`, computed in Arrow batches."""
    shared = spark.sparkContext.broadcast(model)
    names = [f"p_{c}" for c in model["categories"]]

    @F.pandas_udf(", ".join(f"{n} double" for n in names) + ", toxic boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        read = feature_reader(own["number"])
        for texts in batches:
            parts = []
            for at in range(0, max(len(texts), 1), ROWS):
                matrix = Matrix([sorted(read(t or "")) for t in texts[at:at + ROWS]], max(len(own["number"]), 1))
                columns = []
                for one in own["chain"]:
                    columns.append(sigmoid(matrix.times(one)))
                    matrix = matrix.plus(columns[-1])
                parts.append(pd.DataFrame(
                    dict(zip(names, columns, strict=True)) | {"toxic": columns[-1] >= own["threshold"]}))
            yield pd.concat(parts, ignore_index=True)

    return run


def score(docs, model, text_col="text", scores_col="scores"):
    """docs with scores_col, a struct of p_<category> for each category and `toxic`: whether the last
    category's probability reaches the threshold with the best out-of-fold F1. An existing column
    of that name is replaced. Null or empty texts have no features and get the base rates; repeated
    rows get equal results; an empty table gives no rows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn(scores_col, scorer(docs.sparkSession, model)(text))


def categories_of(docs, labels):
    """labels with the chain's categories: hostile in the main language, in another, and at all."""
    own = docs.select("doc_id", "lang").dropDuplicates(["doc_id"])
    english = F.coalesce(F.col("lang"), F.lit("")) == "en"
    return labels.join(own, "doc_id").select(
        "doc_id", (F.col("toxic") * english.cast("int")).alias("toxic_en"),
        (F.col("toxic") * (~english).cast("int")).alias("toxic_other"), "toxic")


CATEGORIES = ("toxic_en", "toxic_other", "toxic")


def fitted(spark, sf_dir):
    """The chain of CATEGORIES fitted on the labels and documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return train(docs, categories_of(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), CATEGORIES)


def op5(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, fitted(spark, sf_dir)).select(
        "doc_id", *[F.round(f"scores.p_{c}", 6).alias(f"p_{c}") for c in CATEGORIES], "scores.toxic")
