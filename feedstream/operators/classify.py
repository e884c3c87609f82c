"""Sentiment and nearest category, by native expressions or a pluggable model."""

from pyspark import cloudpickle
from pyspark.sql import SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from feedstream.functions.categories import (
    category_vectors,
    keyword_scores,
    label_text,
    term_counts,
    term_norm,
)
from feedstream.functions.sentiment import lexicon_score, sentiment_label
from feedstream.functions.text import model_text, words_in
from feedstream.functions.vectors import argmax_label
from feedstream.reference_data import (
    CATEGORIES_MAIN,
    NEGATIVE_WORDS,
    POSITIVE_WORDS,
    SENTIMENT_LABELS,
)
from feedstream.sources.declared import declared_table

MAX_CATEGORIES = 4096  # most category vectors that nearest_category sends to the records
TEXTS = 1_000  # texts that a plugged-in model is given at once, at most
NO_SCORE = -2.0  # below every cosine: a vector without length


def classify_words(
    df,
    text="text",
    positive=POSITIVE_WORDS,
    negative=NEGATIVE_WORDS,
    categories=CATEGORIES_MAIN,
    max_chars=None,
    unmatched_label=None,
    sentiment=True,
    category=True,
):
    """Adds ``sentiment`` and ``predicted_category`` from the words of the text.

    Each text is split once; both classifiers work on the few words they know. A text of no
    category word gets the first category, or unmatched_label where one is given.
    """
    vectors = category_vectors(categories)
    known = set()
    if sentiment:
        known |= set(positive) | set(negative)
    if category:
        known |= {word for vector in vectors.values() for word in vector}
    out = df.withColumn("_words", words_in(model_text(F.col(text), max_chars), sorted(known)))
    if sentiment:
        score = lexicon_score(F.col("_words"), positive, negative)
        out = out.withColumn("_score", score)
        out = out.withColumn("sentiment", sentiment_label(F.col("_score"))).drop("_score")
    if category:
        out = out.withColumn("_counts", term_counts(F.col("_words")))
        out = out.withColumn("_norm", term_norm(F.col("_counts")))
        out = out.withColumn(
            "_scores", keyword_scores(F.col("_counts"), F.col("_norm"), vectors)
        )
        best = argmax_label(F.col("_scores"), list(vectors))
        if unmatched_label is not None:
            hit = F.array_max("_scores") > 0
            best = F.when(hit, best).otherwise(F.lit(unmatched_label))
        out = out.withColumn("predicted_category", best).drop(
            "_counts", "_norm", "_scores"
        )
    return out.drop("_words")


def category_labels(spark, categories=CATEGORIES_MAIN):
    """(ord, category, keywords, label_text) of a declared category table."""
    rows = [(i, name, list(words)) for i, (name, words) in enumerate(categories.items())]
    table = declared_table(spark, rows, "ord int, category string, keywords array<string>")
    return table.withColumn("label_text", label_text(F.col("keywords")))


def category_centroids(df, category="label", vector="embedding"):
    """(category, vector, n): the mean vector of every category. Vectors have one length.

    Every task sums its Arrow batches, so one partial sum per batch and category is exchanged and a
    hot category weighs no more than another.
    """
    kind = df.select(category).schema[0].dataType.simpleString()

    def partial(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keys = batch.column(0).dictionary_encode()
            rows = np.stack([v.values.to_numpy() for v in batch.column(1)]).astype(float)
            place = keys.indices.to_numpy()
            sums = np.zeros((len(keys.dictionary), rows.shape[1]))
            np.add.at(sums, place, rows)
            yield pa.RecordBatch.from_arrays(
                [keys.dictionary, pa.array(list(sums)), pa.array(np.bincount(place, minlength=len(sums)))],
                ["category", "total", "n"])

    known = df.where(F.col(category).isNotNull() & F.col(vector).isNotNull())
    parts = known.select(F.col(category), F.col(vector).cast("array<double>")).mapInArrow(
        partial, f"category {kind}, total array<double>, n bigint")
    added = F.reduce(
        F.collect_list("total"), F.array().cast("array<double>"),
        lambda total, x: F.when(F.size(total) == 0, x).otherwise(F.zip_with(total, x, lambda p, q: p + q)))
    return parts.groupBy("category").agg(added.alias("total"), F.sum("n").alias("n")).select(
        "category", F.transform("total", lambda x: x / F.col("n")).alias("vector"), "n")


def nearest_category(df, categories, vector="embedding"):
    """Adds (category, score) of the category vector with the largest cosine.

    ``categories`` has (ord, category, vector): declared labels or centroids, at most
    MAX_CATEGORIES. They are computed once and broadcast; the records stay where they are, and
    their batches are scored as one matrix product. Of equal scores the smallest ord wins.
    """
    few = categories.select("ord", "category", "vector").limit(MAX_CATEGORIES + 1).collect()
    if not 0 < len(few) <= MAX_CATEGORIES:
        raise ValueError(f"nearest_category takes 1 to {MAX_CATEGORIES} categories")
    few.sort(key=lambda c: c.ord)
    best = _best_of(df.sparkSession.sparkContext, few)
    kind = categories.schema["category"].dataType
    return df.withColumn("_best", best(F.col(vector))).withColumns({
        "category": F.col("_best.category").cast(kind),
        "score": F.nullif("_best.score", F.lit(NO_SCORE)),
    }).drop("_best")


def _nearest():
    """(vectors, matrix) -> position and cosine of the nearest row of the matrix to each vector, the
    first of equal ones. Made here so that executors get it by value."""
    no_score = NO_SCORE

    def nearest(vectors, matrix):
        import numpy as np

        def unit(rows):
            with np.errstate(invalid="ignore", divide="ignore"):
                return rows / np.linalg.norm(rows, axis=1, keepdims=True)

        scores = np.nan_to_num((unit(vectors) @ unit(matrix).T).round(9), nan=no_score)
        place = scores.argmax(axis=1)
        return place, scores[np.arange(len(place)), place]

    return nearest


def _best_of(context, categories):
    """Vector -> (score, category) of the best of a few categories, in order."""
    import pandas as pd

    declared = context.broadcast((
        [[float(x) for x in c.vector] for c in categories], [str(c.category) for c in categories],
    ))
    nearest = _nearest()

    def best(vectors):
        import numpy as np

        matrix, names = declared.value
        matrix = np.asarray(matrix)
        nothing = np.zeros(matrix.shape[1])
        rows = np.stack([nothing if v is None else v for v in vectors]).astype(float)
        place, score = nearest(rows, matrix)
        return pd.DataFrame({"score": score, "category": np.asarray(names)[place]})

    best.__annotations__ = {"vectors": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(best, "score double, category string")


def own_category_score(df, categories, category="category", vector="embedding"):
    """Adds score, the cosine with the vector of the record's own category.

    ``categories`` has (category, vector). Spark joins as sizes allow; a hot category is split by
    the adaptive skew join.
    """
    own = categories.select(F.col("category").alias(category), F.col("vector").alias("_own"))
    scored = df.join(own, category)
    return scored.withColumn("score", cosine_udf()(F.col(vector), F.col("_own"))).drop("_own")


def cosine_udf():
    """Column function: as functions.vectors.cosine, for many long vectors of one length."""
    import pandas as pd

    def cosines(a, b):
        import numpy as np

        known = (a.notna() & b.notna()).to_numpy()
        result = np.full(len(a), np.nan)
        if known.any():
            x = np.stack(a[known].to_list()).astype(float)
            y = np.stack(b[known].to_list()).astype(float)
            lengths = np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)
            with np.errstate(invalid="ignore", divide="ignore"):
                result[known] = np.einsum("ij,ij->i", x, y) / lengths
        return pd.Series(result).astype(object).where(~np.isnan(result), None)

    cosines.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}
    return F.pandas_udf(cosines, "double")


def _per_worker(factory):
    """A function that gives factory(), made once per Python worker: broadcast values live there."""
    holder = SparkSession.active().sparkContext.broadcast({"factory": cloudpickle.dumps(factory)})

    def model():
        import pickle

        kept = holder.value
        if "model" not in kept:
            kept["model"] = pickle.loads(kept["factory"])()
        return kept["model"]

    return model


def sentiment_udf(scorer_factory, labels=SENTIMENT_LABELS, max_chars=None):
    """Column function: text -> label of the largest class score of a plugged-in model.

    ``scorer_factory()`` is called once per worker process and returns ``score(list of texts)`` ->
    array of shape (texts, labels). Missing texts are scored as ''. ``max_chars`` cuts what the
    model sees, for models with a limited input.
    """
    model, names = _per_worker(scorer_factory), list(labels)

    def predict(texts):
        import numpy as np

        scores = np.asarray(model()(texts))
        return np.array(names, dtype=object)[scores.reshape(len(texts), len(names)).argmax(axis=1)].tolist()

    return _text_udf(predict, "string", max_chars)


def apart(score, texts):
    """[(result, None) or (None, error)] of each text. A list that ``score`` fails on is halved until the
    texts that it fails on stand alone, so k bad ones of n cost some k * log(n) calls more."""
    if not texts:
        return []
    try:
        found = list(score(texts))
        if len(found) != len(texts):
            raise ValueError(f"{len(found)} results for {len(texts)} texts")
        return [(x, None) for x in found]
    except Exception as error:  # whatever a plugged-in model raises
        if len(texts) == 1:
            return [(None, f"{type(error).__name__}: {error}")]
        half = len(texts) // 2
        return apart(score, texts[:half]) + apart(score, texts[half:])


def isolated_sentiment_udf(scorer_factory, labels=SENTIMENT_LABELS, max_chars=None):
    """As sentiment_udf, with a struct (label, error): a text that the model raises on has no label but
    the error, and the other texts of its batch keep their labels."""
    model, names = _per_worker(scorer_factory), list(labels)

    def predict(texts):
        import numpy as np

        return [{"label": None if e else names[int(np.argmax(x))], "error": e} for x, e in apart(model(), texts)]

    return _text_udf(predict, "label string, error string", max_chars)


def embedding_udf(embedder_factory, max_chars=None):
    """Column function: text -> vector of a plugged-in model, for nearest_category.

    ``embedder_factory()`` is called once per worker process and returns ``embed(list of texts)``
    -> array of shape (texts, dimensions). ``max_chars`` as in sentiment_udf.
    """
    model = _per_worker(embedder_factory)

    def embed(texts):
        import numpy as np

        return list(np.asarray(model()(texts), dtype=float))

    return _text_udf(embed, "array<double>", max_chars)


def embedded_category(embedder_factory, categories=CATEGORIES_MAIN, max_chars=None):
    """Column function: text -> category whose label text a plugged-in embedder puts nearest, the
    first declared of equal ones. Label texts are embedded once per worker process."""
    names, texts_of = list(categories), [" ".join(words) for words in categories.values()]
    nearest = _nearest()

    def factory():
        import numpy as np

        embed = embedder_factory()
        return embed, np.asarray(embed(texts_of), dtype=float)

    model = _per_worker(factory)

    def categorize(texts):
        import numpy as np

        embed, labels = model()
        rows = np.asarray(embed(texts), dtype=float)
        return np.array(names, dtype=object)[nearest(rows, labels)[0]].tolist()

    return _text_udf(categorize, "string", max_chars)


def embedded_labels(spark, embedder, categories=CATEGORIES_MAIN):
    """(ord, category, vector) of a declared category table, each label text embedded once."""
    texts = [" ".join(words) for words in categories.values()]
    vectors = [[float(x) for x in row] for row in embedder(texts)]
    rows = [(i, name, vectors[i]) for i, name in enumerate(categories)]
    return declared_table(spark, rows, "ord int, category string, vector array<double>")


def _text_udf(function, returns, max_chars):
    """Column function from a function of a list of texts. An Arrow batch is taken in parts of TEXTS, so
    that a worker never holds all its texts and what a model makes of them as Python objects."""
    import pyarrow as pa

    size, kind = TEXTS, to_arrow_type(T._parse_datatype_string(returns))

    def in_parts(texts):
        parts = [
            pa.array(function([(t or "")[:max_chars] for t in texts.slice(at, size).to_pylist()]), kind)
            for at in range(0, len(texts), size)]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    in_parts.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(in_parts, returns)
