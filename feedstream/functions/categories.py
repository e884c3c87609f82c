"""Keyword categories."""

import json
from functools import reduce

from pyspark.sql import functions as F


def contains_any(text, keywords):
    """True where any keyword is a substring of the text."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(k)) for k in keywords])


def first_match(text_lower, table, default):
    """Name of the first entry of the table with a keyword in the text, else the default."""
    names = [F.when(contains_any(text_lower, words), F.lit(name)) for name, words in table.items()]
    return F.coalesce(*names, default)


def label_text(keywords):
    """The keywords as one text, the form in which a category is embedded."""
    return F.array_join(keywords, " ")


def category_vectors(table):
    """Word counts of every category's label text."""
    words = {name: " ".join(keywords).split(" ") for name, keywords in table.items()}
    return {name: {w: ws.count(w) for w in ws} for name, ws in words.items()}


def term_counts(words):
    """Array of words -> array of (word, n), one entry per different word."""
    def counted(word):
        n = F.size(words) - F.size(F.array_remove(words, word))
        return F.struct(word.alias("word"), n.cast("double").alias("n"))

    return F.transform(F.array_distinct(words), counted)


def term_norm(counts):
    """Length of a text's vector of word counts."""
    return F.sqrt(F.aggregate(counts, F.lit(0.0), lambda total, t: total + t["n"] * t["n"]))


def keyword_scores(counts, norm, vectors):
    """Cosine of word counts (of length ``norm``) with every category vector, 0 for no hits.

    Only the text's own words are visited. Scores are kept to 9 places so that equal ones
    compare equal whatever the sum order.
    """
    declared = F.from_json(
        F.lit(json.dumps([
            {"weights": v, "norm": sum(n * n for n in v.values()) ** 0.5}
            for v in vectors.values()
        ])),
        "array<struct<weights: map<string, double>, norm: double>>",
    )

    def score(c):
        def weighed(total, t):
            weight = F.try_element_at(c["weights"], t["word"])
            return total + t["n"] * F.coalesce(weight, F.lit(0.0))

        return F.round(F.aggregate(counts, F.lit(0.0), weighed) / (norm * c["norm"]), 9)

    return F.transform(declared, lambda c: F.when(norm > 0, score(c)).otherwise(F.lit(0.0)))
