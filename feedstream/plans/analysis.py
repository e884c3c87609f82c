"""Article text -> sentiment and category."""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from feedstream.functions.text import model_text
from feedstream.operators.classify import classify_words
from feedstream.operators.clean import clean
from feedstream.reference_data import (
    CATEGORIES_MAIN,
    CATEGORIES_OLDER,
    MIN_TEXT_LENGTH,
    NEGATIVE_WORDS,
    POSITIVE_WORDS,
)
from feedstream.schemas import RESULT_COLUMNS


@dataclass(frozen=True)
class Variant:
    """Switches of the analysis; ``sentiment`` and ``category`` plug in other models."""

    min_text_length: int | None = MIN_TEXT_LENGTH
    processing_time: bool = True
    max_chars: int | None = None
    categories: dict = field(default_factory=lambda: CATEGORIES_MAIN)
    category_array: bool = False
    results_only: bool = True
    positive: tuple = tuple(POSITIVE_WORDS)
    negative: tuple = tuple(NEGATIVE_WORDS)
    unmatched_label: str | None = None
    sentiment: Callable[[Column], Column] | None = None
    category: Callable[[Column], Column] | None = None


# Both jobs classify whole texts; a plugged-in model cuts its own input (sentiment_udf and
# embedding_udf take max_chars). The older job keeps short texts and shows every column.
MAIN = Variant()
OLDER = Variant(
    min_text_length=None,
    processing_time=False,
    categories=CATEGORIES_OLDER,
    category_array=True,
    results_only=False,
)
WHOLE_TEXT = MAIN


def analyze(articles, variant=MAIN, keep=()):
    """Parsed articles -> analysed records. ``keep`` names further columns to carry along."""
    if variant.results_only:
        articles = articles.select(*keep, "source", "id", "title", "link", "by", "text_combined")
    cleaned = clean(articles, variant.min_text_length, variant.processing_time)
    seen = model_text(F.col("text"), variant.max_chars)
    out = cleaned
    if variant.sentiment is not None:
        out = out.withColumn("sentiment", variant.sentiment(seen))
    if variant.category is not None:
        out = out.withColumn("predicted_category", variant.category(seen))
    if variant.sentiment is None or variant.category is None:
        out = classify_words(
            out,
            positive=variant.positive,
            negative=variant.negative,
            categories=variant.categories,
            max_chars=variant.max_chars,
            unmatched_label=variant.unmatched_label,
            sentiment=variant.sentiment is None,
            category=variant.category is None,
        )
    if variant.results_only:
        columns = RESULT_COLUMNS if variant.processing_time else RESULT_COLUMNS[:-1]
        return out.select(*keep, *columns)
    if variant.category_array:
        out = out.withColumn("categories", F.array("predicted_category"))
        out = out.drop("predicted_category")
    return out
