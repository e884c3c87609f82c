"""Derived text columns and the length filter."""

from pyspark.sql import functions as F

from feedstream.functions.text import word_count


def clean(df, min_length=None, processing_time=True):
    """Adds text, text_lower, word_count, text_length (and processing_time).

    With min_length only texts longer than that stay; a missing text goes as well.
    """
    text = F.col("text_combined")
    derived = {
        "text": text,
        "text_lower": F.lower(text),
        "word_count": word_count(text),
        "text_length": F.length(text),
    }
    if processing_time:
        derived["processing_time"] = F.current_timestamp()
    cleaned = df.withColumns(derived)
    return cleaned if min_length is None else cleaned.where(F.col("text_length") > min_length)
