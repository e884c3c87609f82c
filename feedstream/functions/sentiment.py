"""Word-list sentiment."""

from pyspark.sql import functions as F

from feedstream.reference_data import SENTIMENT_LABELS


def lexicon_score(words, positive, negative):
    """Positive minus negative words, for words already cut down to the two lists."""
    def count(word_list):
        return F.size(F.filter(words, lambda w: w.isin(list(word_list))))

    return count(positive) - count(negative)


def sentiment_label(score):
    """Sign of the score as a label."""
    negative, neutral, positive = SENTIMENT_LABELS
    return (
        F.when(score > 0, positive).when(score < 0, negative).otherwise(F.lit(neutral))
    )
