"""Counters, rates, top lists, timelines and most-recent lists over result records."""

from pyspark.sql import functions as F

from feedstream.functions.records import percent
from feedstream.reference_data import (
    RECENT_KEPT,
    RECENT_SHOWN,
    RESULT_DEFAULTS,
    TIMELINE_POINTS,
    TITLE_CHARS,
    TOP_CATEGORIES,
)


def result_view(results, timestamp="processing_time", keep=()):
    """Result records as the view shows them: defaults for missing keys, titles cut.

    ``timestamp`` is the time to show: a column name, or current_timestamp() for arrival time.
    """
    def filled(name):
        return F.coalesce(F.col(name), F.lit(RESULT_DEFAULTS[name]))

    return results.select(
        *keep,
        (F.col(timestamp) if isinstance(timestamp, str) else timestamp).alias("timestamp"),
        filled("source").alias("source"),
        F.substring(filled("title"), 1, TITLE_CHARS).alias("title"),
        filled("sentiment").alias("sentiment"),
        filled("predicted_category").alias("category"),
        filled("by").alias("by"),
        filled("word_count").alias("word_count"),
    )


def count_by(df, *keys):
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def counters(view):
    """Counts by (source, sentiment, category): every counter below is a sum over this table."""
    return count_by(view, "source", "sentiment", "category")


def roll_up(counts, *keys):
    """Counts of coarser keys from a table of counts."""
    return counts.groupBy(*keys).agg(F.sum("n").alias("n"))


def kpi_totals(counts):
    """One row: total, positive, sources, categories, positive_rate."""
    totals = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(
            F.sum(F.when(F.col("sentiment") == "positive", F.col("n"))), F.lit(0)
        ).alias("positive"),
        F.count_distinct("source").alias("sources"),
        F.count_distinct("category").alias("categories"),
    )
    rate = percent(F.col("positive"), F.col("total"))
    return totals.withColumn("positive_rate", rate).withColumn(
        "positive_rate_shown", F.bround("positive_rate", 1)
    )


def share(counts, key):
    """Counts of a key and each one's part of the whole. Tables only."""
    by_key = roll_up(counts, key)
    whole = by_key.agg(F.sum("n")).scalar()
    return by_key.withColumn("share", F.col("n") / whole)


def top(counts, key="category", n=TOP_CATEGORIES):
    """The n largest counts, smallest first; of equal counts the first name is the larger."""
    by_key = roll_up(counts, key)
    return by_key.orderBy(F.desc("n"), F.asc(key)).limit(n).orderBy("n", F.desc(key))


def recent(df, order, n=RECENT_KEPT):
    """The last n records by the order columns. Tables only.

    Every task keeps its own n, so only those few leave it.
    """
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def recent_shown(df, order, n=RECENT_SHOWN):
    """The last n records, oldest first, in the columns of the view."""
    return recent(df, order, n).orderBy(*order).select(
        F.date_format("timestamp", "HH:mm:ss").alias("time"),
        "source", "title", "sentiment", "category",
    )


def timeline(view, timestamp="timestamp", watermark=None):
    """Counts by (minute, sentiment), on arrival or event time."""
    timed = view if watermark is None else view.withWatermark(timestamp, watermark)
    grouped = timed.groupBy(F.window(timestamp, "1 minute").alias("w"), "sentiment")
    return grouped.agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("minute"), "sentiment", "n"
    )


def timeline_last(view, order, n=TIMELINE_POINTS):
    """Timeline of the last n records, minutes ascending. Tables only."""
    return timeline(recent(view, order, n)).orderBy("minute", "sentiment")
