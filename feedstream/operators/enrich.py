"""Feed entries and news items -> article records."""

from pyspark.sql import functions as F

from feedstream.functions.categories import first_match
from feedstream.functions.text import combine_text
from feedstream.reference_data import (
    DEFAULT_CATEGORY,
    FEED_REGISTRY,
    HN_DEFAULT_CATEGORY,
    HN_LIST_LENGTH,
    INGEST_KEYWORDS,
)
from feedstream.sources.declared import declared_table


def feed_registry(spark, registry=FEED_REGISTRY):
    """(feed_ord, feed_category, feed_url), in declared order."""
    feeds = [(category, url) for category, urls in registry.items() for url in urls]
    rows = [(i, category, url) for i, (category, url) in enumerate(feeds)]
    return declared_table(spark, rows, "feed_ord int, feed_category string, feed_url string")


def attach_feed(entries, registry, on="feed_url"):
    """Entries with the category of their feed; entries of unknown feeds get the default."""
    joined = entries.join(registry, on, "left")
    return joined.withColumn(
        "feed_category", F.coalesce("feed_category", F.lit(DEFAULT_CATEGORY))
    )


def tag_category(df, text="text_combined", default=None, table=INGEST_KEYWORDS):
    """Adds category: the first table entry with a keyword in the text, else the default."""
    fallback = F.lit(DEFAULT_CATEGORY) if default is None else default
    lowered = df.withColumn("_lower", F.lower(F.col(text)))
    return lowered.withColumn("category", first_match(F.col("_lower"), table, fallback)).drop(
        "_lower"
    )


def enrich_rss(entries, fetched_at=None, keep=()):
    """Entries (id, link, title, summary, published, feed_category) -> RSS articles."""
    articles = entries.select(
        *keep,
        F.lit("rss").alias("source"),
        F.coalesce("id", "link").alias("id"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("link", F.lit("")).alias("link"),
        "published",
        F.coalesce("summary", F.lit("")).alias("summary"),
        combine_text(F.col("title"), F.col("summary")).alias("text_combined"),
        F.coalesce("feed_category", F.lit(DEFAULT_CATEGORY)).alias("feed_category"),
    )
    tagged = tag_category(articles, default=F.col("feed_category")).drop("feed_category")
    return tagged.withColumn("fetch_timestamp", _fetched(fetched_at))


def enrich_hn(items, fetched_at=None, keep=()):
    """Items (id, title, url, by, score, time, type) -> HN articles; the text is the title."""
    title = F.coalesce("title", F.lit(""))
    articles = items.where(F.col("id").isNotNull()).select(
        *keep,
        F.lit("hn").alias("source"),
        F.col("id").cast("string").alias("id"),
        title.alias("title"),
        F.coalesce("url", F.lit("")).alias("link"),
        F.coalesce("by", F.lit("")).alias("by"),
        F.coalesce("score", F.lit(0)).cast("long").alias("score"),
        F.coalesce("time", F.lit(0)).cast("long").alias("time"),
        "type",
        title.alias("text_combined"),
    )
    tagged = tag_category(articles, default=F.lit(HN_DEFAULT_CATEGORY))
    return tagged.withColumn("fetch_timestamp", _fetched(fetched_at))


def union_articles(rss, hn):
    """Both article shapes in one; fields only one of them has are NULL in the other."""
    return rss.unionByName(hn, allowMissingColumns=True)


def first_ids(id_lists, ids="ids", n=HN_LIST_LENGTH, keep=()):
    """The first n ids of each list with their position, in list order."""
    return id_lists.select(*keep, F.posexplode(F.slice(ids, 1, n)).alias("pos", "id"))


def parse_id_lists(df, json="json", keep=()):
    """JSON arrays of ids -> array column ``ids``."""
    return df.select(*keep, F.from_json(json, "array<bigint>").alias("ids"))


def lookup_items(ids, items):
    """Items of the listed ids; ids without an item are dropped."""
    return items.where(F.col("id").isNotNull()).join(ids, "id")


def _fetched(fetched_at):
    return F.unix_timestamp() if fetched_at is None else fetched_at
