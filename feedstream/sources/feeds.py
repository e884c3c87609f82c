"""Landed feed documents and news items.

Feeds land as XML files under ``<path>/feed_ord=<n>/``, n being the feed's place in the
registry, so every entry carries its feed. Items and id lists land as JSON lines.
"""

from pyspark.sql import functions as F, types as T

from feedstream.schemas import ATOM_ENTRY_SCHEMA, HN_ITEM_SCHEMA, RSS_ITEM_SCHEMA
from feedstream.sources.files import read_records

FEED_ORD = T.StructField("feed_ord", T.IntegerType())


def rss_entries(spark, path, streaming=False, schema=RSS_ITEM_SCHEMA, keep=(), **options):
    """One row per RSS item: feed_ord, id, title, link, summary, published. An item without a
    description or date gives its full content or its Dublin Core date, where it has them."""
    items = _xml(spark, path, "item", schema, streaming, options)
    return items.select(
        "feed_ord",
        *keep,
        F.col("guid").alias("id"),
        "title",
        "link",
        _first(items, "description", "content:encoded").alias("summary"),
        _first(items, "pubDate", "dc:date").alias("published"),
    )


def atom_entries(spark, path, streaming=False, keep=(), **options):
    """One row per Atom entry, in the shape of rss_entries. An entry without a summary or date of
    publication gives its content or its date of update."""
    entries = _xml(spark, path, "entry", ATOM_ENTRY_SCHEMA, streaming, options)
    page = F.filter("link", lambda l: F.coalesce(l["_rel"], F.lit("alternate")) == "alternate")
    return entries.select(
        "feed_ord",
        *keep,
        "id",
        "title",
        F.get(page, F.lit(0))["_href"].alias("link"),
        _first(entries, "summary", "content").alias("summary"),
        _first(entries, "published", "updated").alias("published"),
    )


def _first(df, *names):
    return F.coalesce(*[F.col(f"`{name}`") for name in names if name in df.columns])


def hn_items(spark, path, streaming=False, keep=(), **options):
    """One row per landed item; a line that is no item gives a row of NULLs."""
    items = read_records(spark, path, "json", HN_ITEM_SCHEMA, streaming, **options)
    return items.select(*HN_ITEM_SCHEMA.names, *keep)


def hn_id_lists(spark, path, streaming=False, keep=(), **options):
    """One row per landed list, as JSON text."""
    lines = read_records(spark, path, "text", "value string", streaming, **options)
    return lines.select(F.col("value").alias("json"), *keep)


def _xml(spark, path, row_tag, schema, streaming, options):
    with_feed = T.StructType([*schema.fields, FEED_ORD])
    return read_records(
        spark, path, "xml", with_feed, streaming, rowTag=row_tag, valueTag="_text", **options
    )
