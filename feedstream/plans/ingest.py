"""Landed feeds and items -> one stream or table of articles."""

from pyspark.sql import functions as F

from feedstream.operators.enrich import (
    attach_feed,
    enrich_hn,
    enrich_rss,
    feed_registry,
    first_ids,
    lookup_items,
    parse_id_lists,
    union_articles,
)
from feedstream.sources.feeds import atom_entries, hn_id_lists, hn_items, rss_entries
from feedstream.sources.files import arrival

ARRIVAL = "_arrival"


def articles(spark, rss_path, hn_path, streaming=False, atom_path=None, item_ids=None, **options):
    """All articles of the landed files, copies and already sent ones included, with ARRIVAL, what
    orders them: feeds as registered, then items; then the file and the place in it.

    ``atom_path`` is a folder of feeds in Atom form, ``hn_path`` one of items or None. ``item_ids`` (id) keeps the items of a list only,
    as first_ids gives them. ``options`` such as maxFilesPerTrigger bound a stream's batches.
    """
    def placed(feed):
        return F.struct(feed.alias("feed"), arrival().alias("file")).alias(ARRIVAL)

    of_feed = placed(F.col("feed_ord"))
    entries = rss_entries(spark, rss_path, streaming, keep=[of_feed], **options)
    if atom_path:
        entries = entries.unionByName(atom_entries(spark, atom_path, streaming, keep=[of_feed], **options))
    with_feed = attach_feed(entries, feed_registry(spark), "feed_ord")
    if hn_path is None:
        return enrich_rss(with_feed, keep=[ARRIVAL])
    last = placed(F.lit(2**31 - 1))
    items = hn_items(spark, hn_path, streaming, keep=[last], **options)
    if item_ids is not None:
        items = lookup_items(item_ids.select("id"), items)
    return union_articles(enrich_rss(with_feed, keep=[ARRIVAL]), enrich_hn(items, keep=[ARRIVAL]))


def listed_articles(spark, list_path, hn_path, within="1 hour", **options):
    """A stream of the articles of landed items that a landed list names among its first ids.

    An item is joined with the lists that landed at most ``within`` before or after it, whichever
    comes first; both wait as state no longer than that. An id that several lists name comes once for
    each of them, so let it pass the ledger (plans.jobs.start_ingest), which keeps the first. ``options``
    such as maxFilesPerTrigger bound a stream's batches.
    """
    landed = F.col("_metadata.file_modification_time")
    span = F.expr(f"INTERVAL {within}")
    lists = hn_id_lists(spark, list_path, streaming=True, keep=[landed.alias("listed_at")], **options)
    ids = first_ids(parse_id_lists(lists, keep=["listed_at"]), keep=["listed_at"]).where("id is not null")
    named = ids.select(F.col("id").alias("listed"), "listed_at").withWatermark("listed_at", within)
    place = F.struct(F.lit(2**31 - 1).alias("feed"), arrival().alias("file")).alias(ARRIVAL)
    items = hn_items(spark, hn_path, streaming=True, keep=[place, landed.alias("landed_at")], **options)
    items = items.where("id is not null").withWatermark("landed_at", within)
    near = F.col("landed_at").between(F.col("listed_at") - span, F.col("listed_at") + span)
    found = items.join(named, (F.col("id") == F.col("listed")) & near)
    return enrich_hn(found, keep=[ARRIVAL])
