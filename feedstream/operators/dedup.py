"""First-seen de-duplication, with and without a ledger of sent articles.

A NULL id never equals another one: such records always stay. Their dedup key carries a number
of their own instead, which also keeps them from meeting in one task.
"""

from pyspark.sql import functions as F

KEY = "_dedup_key"
RECORD = "_record"


def first_seen(df, order, id="id"):
    """The first record of every id by the order columns, then by place in the input. Tables only.

    The minimum is taken on the map side first, so an id with very many copies reaches its
    reducer as one record per map task.
    """
    return _first_by_key(df, order, id).drop(KEY)


def unseen(df, ledger, id="id"):
    """Records whose id is not in the ledger, copies included.

    Copies of a very frequent id are split by the adaptive skew join; first_unseen drops them.
    """
    return df.join(ledger.select(id), id, "left_anti")


def first_unseen(df, ledger, order, id="id"):
    """first_seen and unseen in one: the records are shuffled once, on the dedup key."""
    sent = ledger.where(F.col(id).isNotNull())
    none = F.lit(None).cast("bigint")
    sent_keys = sent.select(F.struct(F.col(id).alias("id"), none.alias("p")).alias(KEY))
    return _first_by_key(df, order, id).join(sent_keys, KEY, "left_anti").drop(KEY)


def drop_repeats(stream, id="id", watermark=None):
    """Streaming first-seen by state: unbounded, or bounded by (event-time column, delay).

    Spark sends every copy of an id to that id's state; where single ids have very many copies,
    use the ledger (streaming.jobs.ingest), which drops them before the exchange.
    """
    with_id, without_id = stream.where(F.col(id).isNotNull()), stream.where(F.col(id).isNull())
    if watermark is None:
        return with_id.dropDuplicates([id]).unionByName(without_id)
    event_time, delay = watermark
    kept = with_id.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([id])
    return kept.unionByName(without_id.withWatermark(event_time, delay))


def _first_by_key(df, order, id):
    numbered = df.withColumn(RECORD, F.monotonically_increasing_id())
    key = F.struct(F.col(id).alias("id"), F.when(F.col(id).isNull(), F.col(RECORD)).alias("p"))
    firsts = numbered.groupBy(key.alias(KEY)).agg(
        F.min_by(F.struct(*df.columns), F.struct(*order, RECORD)).alias("_first")
    )
    return firsts.select(KEY, "_first.*")
