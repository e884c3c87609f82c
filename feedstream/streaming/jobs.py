"""The long-running queries: ingest, analysis and the result tables."""

from pyspark.sql import functions as F

from feedstream.operators.alerts import time_series
from feedstream.operators.dedup import drop_repeats, first_unseen
from feedstream.operators.metrics import counters, recent, roll_up, timeline
from feedstream.reference_data import RECENT_KEPT
from feedstream.sources import segments
from feedstream.sources.ledger import create_ledger, mark_sent, read_ledger
from feedstream.sources.segments import run_of
from feedstream.streaming.sinks import batch_sink, to_all, with_trigger

ROW = "_row"  # place of a record in its batch


def start(writer, name=None, every=None, available_now=False):
    if name:
        writer = writer.queryName(name)
    return with_trigger(writer, every, available_now).start()


def await_any(spark):
    """Wait until any query ends and raise what ended it, so no failure goes unnoticed."""
    spark.streams.awaitAnyTermination()


def ingest(articles, order, ledger_path, publish, checkpoint, hidden=()):
    """Articles not sent before -> publish, then into the ledger. ``hidden`` columns order the
    articles and are not published.

    A replayed batch does not see its own ledger entries, so it publishes the same articles
    again: at least once, and once for sinks keyed by batch. A batch reads the parts of the ledger
    only that its ids can lie in. Only the fresh articles are kept while they are written; bound a
    batch at its source.
    """
    spark = articles.sparkSession
    create_ledger(spark, ledger_path)

    def write(batch, batch_id):
        ledger = read_ledger(batch.sparkSession, ledger_path, before_batch=batch_id, ids=batch.select("id"))
        fresh = first_unseen(batch, ledger.select("id"), order).drop(*hidden)
        to_all(publish, lambda df, i: mark_sent(df, ledger_path, i))(fresh, batch_id)

    return batch_sink(articles, write, checkpoint)


def ingest_by_state(articles, publish, checkpoint, watermark=None):
    """As ingest, with the sent ids in the query's state and not in a ledger table.

    For histories too long to be read with every batch: a batch looks up its own ids only. The
    state grows without bound, or is bounded by watermark = (event-time column, delay).
    """
    return batch_sink(drop_repeats(articles, watermark=watermark), publish, checkpoint)


def publish_results(results, writes, checkpoint):
    """Analysed records to every given place from one reading of the source."""
    return batch_sink(results, to_all(*writes), checkpoint)


def running_counters(view, path, checkpoint):
    """Counts by (source, sentiment, category) since the start.

    One query feeds every counter of the view. Each batch adds its counts to the table of the batch
    before and writes the whole table, which is as large as the number of different keys: too small
    for state in every shuffle partition.
    """
    write_slot = _write_slot(path)

    def write(batch, batch_id):
        counted = counters(batch)
        if batch_id > 0:
            before = batch.sparkSession.read.schema(counted.schema).parquet(_slot(path, batch_id - 1, run_of(batch_id)))
            keys = [c for c in counted.columns if c != "n"]
            counted = roll_up(counted.unionByName(before), *keys)
        write_slot(counted, batch_id)

    return batch_sink(view, write, checkpoint)


def running_timeline(view, path, checkpoint, timestamp="timestamp"):
    """Counts by (minute, sentiment) since the start, held as state: every batch writes the whole
    table; read it with latest_version."""
    grouped = timeline(view, timestamp)
    return batch_sink(grouped, _write_slot(path), checkpoint, mode="complete")


def running_timeline_parts(view, path, checkpoint, timestamp="timestamp"):
    """Counts by (minute, sentiment) of each batch, without state: a batch writes the minutes it
    has, however late they are, and counts merge as batches pile up. Read them with merged_counts."""
    def write(batch, batch_id):
        append_counts(timeline(batch, timestamp), path, batch_id, "minute", "sentiment")

    return batch_sink(view, write, checkpoint)


def running_series(records, path, checkpoint, timestamp, tags, values):
    """Roll-ups of whole-numbered values by minute and tags, as parts that add up, however late a record
    is. Read them with merged_series, by minute or anything coarser."""
    def write(batch, batch_id):
        series = time_series(batch, timestamp, tags, values).where("value is not null")
        segments.append(
            _rolled(series, "minute", tags, {"n": F.count("value"), "total": F.sum(F.col("value").cast("decimal(18,0)")),
                                             "least": F.min("value"), "most": F.max("value")}),
            path, batch_id, lambda rows: _merged(rows, "minute", tags))

    return batch_sink(records, write, checkpoint)


def merged_series(spark, path, unit, *tags):
    """(ts, tags..., metric, n, total, least, most) by minute, hour or day, of the last run. A coarser
    roll-up is made from the stored minutes."""
    return _merged(segments.read_run(spark, path), unit, tags)


def _merged(rows, unit, tags):
    return _rolled(rows, unit, tags, {"n": F.sum("n"), "total": F.sum("total"), "least": F.min("least"), "most": F.max("most")})


def _rolled(rows, unit, tags, sums):
    at = F.date_trunc(unit, "ts").alias("ts")
    found = rows.groupBy(at, *tags, "metric").agg(*[c.alias(name) for name, c in sums.items()])
    return found.withColumn("total", F.col("total").cast("decimal(38,0)"))


def running_recent(view, order, path, checkpoint, n=RECENT_KEPT):
    """The last n records so far by the order columns and then the place in the batch (ROW): those
    of the batch before, merged with the new ones."""
    write_slot = _write_slot(path)

    def write(batch, batch_id):
        place = [*order, ROW]
        newest = recent(batch.withColumn(ROW, F.monotonically_increasing_id()), place, n)
        if batch_id > 0:
            kept = batch.sparkSession.read.schema(newest.schema).parquet(_slot(path, batch_id - 1, run_of(batch_id)))
            newest = recent(newest.unionByName(kept), place, n)
        write_slot(newest, batch_id)

    return batch_sink(view, write, checkpoint)


def latest_version(spark, path):
    """The table as the last finished batch wrote it, whichever run it belongs to."""
    table = spark.read.parquet(path)
    last = table.agg(F.max(F.struct("written", "batch_id", "run"))).scalar()
    newest = table.where(F.struct("written", "batch_id", "run") == last)
    return newest.drop("written", "batch_id", "run", "slot")


def append_counts(counts, path, batch_id, *keys):
    """Write a batch's counts (keys..., n); those of older batches are added up as they merge."""
    segments.append(counts, path, batch_id, lambda rows: roll_up(rows, *keys))


def merged_counts(spark, path, *keys, run=None, batches=None):
    """Sums of the counts that the batches of one run wrote: of the last run, as for latest_version, or
    of the first batches of a named one."""
    return roll_up(segments.read_run(spark, path, run, batches), *keys)


def _slot(path, batch_id, run):
    # Two folders in turn: a batch never overwrites the version before its own, so a replay
    # finds what it read the first time, and old versions do not pile up.
    return f"{path}/run={run}/slot={batch_id % 2}"


def _write_slot(path):
    def write(table, batch_id):
        versioned = table.withColumns({
            "batch_id": F.lit(int(batch_id)), "written": F.current_timestamp()})
        versioned.write.mode("overwrite").parquet(_slot(path, int(batch_id), run_of(batch_id)))

    return write
