"""The long-running jobs, wired from source to sink. Every function starts queries.

``lines`` is a stream of JSON texts (column ``json``), from a topic or from files; a publish
or write is one of the batch writes in streaming.sinks.
"""

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F, types as T

from feedstream.operators import alerts, metrics
from feedstream.operators.parse import flag_corrupt, parse_articles, parse_results
from feedstream.plans.analysis import MAIN, OLDER, analyze
from feedstream.plans.ingest import ARRIVAL
from feedstream.reference_data import (
    ANALYSIS_TRIGGER,
    POLL_TRIGGER,
    RECENT_KEPT,
    RECENT_SHOWN,
    TIMELINE_POINTS,
    VIEW_TRIGGER,
)
from feedstream.sources import segments
from feedstream.streaming import jobs, sinks

VIEW_ORDER = [ARRIVAL, jobs.ROW]


def start_ingest(articles, ledger, publish, checkpoint, **start):
    """Landed articles with ARRIVAL -> those not sent before -> publish, every 30 seconds."""
    writer = jobs.ingest(articles, [ARRIVAL], ledger, publish, checkpoint, hidden=[ARRIVAL])
    return jobs.start(writer, **{"name": "ingest", "every": POLL_TRIGGER, **start})


def start_analysis(lines, publish, checkpoint, variant=MAIN, show=True, quarantine=None, **start):
    """JSON articles -> analysed records -> publish and console, every 10 seconds.

    With ``quarantine``, a batch write, a batch is read once and parted: records that are no JSON, and
    those whose text a model raises on (classify.isolated_sentiment_udf), go there as (raw, error), and
    all others are published.
    """
    shown = [sinks.batch_console()] if show else []
    if quarantine is None:
        results = analyze(parse_articles(lines), variant)
        writer = jobs.publish_results(results, [publish, *shown], checkpoint)
        return jobs.start(writer, **{"name": "analysis", "every": ANALYSIS_TRIGGER, **start})

    def part(batch, batch_id):
        flagged = flag_corrupt(batch, keep=["json"])
        results = analyze(flagged.where("not is_corrupt"), variant, keep=["json"])
        broken = flagged.where("is_corrupt").select("raw", F.lit("not JSON").alias("error"))

        def write_parts(df, i):
            if variant.sentiment is not None and isinstance(df.schema["sentiment"].dataType, T.StructType):
                failed = df.where("sentiment.error is not null").select(F.col("json").alias("raw"), "sentiment.error")
                quarantine(broken.unionByName(failed), i)
                df = df.where("sentiment.error is null").withColumn("sentiment", F.col("sentiment.label"))
            else:
                quarantine(broken, i)
            for one in [publish, *shown]:
                one(df.drop("json"), i)

        sinks.to_all(write_parts)(results, batch_id)

    writer = sinks.batch_sink(lines.select("json"), sinks.to_all(part), checkpoint)
    return jobs.start(writer, **{"name": "analysis", "every": ANALYSIS_TRIGGER, **start})


def start_older_analysis(lines, checkpoint=None, **start):
    """The older job: every column to the console, batch after batch."""
    writer = sinks.console_sink(analyze(parse_articles(lines), OLDER), checkpoint, rows=20)
    return jobs.start(writer, **{"name": "older_analysis", **start})


def start_quarantine(lines, write, checkpoint, **start):
    """Records that are no JSON -> their own place, with the raw text."""
    broken = flag_corrupt(lines).where("is_corrupt").select("raw")
    writer = sinks.batch_sink(broken, write, checkpoint)
    return jobs.start(writer, **{"name": "quarantine", "every": ANALYSIS_TRIGGER, **start})


def start_view(lines, path, checkpoint, timestamp=None, **start):
    """JSON results -> the tables of the view under ``path``, every 2 seconds.

    ``lines`` carries ARRIVAL, the place of a message in its topic or files. Times are arrival
    times unless a column of the results is named.
    """
    when = F.current_timestamp() if timestamp is None else F.col(timestamp)
    view = metrics.result_view(parse_results(lines, keep=[ARRIVAL]), when, keep=["id", ARRIVAL])
    writers = {
        "counters": jobs.running_counters(view, f"{path}/counters", f"{checkpoint}/counters"),
        "recent": jobs.running_recent(view, [ARRIVAL], f"{path}/recent", f"{checkpoint}/recent"),
        "minutes": jobs.running_timeline_parts(view, f"{path}/minutes", f"{checkpoint}/minutes"),
    }
    return [
        jobs.start(writer, **{"name": name, "every": VIEW_TRIGGER, **start})
        for name, writer in writers.items()
    ]


def start_series(lines, path, checkpoint, tags=("source", "sentiment"), values=("word_count", "text_length"), **start):
    """JSON results -> roll-ups of their numbers by minute and tags, read with jobs.merged_series."""
    writer = jobs.running_series(parse_results(lines), path, checkpoint, "processing_time", list(tags), list(values))
    return jobs.start(writer, **{"name": "series", "every": VIEW_TRIGGER, **start})


def start_alerts(
        lines, path, checkpoint, rules=(), run=3, threshold=None, width="1 minute", history=7, **start):
    """JSON results -> counts of a source per window -> tables of alerts under ``path``.

    Every batch adds the counts it holds, however late, and judges the windows it touched and those
    after them that look back on them: broken rules, runs of windows over ``threshold``, and anomalies
    against ``history`` windows. It reads the counts around these windows only. A batch that comes
    again replaces what it wrote; the newest judgement of a window is read with read_alerts.
    """
    seconds, reach = alerts.seconds_of(width), max(history, run - 1)

    def around(touched, first, last):
        steps = F.explode(F.sequence(F.lit(first), F.lit(last)))
        at = F.timestamp_seconds(F.unix_timestamp("win") + F.col("step") * seconds)
        return touched.select("key", "win", steps.alias("step")).select("key", at.alias("win")).distinct()

    def judge(batch, batch_id):
        spark, counts = batch.sparkSession, f"{path}/counts"
        counted = alerts.windowed_counts(batch, "source", "timestamp", width)
        jobs.append_counts(counted, counts, batch_id, "key", "win")
        touched = segments.read_batch(spark, counts, batch_id).select("key", "win")
        span = touched.agg(F.min("win").alias("first"), F.max("win").alias("last")).first()
        merged = jobs.merged_counts(
            spark, counts, "key", "win", run=segments.run_of(batch_id), batches=int(batch_id) + 1)
        if span["first"] is not None:
            wide = timedelta(seconds=reach * seconds)
            merged = merged.where(F.col("win").between(F.lit(span["first"] - wide), F.lit(span["last"] + wide)))
        near = merged.join(around(touched, -reach, reach), ["key", "win"], "left_semi")
        found = [
            alerts.threshold_alerts(near, rules).select("key", "win", "n", F.col("level").alias("alert")),
            alerts.anomalies(near, history, width=width).select("key", "win", "n", F.lit("anomaly").alias("alert")),
            near.select("key", "win", "n", F.lit(None).cast("string").alias("alert")),
        ]
        if threshold is not None:
            found.append(alerts.pattern_alerts(near, threshold, run, width).select(
                "key", "win", "n", F.lit("pattern").alias("alert")))
        judged = reduce(DataFrame.unionByName, found).join(around(touched, 0, reach), ["key", "win"], "left_semi")
        numbered = judged.withColumn("judged", F.lit(int(batch_id)).cast("long"))
        segments.append(numbered, f"{path}/alerts", batch_id, _newest_judgement)

    when = F.col("processing_time")
    view = metrics.result_view(parse_results(lines), when)
    writer = sinks.batch_sink(view, judge, checkpoint)
    return jobs.start(writer, **{"name": "alerts", "every": VIEW_TRIGGER, **start})


def _newest_judgement(rows):
    """Of each window the rows of the last batch that judged it; one of them has no alert."""
    last = F.max("judged").over(Window.partitionBy("key", "win"))
    return rows.withColumn("last", last).where(F.col("judged") == F.col("last")).drop("last")


def read_alerts(spark, path):
    """(key, win, n, alert) as the last batch of the last run judged the windows."""
    newest = _newest_judgement(segments.read_run(spark, f"{path}/alerts"))
    return newest.where("alert is not null").select("key", "win", "n", "alert")


def read_view(spark, path, points=TIMELINE_POINTS, shown=RECENT_SHOWN):
    """Everything the view shows, as tables: all of them small but `minutes`, the whole timeline."""
    if max(points, shown) > RECENT_KEPT:
        raise ValueError(f"the view keeps the last {RECENT_KEPT} records")
    counts = jobs.latest_version(spark, f"{path}/counters")
    newest = jobs.latest_version(spark, f"{path}/recent")
    return {
        "totals": metrics.kpi_totals(counts),
        "by_source": metrics.roll_up(counts, "source"),
        "by_sentiment": metrics.share(counts, "sentiment"),
        "by_category": metrics.roll_up(counts, "category"),
        "top_categories": metrics.top(counts),
        "timeline": metrics.timeline_last(newest, VIEW_ORDER, points),
        "minutes": jobs.merged_counts(spark, f"{path}/minutes", "minute", "sentiment"),
        "recent": metrics.recent_shown(newest, VIEW_ORDER, shown),
    }
