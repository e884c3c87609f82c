"""Anomalies, threshold alerts, pattern alerts and long-form time series.

The definitions are this library's own: the feature set names these four without fixing them.
All take metric tables (key, window, n), already aggregated, so a group is one key's windows.
"""

import json
from fractions import Fraction

from pyspark.sql import Window, functions as F

SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def windowed_counts(df, key, timestamp, width="1 day"):
    """Counts by (key, window start)."""
    return df.groupBy(F.col(key).alias("key"), F.window(timestamp, width).alias("w")).agg(
        F.count("*").alias("n")
    ).select("key", F.col("w.start").alias("win"), "n")


def seconds_of(width):
    """Seconds of a window width such as '5 minutes'."""
    number, unit = width.split()
    return int(number) * SECONDS[unit.rstrip("s")]


def _in_time(width):
    """Windows of a key on their start in seconds, and the seconds of a window."""
    at = Window.partitionBy("key").orderBy(F.unix_timestamp(F.col("win").cast("timestamp")))
    return at, seconds_of(width)


def anomalies(metrics, history=7, limit=2.0, width="1 day"):
    """Windows whose n lies more than ``limit`` deviations off the key's previous windows.

    ``width`` is that of the windows. Only windows that follow a full, gapless history are judged;
    a history without spread judges nothing. The limit is tested in whole numbers, so a window that
    lies exactly at it is no anomaly, whatever the order in which counts are added.
    """
    at, seconds = _in_time(width)
    past = at.rangeBetween(-history * seconds, -1)
    square = F.col("n").cast("decimal(18,0)") * F.col("n").cast("decimal(18,0)")
    summed = metrics.select(
        "key", "win", "n",
        F.count("*").over(past).alias("seen"),
        F.sum("n").over(past).alias("s"),
        F.sum(square).over(past).alias("q"),
    ).where(F.col("seen") == history)
    whole = lambda c: c.cast("decimal(19,0)")
    # With sums s of n and q of n * n over N windows: off / N is the distance from the mean, and
    # spread / (N * (N - 1)) the variance.
    moments = summed.select(
        "key", "win", "n", "s", (F.col("n") * history - F.col("s")).alias("off"),
        (F.col("q") * history - whole(F.col("s")) * whole(F.col("s"))).alias("spread"))
    over = Fraction(str(limit)) ** 2
    far = whole(F.col("off")) * whole(F.col("off")) * ((history - 1) * over.denominator)
    found = moments.where((F.col("spread") > 0) & (far > F.col("spread") * (history * over.numerator)))
    spread = F.col("spread").cast("double")
    return found.select(
        "key", "win", "n", (F.col("s") / history).alias("mean"),
        F.sqrt(spread / (history * (history - 1))).alias("spread"),
        (F.col("off").cast("double") / F.sqrt(history * spread / (history - 1))).alias("z"))


def threshold_alerts(metrics, rules, metric="count"):
    """Metric rows that break a rule of that metric, one row per broken rule.

    ``rules`` is a declared list of (metric, op, threshold, level) with op '>' or '<'. Each row
    is checked where it is, so no join is needed.
    """
    own = [dict(zip(("op", "threshold", "level"), r[1:])) for r in rules if r[0] == metric]
    unknown = {rule["op"] for rule in own} - {">", "<"}
    if unknown:
        raise ValueError(f"operators of rules are > and <, not {sorted(unknown)}")
    declared = F.from_json(
        F.lit(json.dumps(own)), "array<struct<op: string, threshold: double, level: string>>"
    )

    def broken(rule):
        over = (rule["op"] == ">") & (F.col("n") > rule["threshold"])
        under = (rule["op"] == "<") & (F.col("n") < rule["threshold"])
        return over | under

    return metrics.select("*", F.lit(metric).alias("metric"), F.inline(F.filter(declared, broken)))


def pattern_alerts(metrics, threshold, run=3, width="1 day"):
    """Windows that end a run of at least ``run`` windows in a row over the threshold; a missing
    window ends a run. ``width`` is that of the windows."""
    at, seconds = _in_time(width)
    last = at.rangeBetween((1 - run) * seconds, 0)
    breach = F.when(F.col("n") > threshold, 1).otherwise(0)
    flagged = metrics.withColumn("breaches", F.sum(breach).over(last))
    return flagged.where(F.col("breaches") == run).drop("breaches")


def time_series(df, timestamp, tags, values):
    """Long form (ts, tags..., metric, value), one row per record and value column."""
    timed = df.select(
        F.col(timestamp).alias("ts"), *tags, *[F.col(v).cast("double").alias(v) for v in values]
    )
    return timed.unpivot(["ts", *tags], list(values), "metric", "value")


def write_time_series(series, path, batch):
    """Store long-form series by date, so that a time range reads only its days.

    ``batch`` names the part that is written; writing it again replaces it. Rebalancing gives
    every date few, evenly sized files; a large date is split over tasks.
    """
    dated = series.withColumn("date", F.to_date("ts")).hint("rebalance", "date")
    dated.write.mode("overwrite").partitionBy("date").parquet(f"{path}/batch={batch}")
