"""Tables that grow by batches, kept in segments that merge as they pile up.

A run (what one checkpoint counts) numbers its batches from 0. Batch b is segment b of level 0; FAN
segments in a row of one level are merged into one of the next. So the first n batches lie in the
segments that the digits of n to base FAN name: a reader opens a number of segments that grows with
the logarithm of the batches. The head of a run, written last, says how many batches are whole; a
reader looks at it once and then opens what it names.

A segment is written into one of 2 * FAN slots of its level in turn. What a batch reads is at most
FAN segments old, so a batch that comes again, also after a failure in the middle of a merge, finds
what it read the first time and writes the same segments once more.
"""

from pyspark.sql import functions as F

FAN = 8
NO_RUN = "none"
HEAD = "run string, batches long, written timestamp"


def run_of(batch_id):
    """The run that a batch belongs to, where streaming.sinks has named it."""
    return getattr(batch_id, "run", NO_RUN)


def covering(batches):
    """(level, number) of the segments that hold the first `batches` batches of a run."""
    found, level = [], 0
    while batches:
        found += [(level, batches - 1 - k) for k in range(batches % FAN)]
        batches, level = batches // FAN, level + 1
    return found


def folder(path, run, level, number):
    return f"{path}/segments/run={run}/level={level}/slot={number % (2 * FAN)}"


def write_plain(rows, to, level):
    rows.write.mode("overwrite").parquet(to)


def append(rows, path, batch_id, merge, read=None, write=write_plain):
    """Write a batch, merge the segments that it completes, and move the head of its run.

    ``merge`` makes the rows of several segments into those of one; ``read(spark, folders, level)``
    and ``write(rows, folder, level)`` may keep merged segments in a form of their own.
    """
    spark, run, number = rows.sparkSession, run_of(batch_id), int(batch_id)
    read = read or _reader(path)
    write(rows, folder(path, run, 0, number), 0)
    done, level = number + 1, 0
    while done % FAN == 0:
        parts = [folder(path, run, level, done - 1 - k) for k in range(FAN)]
        done, level = done // FAN, level + 1
        write(merge(read(spark, parts, level - 1)), folder(path, run, level, done - 1), level)
    write_head(spark, path, run, number + 1)


def read_run(spark, path, run=None, batches=None):
    """Rows of the segments of one run, unmerged: of the run that wrote last, or of the named one and
    its first ``batches`` batches."""
    if batches is None:
        known = heads(spark, path)
        run = run or max(known, key=lambda r: known[r][1])
        batches = known[run][0]
    return _reader(path)(spark, [folder(path, run, *s) for s in covering(batches)], None)


def read_batch(spark, path, batch_id):
    """Rows that append wrote for a batch."""
    return _reader(path)(spark, [folder(path, run_of(batch_id), 0, int(batch_id))], 0)


def heads(spark, path):
    """{run: (number of its whole batches, time of the last)}."""
    table = spark.read.schema(HEAD).parquet(f"{path}/heads/*/*")
    last = table.groupBy("run").agg(F.max("batches").alias("batches"), F.max("written").alias("written"))
    return {r["run"]: (r["batches"], r["written"]) for r in last.collect()}


def write_head(spark, path, run, batches, mode="overwrite"):
    """Two places in turn, so that one is whole at any time."""
    row = spark.range(1).select(
        F.lit(run).alias("run"), F.lit(batches).cast("long").alias("batches"), F.current_timestamp().alias("written"))
    row.coalesce(1).write.mode(mode).parquet(f"{path}/heads/{run}/{batches % 2}")


def _reader(path):
    def read(spark, folders, level):
        return spark.read.option("basePath", f"{path}/segments").parquet(*folders).drop("run", "level", "slot")

    return read
