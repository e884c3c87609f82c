"""Stream writers. Every query has its own, explicit checkpoint."""

import json

from feedstream.functions.records import to_json_record
from feedstream.reference_data import CONSOLE_ROWS
from feedstream.sources.ledger import batch_folder

MERGE_KEPT = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"


class BatchId(int):
    """Number of a batch, with the run that counts it: numbers start again with a new checkpoint."""

    def __new__(cls, number, run):
        made = super().__new__(cls, number)
        made.run = run
        return made


def run_id(spark, checkpoint):
    """The id that Spark gave a query when it made the checkpoint, the same over restarts."""
    text = spark.read.text(f"{checkpoint}/metadata", wholetext=True).first().value
    return json.loads(text)["id"]


def with_trigger(writer, every=None, available_now=False):
    """Micro-batches at an interval, once over what is there, or as fast as they come."""
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every) if every else writer


def console_sink(df, checkpoint=None, rows=CONSOLE_ROWS):
    writer = df.writeStream.outputMode("append").format("console")
    writer = writer.option("truncate", False).option("numRows", rows)
    return writer.option("checkpointLocation", checkpoint) if checkpoint else writer


def kafka_sink(df, options, checkpoint):
    """Whole rows as JSON message values, without a key."""
    messages = df.select(to_json_record().alias("value"))
    writer = messages.writeStream.outputMode("append").format("kafka").options(**options)
    return writer.option("checkpointLocation", checkpoint)


def file_sink(df, path, checkpoint, fmt="parquet"):
    writer = df.writeStream.outputMode("append").format(fmt).option("path", path)
    return writer.option("checkpointLocation", checkpoint)


def batch_sink(df, write, checkpoint, mode="append"):
    """``write(batch, batch_id)`` for every micro-batch; a batch can come twice after a failure."""
    known = []

    def write_numbered(batch, batch_id):
        if not known:
            known.append(run_id(batch.sparkSession, checkpoint))
        write(batch, BatchId(batch_id, known[0]))

    writer = df.writeStream.outputMode(mode).foreachBatch(write_numbered)
    return writer.option("checkpointLocation", checkpoint)


def to_all(*writes):
    """One batch to several places: it is read and classified once. Its partitions are merged before they
    are kept, so that it is not written in a file per shuffle partition."""
    def write(batch, batch_id):
        conf = batch.sparkSession.conf
        before = conf.get(MERGE_KEPT)
        conf.set(MERGE_KEPT, "true")
        try:
            batch.persist()
        finally:
            conf.set(MERGE_KEPT, before)
        try:
            for one in writes:
                one(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def batch_files(path, fmt="parquet"):
    """Write of a batch to its own folder of its run, replaced when the batch comes again."""
    def write(batch, batch_id):
        batch.write.mode("overwrite").format(fmt).save(batch_folder(path, batch_id))

    return write


def batch_json_lines(path):
    """Write of a batch as JSON lines, the file form of a message topic."""
    def write(batch, batch_id):
        lines = batch.select(to_json_record().alias("value"))
        lines.write.mode("overwrite").text(batch_folder(path, batch_id))

    return write


def batch_kafka(options):
    """Write of a batch to a topic."""
    def write(batch, batch_id):
        messages = batch.select(to_json_record().alias("value"))
        messages.write.format("kafka").options(**options).save()

    return write


def batch_console(rows=CONSOLE_ROWS):
    def write(batch, batch_id):
        print(f"batch {batch_id}")
        batch.show(rows, truncate=False)

    return write
