"""Ledger of sent articles, in segments that merge as they pile up.

Merged segments are cut into buckets by a hash of the id and sorted by it, with a Bloom filter of
the hashes in every file, so a batch opens the buckets only that its own ids can lie in. A new
checkpoint is a new run and leaves the entries of the others alone; all runs are one ledger.
"""

from pyspark.sql import functions as F, types as T

from feedstream.schemas import LEDGER_SCHEMA
from feedstream.sources import segments
from feedstream.sources.segments import NO_RUN, run_of

BUCKETS = 64
PROBE = 1_000  # different ids of a batch up to which they are looked up singly, beyond it by bucket
HASH = "h"
ENTRY = T.StructType([*LEDGER_SCHEMA.fields, T.StructField(HASH, T.LongType())])
RUN = T.StructField("run", T.StringType())
BUCKET = T.StructField("bucket", T.IntegerType())
PLACE = [RUN, *[T.StructField(c, T.IntegerType()) for c in ("level", "slot")]]


def batch_folder(path, batch_id):
    return f"{path}/run={run_of(batch_id)}/batch_id={int(batch_id)}"


def id_hash(id="id"):
    return F.xxhash64(F.col(id).cast("string"))


def read_ledger(spark, path, before_batch=None, ids=None):
    """Entries of all batches, or of all but the given one and those after it in its run.

    ``ids`` (id) is a table of ids that are asked for: entries of other ids may then be left out.
    """
    known = {run: batches for run, (batches, _) in segments.heads(spark, path).items()}
    if before_batch is not None:
        known[run_of(before_batch)] = int(before_batch)
    found = [(run, *s) for run, batches in known.items() for s in segments.covering(batches)]
    loose = [segments.folder(path, *s) for s in found if not s[1]]
    cut = [segments.folder(path, *s) for s in found if s[1]]
    entries = _read(path)(spark, loose, 0)
    if not cut:
        return entries
    older = _read(path)(spark, cut, 1)
    return entries.unionByName((older if ids is None else older.where(_asked(ids))).drop("bucket"))


def create_ledger(spark, path):
    """An empty ledger, left alone where one exists."""
    segments.write_head(spark, path, NO_RUN, 0, mode="ignore")


def mark_sent(articles, path, batch_id):
    """Record a batch's articles; those without an id cannot be recognised and are left out.
    The batches of a run come in order, from 0."""
    entries = articles.where(F.col("id").isNotNull()).select(
        "id", "source", "title", "link", F.unix_timestamp().alias("timestamp"), id_hash().alias(HASH))
    segments.append(
        entries, path, batch_id, lambda rows: rows.select(*ENTRY.names), _read(path), _write_segment)


def _bucket():
    return F.pmod(HASH, F.lit(BUCKETS)).cast("int")


def _asked(ids):
    """Condition on merged entries: the hashes of the ids asked for, or the buckets where they are many.
    What comes to the driver is PROBE hashes or BUCKETS numbers at most."""
    hashes = ids.where(F.col("id").isNotNull()).select(id_hash().alias(HASH)).distinct()
    few = [r[HASH] for r in hashes.limit(PROBE + 1).collect()]
    if len(few) <= PROBE:
        return F.col("bucket").isin(sorted({h % BUCKETS for h in few})) & F.col(HASH).isin(few)
    return F.col("bucket").isin([r["bucket"] for r in hashes.select(_bucket().alias("bucket")).distinct().collect()])


def _read(path):
    def read(spark, folders, level):
        schema = T.StructType([*ENTRY.fields, *PLACE, *([BUCKET] if level else [])])
        if not folders:
            return spark.createDataFrame([], schema).drop("level", "slot")
        reader = spark.read.schema(schema).option("basePath", f"{path}/segments")
        return reader.parquet(*folders).drop("level", "slot")

    return read


def _write_segment(entries, folder, level):
    """A merged segment has a folder per bucket, in order of the hash, so that files and their parts
    cover short ranges of it. Large buckets are split."""
    if not level:
        entries.write.mode("overwrite").parquet(folder)
        return
    cut = entries.withColumn("bucket", _bucket()).hint("rebalance", "bucket").sortWithinPartitions("bucket", HASH)
    writer = cut.write.mode("overwrite").partitionBy("bucket").option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.option(f"parquet.bloom.filter.enabled#{HASH}", "true").parquet(folder)
