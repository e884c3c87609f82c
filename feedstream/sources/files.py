"""Files in any built-in format."""

from pyspark.sql import functions as F


def read_records(spark, path, fmt="parquet", schema=None, streaming=False, **options):
    """A table or a stream of files. ``maxFilesPerTrigger`` bounds a stream's batches."""
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif streaming:
        raise ValueError("a file stream needs its schema")
    return reader.load(path)



def arrival():
    """Where a record of a file stream or table lies: time and path of its file, place in it.
    Records of one place follow each other in the order in which a task reads them."""
    return F.struct(
        F.col("_metadata.file_modification_time").alias("time"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("place"),
    )
