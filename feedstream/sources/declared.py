"""Tables declared in code."""

import pyarrow as pa
from pyspark.sql import types as T


def declared_table(spark, rows, schema):
    """A table of literal rows.

    Spark knows the size of such a local table, so it broadcasts it in joins as long as it is
    below the session's broadcast threshold and shuffles it beyond.
    """
    names = T.StructType.fromDDL(schema).names
    records = pa.Table.from_pylist([dict(zip(names, row)) for row in rows])
    return spark.createDataFrame(records, schema)
