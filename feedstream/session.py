"""Session settings and the shared work folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

# Number of shuffle partitions is left to the cluster: AQE coalesces what is too fine.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Lists of so many values still meet the Bloom filters of files (sources.ledger).
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name="feedstream", master=None, **conf):
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark, name):
    """A fresh folder under the shared folder that the cluster names in spark.checkpoint.dir."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="feedstream-")
    return f"{base}/feedstream/{name}-{uuid.uuid4().hex}"
