"""Queries over tables of many files in which one value holds a third of all rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from compare import TABLES, compare
from workload import catalog, oracle

QUERIES, SQL = catalog.QUERIES, oracle.ORACLE
CHECKED = [
    "dedup_first_seen", "dedup_unseen", "dedup_ledger", "stream_ingest", "analyze_articles",
    "count_by_source", "kpi_totals", "timeline_minute", "stream_counters", "recent_500",
    "anomaly_zscore", "nearest_category", "cosine_scores", "stream_recent",
]


@pytest.fixture(scope="module")
def skewed(spark, sf_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("skewed"))

    def save(df, name, files):
        df.repartition(files).write.parquet(f"{out}/{name}.parquet")

    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in TABLES}
    documents, events, embeddings = (tables[n] for n in ("documents", "events", "embeddings"))
    far = 10_000_000
    copies = spark.range(documents.count() // 2).select(
        (F.col("id") + far).alias("doc_id"),
        F.lit("The hot news\nof the market").alias("text"),
        F.lit("en").alias("lang"),
        F.lit("src3").alias("source"),
        F.lit(27).cast("bigint").alias("n_chars"),
    )
    clicks = events.where("event_id < 500").withColumns({
        "event_id": F.col("event_id") + far, "event_type": F.lit("click"),
    })
    hot_label = embeddings.where("label = 1").withColumn("vec_id", F.col("vec_id") + far)
    tables["documents"] = documents.unionByName(copies)
    tables["events"] = events.unionByName(clicks)
    tables["embeddings"] = embeddings.unionByName(hot_label)
    for name, df in tables.items():
        save(df, name, 6)
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{out}/{name}.parquet/*.parquet'")
    return out, con


@pytest.mark.parametrize("name", CHECKED)
def test_same_as_sql(spark, skewed, name):
    out, con = skewed
    assert compare(spark, con, out, QUERIES[name], SQL[name]) is None
