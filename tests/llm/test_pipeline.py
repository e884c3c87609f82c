"""The pipeline on a small table: stages take effect and leave clean documents alone."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from cases import documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def small(spark, sf_dir, tmp_path_factory):
    """Documents of sf0.1 with planted cases, and labels and benchmark beside them."""
    chosen = random.Random(8)
    word = lambda: "".join(chosen.choices("abcdefghijklmnop", k=chosen.randint(3, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    base = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    passage = " ".join(bench.first().text.split()[:14])
    rows = []
    for k in range(10):
        clean = text(2000)  # one changed word of 2,000 turns about two bits
        rows += [(10**6 + k, clean), (2 * 10**6 + k, clean), (3 * 10**6 + k, clean.replace(clean.split()[1000], "changed"))]
        rows += [(4 * 10**6 + k, f"{text(50)} {passage} {text(50)}"), (5 * 10**6 + k, f"{text(40)} idiot scum {text(40)} moron")]
    planted = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", "text", F.lit("en").alias("lang"), F.lit("src1").alias("source"), F.length("text").cast("long").alias("n_chars"))
    out = str(tmp_path_factory.mktemp("pipeline"))
    base.unionByName(planted).write.parquet(f"{out}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet").write.parquet(f"{out}/{name}.parquet")
    return out


def test_planted_cases(spark, small):
    ids = {r.doc_id for r in pipeline.run(spark, small).select("doc_id").collect()}
    assert all(10**6 + k in ids for k in range(10))
    for kind in (2, 3, 4, 5):
        assert not any(kind * 10**6 + k in ids for k in range(10)), kind


def test_stages_keep_the_columns(spark, small):
    docs = documents(spark)
    for name, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, docs, small)
        assert kept.columns == docs.columns, name
        assert {r.doc_id for r in kept.collect()} >= {5, 6}, name
    done = pipeline.STAGES[-1][1](spark, docs, small)
    assert done.count() == docs.count()


def test_empty_documents(spark, small, tmp_path):
    none = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, small).count() == 0


def test_one_python_worker_tokenizes(spark, small):
    """Each Python operator in a row holds a worker of its own per task, beside the executor's heap."""
    done = pipeline.STAGES[-1][1](spark, documents(spark), small)
    assert done._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
