"""The training-data pipeline over documents: each stage takes what the one before it kept."""

from pyspark.sql import functions as F

from feedstream.llm.bpe import encode, tokenizer_path
from feedstream.llm.common import marked, sha256, stored
from feedstream.llm.decontaminate import decontaminate
from feedstream.llm.lines import remove_boilerplate
from feedstream.llm.simhash import first_of_groups
from feedstream.llm.toxicity import fitted, score

KEPT_WORDS = 100_000  # fewer than encode alone remembers: the executors still hold what earlier stages took


def drop_toxic(spark, docs, sf_dir):
    """Documents that the chain fitted on the labels of sf_dir does not call toxic."""
    return score(docs, fitted(spark, sf_dir), scores_col="_scores").where("not _scores.toxic").select(*docs.columns)


def drop_boilerplate_lines(spark, docs, sf_dir):
    """All documents, without lines that spread over the sources; n_chars counts what is left."""
    cleaned = remove_boilerplate(docs)
    size = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", size).select(*docs.columns)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group whose fingerprints of four-word shingles are linked at four bits or fewer."""
    return marked(docs, first_of_groups(docs, shingle=4, radius=4).where("kept"), "left_semi")


def drop_contaminated(spark, docs, sf_dir):
    """Documents that hold no ten words in a row of a benchmark item, nor a whole shorter item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return marked(docs, decontaminate(docs, items).where("contaminated"), "left_anti")


def tokenize(spark, docs, sf_dir):
    """(doc_id, source, lang, n_tokens, ids, decoded_sha256): token ids of the whole texts."""
    rows = docs.select("doc_id", "source", "lang", "text")
    return encode(rows, tokenizer_path(), kept_words=KEPT_WORDS, decoded_col="decoded").select(
        "doc_id", "source", "lang", F.size("ids").cast("long").alias("n_tokens"), "ids",
        sha256(F.col("decoded")).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", tokenize),
]
# A fitted classifier and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
