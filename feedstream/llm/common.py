"""Helpers shared by the operators: stored intermediate tables, row keys, ASCII lower case."""

import string

from pyspark.sql import functions as F

from feedstream.session import work_dir


def stored(df, name):
    """df written to the folder that all executors share and read again, so lineage ends here."""
    spark = df.sparkSession
    path = work_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(docs, id_col="doc_id", text_col="text"):
    """(doc_id, rk, text): rk tells apart rows that share an id. Rows equal in both are one text
    read twice, and every operator gives them the same result. A null text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), text).alias("rk"), text.alias("text")
    )


def marked(docs, decisions, how, id_col="doc_id", text_col="text"):
    """docs semi- or anti-joined with the (doc_id, rk) of decisions; columns stay as they are."""
    key = F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    left = docs.withColumn("_llm_rk", key)
    right = decisions.select(F.col("doc_id").alias("_llm_id"), F.col("rk").alias("_llm_key"))
    found = left[id_col].eqNullSafe(right["_llm_id"]) & (left["_llm_rk"] == right["_llm_key"])
    return left.join(right, found, how).select(*[left[c] for c in docs.columns])


def ascii_lower(text):
    """A-Z to a-z and nothing else; all-ASCII texts take the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def sha256(text):
    return F.sha2(text, 256)
