"""Line de-duplication by the number of distinct sites a line is found on."""

from pyspark.sql import functions as F

from feedstream.llm.common import sha256, stored

MIN_SITES = 10
LG_K = 12  # sketches of 4096 registers
MARGIN = 0.15  # relative distance from min_sites within which sites are counted exactly


def boilerplate(lines, min_sites=MIN_SITES, margin=MARGIN):
    """(line, first): hashes of the lines found on at least min_sites sites, and where each is first.

    lines: (line hash, site, at). A HyperLogLog sketch of the sites per line decides clear cases;
    lines whose estimate lies within the margin of min_sites get an exact distinct count.
    """
    estimated = stored(
        lines.groupBy("line").agg(
            F.count("*").alias("n"), F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("sites"),
            F.min("at").alias("first"))
        .where((F.col("n") >= min_sites) & (F.col("sites") >= min_sites * (1 - margin))), "line-sites")
    near = estimated.where(F.col("sites") <= min_sites * (1 + margin)).select("line")
    exact = (
        lines.join(near, "line", "left_semi").select("line", "site").distinct()
        .groupBy("line").agg(F.count("*").alias("exact")))
    return estimated.join(exact, "line", "left").where(
        F.coalesce("exact", "sites") >= min_sites).select("line", "first")


def remove_boilerplate(docs, min_sites=MIN_SITES, id_col="doc_id", text_col="text", site_col="source"):
    """docs with the kept lines as text, and n_lines and n_removed: lines found on min_sites or more
    sites go, but for the first place of each in the corpus (by id, then row key and line number),
    so a passage that spreads over the sites stays once.

    Lines are what newlines separate; blank lines stay and never count. A null or empty text is one
    blank line and stays as it is, a null site is a site of its own. Repeated rows keep or lose the
    same lines. Lines are compared by a 64-bit hash and their length. Existing columns n_lines and
    n_removed are replaced. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        *[c for c in docs.columns if c not in ("n_lines", "n_removed")],
        F.xxhash64(F.col(id_col), text).alias("_llm_rk"))
    site = F.coalesce(F.col(site_col).cast("string"), F.lit(""))
    lines = stored(
        docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), text).alias("rk"),
                    site.alias("site"), F.posexplode(F.split(text, "\n", -1)).alias("place", "content"))
        .where(F.trim("content") != "")
        .select(F.struct(F.xxhash64("content").alias("h"), F.octet_length("content").alias("n")).alias("line"),
                "site", F.struct("doc_id", "rk", "place").alias("at")), "lines")
    common = stored(boilerplate(lines, min_sites), "boilerplate")
    drops = (
        lines.select("line", "at").join(common, "line").where(~F.col("at").eqNullSafe(F.col("first")))
        .select(F.col("at.doc_id").alias("_llm_id"), F.col("at.rk").alias("_llm_key"), "at.place").distinct()
        .groupBy("_llm_id", "_llm_key").agg(F.collect_list("place").alias("_llm_drop")))
    joined = rows.join(
        drops.hint("shuffle_hash"),
        rows[id_col].eqNullSafe(drops["_llm_id"]) & (rows["_llm_rk"] == drops["_llm_key"]), "left")
    kept = F.filter(F.split(text, "\n", -1), lambda _, i: ~F.array_contains("_llm_drop", i))
    cleaned = F.when(F.col("_llm_drop").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        *[cleaned.alias(c) if c == text_col else rows[c] for c in rows.columns if c != "_llm_rk"],
        (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("_llm_drop"), F.lit(0)).cast("long").alias("n_removed"))


def op6(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_boilerplate(docs).select(
        "doc_id", "n_lines", "n_removed", F.char_length("text").cast("long").alias("n_chars_kept"),
        sha256(F.col("text")).alias("text_sha256"))


ORACLE_OP6 = r"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents),
common AS (
  SELECT line, min(struct_pack(d := doc_id, p := place)) AS first FROM l
  WHERE trim(line, ' ') <> '' GROUP BY line HAVING count(DISTINCT coalesce(source, '')) >= 10),
j AS (
  SELECT l.doc_id, l.place, l.line,
         common.line IS NOT NULL AND (l.doc_id <> common.first.d OR l.place <> common.first.p) AS gone
  FROM l LEFT JOIN common ON l.line = common.line)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       CAST(length(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS BIGINT) AS n_chars_kept,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS text_sha256
FROM j GROUP BY doc_id
"""
