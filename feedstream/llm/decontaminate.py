"""Benchmark decontamination: a prefix-filtered set join in DataFrame operations."""

from pyspark.sql import functions as F

from feedstream.llm.common import ascii_lower, keyed, sha256, stored

NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 200_000  # prefix words and item words are broadcast up to this counted number


def words(text):
    """Words of a text: runs of digits, letters a-z and all non-ASCII characters."""
    return F.filter(F.split(ascii_lower(text), NOT_A_WORD), lambda w: w != "")


def bounded(df):
    """df, broadcast if its counted rows are few; a shuffled join otherwise. Same rows either way."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def item_windows(items, size, id_col="item_id", text_col="text"):
    """(window array, items array): the distinct windows of the items. An item of fewer words than
    a window is one window; an item without words has none."""
    found = items.select(F.col(id_col).cast("string").alias("item"),
                         words(F.coalesce(F.col(text_col), F.lit(""))).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return found.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, size))).alias("window")).distinct()


def occurrences(docs, windows, min_share=1.0):
    """(row, start, length, window): places of docs (row, w) whose words agree with a window.

    Words of a window are ordered by rarity in docs. A place that agrees in a share of at least
    min_share holds one of the window's length - ceil(min_share * length) + 1 rarest words at its
    own position, so only these prefix words are joined with the words of docs; the position gives
    the start, which must fit into the document, and the words at that place are then compared.
    """
    tokens = docs.select("row", "w", F.posexplode("w").alias("at", "word"))
    terms = windows.select(F.explode("window").alias("word")).distinct()
    counts = tokens.select("word").join(bounded(terms), "word").groupBy("word").agg(F.count("*").alias("n"))
    rarity = terms.join(counts, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))
    needed = F.greatest(F.ceil(F.size("window") * min_share), F.lit(1)).cast("int")
    prefix = stored(
        windows.select("window", needed.alias("needed"), F.posexplode("window").alias("offset", "word"))
        .join(rarity, "word").groupBy("window", "needed")
        .agg(F.array_sort(F.collect_list(F.struct("n", "offset", "word"))).alias("ranked"))
        .select("window", "needed", F.explode(F.slice(
            "ranked", F.lit(1), F.size("window") - F.col("needed") + 1)).alias("r"))
        .where("r.n > 0 or needed < size(window)")
        .select("window", "needed", "r.word", "r.offset"), "prefix")
    start, length = F.col("at") - F.col("offset"), F.size("window")
    place = F.slice("w", F.greatest(start, F.lit(0)) + 1, length)
    if min_share >= 1:
        agrees = place == F.col("window")
    else:
        equal = F.zip_with(place, "window", lambda a, b: F.when(a == b, 1).otherwise(0))
        agrees = F.aggregate(equal, F.lit(0), lambda n, x: n + x) >= F.col("needed")
    return (
        tokens.join(bounded(prefix), "word")
        .where((start >= 0) & (start + length <= F.size("w"))).where(agrees)
        .select("row", start.alias("start"), length.alias("length"), "window")
    )


def covered(spans):
    """Number of positions in the union of sorted (start, length) spans."""
    def step(acc, s):
        end = s["start"] + s["length"]
        return F.struct(F.greatest(acc["end"], end).alias("end"),
                        (acc["n"] + F.greatest(end - F.greatest(acc["end"], s["start"]), F.lit(0))).alias("n"))

    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(spans, zero, step)["n"]


def decontaminate(docs, items, size=10, min_share=1.0, id_col="doc_id", text_col="text"):
    """(doc_id, rk, n_words, n_hit, items array, contaminated) of every row of docs.

    A word is hit if it lies inside an occurrence of a window of an item; items lists, sorted as
    strings, those with occurring windows. Null or empty texts have no words, on either side. An
    empty items table leaves every document clean. Repeated rows get equal results; an item id
    that is null counts for hits but is not listed. Items with equal windows are all listed.
    """
    rows = stored(
        keyed(docs, id_col, text_col).select(
            "doc_id", "rk", F.monotonically_increasing_id().alias("row"), words(F.col("text")).alias("w")),
        "document-words")
    windows = stored(item_windows(items, size), "windows")
    hits = stored(occurrences(rows, windows.select("window").distinct(), min_share), "hits")
    spans = hits.groupBy("row").agg(F.collect_set(F.struct("start", "length")).alias("spans")).select(
        "row", covered(F.array_sort("spans")).alias("n_hit"))
    named = hits.select("row", "window").distinct().join(windows, "window").groupBy("row").agg(
        F.sort_array(F.collect_set("item")).alias("items"))
    found = spans.join(named, "row")
    return rows.select("doc_id", "rk", "row", F.size("w").cast("long").alias("n_words")).join(
        found, "row", "left"
    ).select(
        "doc_id", "rk", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def op4(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        sha256(F.concat_ws(",", "items")).alias("items_sha256"), "contaminated")


ORACLE_OP4 = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
i AS (
  SELECT item_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, w[s:s + 9] AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM iw),
dw AS (
  SELECT doc_id, s, n, w[s:s + n - 1] AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT dw.doc_id, dw.s, dw.n, iw.item FROM dw JOIN iw ON dw.win = iw.win),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
