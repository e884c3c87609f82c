"""Secret scans: patterns, then judged by how many repositories and owners hold the same value."""

from pyspark.sql import functions as F, Window as W

from feedstream.llm.common import sha256, stored

# The patterns, in the order in which kinds are listed, and the least number of
# characters of the group that counts. `value` is the group that holds the secret itself.
KINDS = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
]
# Own addition: long runs with digits, which only ownership tells from identifiers and examples.
TOKEN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}"
MIXED = r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])"
EXAMPLE_OWNERS = 3  # owners from which a value counts as a copied example
PLACEHOLDER = r"(?i)(example|sample|changeme|placeholder|dummy|xxxx|0{8}|1234567)"


def matches(text, kind, pattern, group, least):
    """Matches of a pattern as (kind, gap since the match before, length, value, counts). Gaps and
    matches add up to positions in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    listed = F.transform(
        F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("found"), value.alias("value")),
        lambda m: F.struct(
            F.lit(kind).alias("kind"), F.char_length(m["gap"]).alias("gap"), F.char_length(m["found"]).alias("length"),
            m["value"].alias("value"), (F.char_length(m["value"]) >= least).alias("counts")))
    none = F.array().cast("array<struct<kind:int,gap:int,length:int,value:string,counts:boolean>>")
    return F.when(text.rlike(pattern), F.filter(listed, lambda m: m["value"].isNotNull())).otherwise(none)


def scan(docs, id_col="doc_id", text_col="text", repo=None, owner=None):
    """(rows, spans). rows: row, doc_id of every row of docs. spans: row, kind (position in KINDS,
    len(KINDS) for the token kind), start, end, value, verdict, base, one row per span.

    Base spans are all matches of KINDS, leftmost and not overlapping per kind, of enough
    characters. Every value is counted over distinct repositories and owners of the corpus:
    held by EXAMPLE_OWNERS owners or more, or a placeholder, it is an `example`; held by one owner
    and mixed in its characters it is `live`; else `shared`. The method adds token spans that are
    live and touch no base span; base spans always stay. Null or empty texts hold nothing; null
    repositories and owners count as one each; repeated rows get equal spans; an empty table gives
    no rows.
    """
    repo = F.coalesce(repo if repo is not None else F.col(id_col).cast("string"), F.lit(""))
    owner = F.coalesce(owner if owner is not None else F.col(id_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit(""))
    every = [(k, p, g, n) for k, (_, p, g, n) in enumerate(KINDS)] + [(len(KINDS), TOKEN, 0, 20)]
    rows = stored(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), repo.alias("repo"),
        owner.alias("owner"), F.concat(*[matches(text, *kind) for kind in every]).alias("found")), "matches")
    before = W.partitionBy("row", "kind").orderBy("place")
    end = F.sum(F.col("gap") + F.col("length")).over(before)
    spans = stored(
        rows.where(F.size("found") > 0).select("row", "repo", "owner", F.posexplode("found").alias("place", "m"))
        .select("row", "repo", "owner", "place", "m.*")
        .withColumn("end", end).where("counts").where((F.col("kind") < len(KINDS)) | F.col("value").rlike(MIXED))
        .select("row", "repo", "owner", "kind", (F.col("end") - F.col("length")).alias("start"), "end", "value",
                F.xxhash64("value").alias("hash"), F.char_length("value").alias("size")), "spans")
    held = spans.select("hash", "size", "repo", "owner").distinct()
    spread = stored(held.groupBy("hash", "size").agg(
        F.count_distinct("repo").alias("repos"), F.count_distinct("owner").alias("owners")), "spread")
    example = (F.col("owners") >= EXAMPLE_OWNERS) | F.col("value").rlike(PLACEHOLDER)
    live = (F.col("owners") == 1) & F.col("value").rlike(r"[0-9]") & F.col("value").rlike(r"[A-Za-z]")
    judged = spans.join(spread, ["hash", "size"]).select(
        "row", "kind", "start", "end", "value", "repos", "owners",
        F.when(example, "example").when(live, "live").otherwise("shared").alias("verdict"),
        (F.col("kind") < len(KINDS)).alias("base"))
    return rows.select("row", "doc_id"), judged


def per_document(rows, spans):
    """One row per row of rows: its spans as text, base ones digested, and counts."""
    label = F.element_at(F.array(*[F.lit(k) for k, *_ in KINDS], F.lit("token")), F.col("kind") + 1)
    shown = F.concat_ws(":", label, F.col("start").cast("string"), F.col("end").cast("string"))
    listed = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        "start", "kind", "end", "base", "verdict", shown.alias("shown")))).alias("all"))
    spans_all = F.coalesce("all", F.array().cast(
        "array<struct<start:bigint,kind:int,end:bigint,base:boolean,verdict:string,shown:string>>"))
    base = F.filter("all", lambda s: s["base"])
    added = F.filter("all", lambda s: ~s["base"] & (s["verdict"] == "live") & ~F.exists(
        "base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    joined = rows.join(listed, "row", "left").withColumn("all", spans_all).withColumn("base", base).withColumn(
        "kept", F.array_sort(F.concat("base", added)))

    def count(test):
        return F.size(F.filter("base", test)).cast("long")

    def of_kind(kind):
        return count(lambda s: s["kind"] == kind)

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: s["shown"]), ",")

    return joined.select(
        "doc_id", *[of_kind(k).alias(f"n_{name}") for k, (name, *_) in enumerate(KINDS)],
        sha256(text("base")).alias("base_sha256"), text("kept").alias("spans"),
        count(lambda s: s["verdict"] == "example").alias("n_example"),
        count(lambda s: s["verdict"] == "live").alias("n_live"))


def op2(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows, spans = scan(docs, repo=F.concat_ws("/", "source", "lang"), owner=F.col("source"))
    return per_document(rows, spans)
