"""The given tables in the shapes that the operators read.

Every adapter covers its whole table; conditions only decide which fields a record lacks.
"""

from pyspark.sql import functions as F

from feedstream.operators.enrich import (
    attach_feed,
    enrich_hn,
    enrich_rss,
    feed_registry,
    union_articles,
)
from feedstream.functions.records import to_json_record
from feedstream.reference_data import FEED_REGISTRY
from feedstream.schemas import HN_ITEM_SCHEMA, RESULT_COLUMNS

FEEDS = sum(map(len, FEED_REGISTRY.values()))
BATCH_BYTES = 256 * 2**30
FEED_RECORDS = 25_000  # entries in one feed file at most: a task reads a whole file
PIECE_BYTES = 32 * 2**20  # of stored tables that one file of a copy or topic made of them holds, about
RESULT_BYTES = 4 * 2**20  # the same for events, whose messages are many times as large

# Function words of the tables' four languages, as a lexicon and as categories.
POSITIVE = ["the", "la", "der", "el", "los"]
NEGATIVE = ["of", "le", "und", "de"]
LANGUAGES = {
    "en": ["the", "of", "and"],
    "fr": ["la", "le", "que"],
    "de": ["der", "die", "und"],
    "es": ["el", "los", "de"],
}


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(spark, sf_dir, *names, least=1, of=None):
    """A multiple of ``least``: numbers of files for what is made of the tables, which grow with their stored bytes."""
    stored = sum(
        spark.read.format("binaryFile").load(f"{sf_dir}/{name}.parquet").agg(F.sum("length")).first()[0] or 0
        for name in names)
    return least * max(1, -(-stored // ((of or PIECE_BYTES) * least)))


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def conversations(spark, sf_dir):
    return table(spark, sf_dir, "conversations")


def stream(spark, sf_dir, name):
    """The table as a stream, be it one file or a folder of files, in batches of bounded size."""
    schema = table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", BATCH_BYTES)
    return reader.parquet(f"{sf_dir}/{{{name}.parquet}}")


def as_entries(documents):
    """documents -> feed entries; exact copies share an id, some entries lack id or link."""
    text, first_break = F.col("text"), F.instr("text", "\n")
    return documents.select(
        F.col("doc_id").alias("entry_ord"),
        F.regexp_extract("source", r"(\d+)", 1).cast("int").alias("feed_ord"),
        F.when(F.col("lang") != "es", F.md5(text)).alias("id"),
        F.when(F.col("source") != "src0", F.concat(F.lit("http://x/"), "doc_id")).alias("link"),
        F.substring_index(text, "\n", 1).alias("title"),
        F.when(first_break > 0, F.substr(text, first_break + 1)).alias("summary"),
        F.col("lang").alias("published"),
    )


def entries(spark, sf_dir):
    landed = as_entries(documents(spark, sf_dir))
    return attach_feed(landed, feed_registry(spark), "feed_ord")


def as_items(conversations):
    """conversations -> news items, of which some lack url, by, score or time."""
    role, turn = F.col("role"), F.col("turn")
    id = F.col("conv_id") * 100 + turn
    return conversations.select(
        id.alias("id"),
        F.col("text").alias("title"),
        F.when(role == "user", F.concat(F.lit("http://hn/"), id)).alias("url"),
        F.when(role != "system", role).alias("by"),
        F.when(role == "assistant", turn).alias("score"),
        F.when(turn > 0, F.col("conv_id")).alias("time"),
        F.lit("story").alias("type"),
    )


def items(spark, sf_dir):
    return as_items(conversations(spark, sf_dir))


def item_json(spark, sf_dir):
    """Items as JSON texts; a system turn stands for an id without an item: 'null'."""
    item = F.to_json(F.struct(*HN_ITEM_SCHEMA.names))
    rows = items(spark, sf_dir).withColumn("json", item)
    return rows.select(F.when(F.col("by").isNull(), "null").otherwise(F.col("json")).alias("json"))


def id_lists(spark, sf_dir, short=True):
    """Lists of ids as the endpoint gives them, newest first: for each role one of some 250 ids of a
    hundred conversations, and the short ones of single conversations, or else lists of 60
    conversations that share their ids with those of the roles."""
    conversation = F.floor(F.col("id") / 100)
    role = F.concat_ws(" ", F.coalesce("by", F.lit("none")), F.floor(conversation / 100))
    other = F.concat_ws(" ", F.lit("of"), conversation if short else F.floor(conversation / 60))
    listed = items(spark, sf_dir).select("id", F.explode(F.array(role, other)).alias("list"))
    ids = F.sort_array(F.collect_list("id"), asc=False)
    return listed.groupBy("list").agg(F.to_json(ids).alias("json"))


def articles(spark, sf_dir):
    fetched = F.lit(0)
    rss = enrich_rss(entries(spark, sf_dir), fetched)
    return union_articles(rss, enrich_hn(items(spark, sf_dir), fetched))


def article_json(spark, sf_dir):
    return articles(spark, sf_dir).select(F.to_json(F.struct("*")).alias("json"))


def as_results(events):
    """events -> result records, of which some lack title, sentiment, category, by or count."""
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k")
    return events.select(
        F.col("event_id").alias("seq"),
        kind.alias("source"),
        F.col("event_id").cast("string").alias("id"),
        F.when(kind != "click", F.concat(F.lit("event "), "event_id")).alias("title"),
        F.concat(F.lit("http://e/"), "event_id").alias("link"),
        F.when(kind != "error", F.concat(F.lit("u"), "user_id")).alias("by"),
        F.when(kind.isin("purchase", "signup"), "positive")
        .when(kind == "error", "negative")
        .when(kind == "click", "neutral")
        .alias("sentiment"),
        F.when(k != "0", F.concat(F.lit("c"), k)).alias("predicted_category"),
        F.when(kind != "signup", F.length("props")).alias("word_count"),
        F.length("props").alias("text_length"),
        F.col("ts").cast("timestamp").alias("processing_time"),
    )


def results(spark, sf_dir):
    return as_results(table(spark, sf_dir, "events"))


def ledger(spark, sf_dir):
    """Articles sent before: the labelled documents."""
    labelled = table(spark, sf_dir, "labels").select("doc_id")
    return documents(spark, sf_dir).join(labelled, "doc_id", "left_semi").select(F.md5("text").alias("id"))


def text_topic(spark, sf_dir, lines, path, batches=4):
    """Lines (json) made of documents and conversations as a topic of text files, as a stream of so many batches."""
    files = pieces(spark, sf_dir, "documents", "conversations", least=batches)
    lines.repartition(files).write.text(path)
    reader = spark.readStream.schema("json string").option("maxFilesPerTrigger", files // batches)
    return reader.text(path)


def result_topic(spark, sf_dir, path, files=6, batches=3):
    """The results of events as a topic of JSON messages with their places, in `files` or a multiple of
    it that do not follow the order of the messages; as a stream of so many batches with `_arrival`."""
    files = pieces(spark, sf_dir, "events", least=files, of=RESULT_BYTES)
    place = F.struct(
        F.col("processing_time").alias("timestamp"), F.lit(0).alias("partition"), F.col("seq").alias("offset"))
    messages = results(spark, sf_dir).select(
        to_json_record(*RESULT_COLUMNS).alias("json"), place.alias("_arrival"))
    messages.repartition(files, F.xxhash64("json")).write.parquet(path)
    reader = spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", files // batches)
    return reader.parquet(path)


def landed_feeds(spark, sf_dir, path):
    """Documents as landed feeds, every second one in Atom form, and conversations as items. A feed lies
    in few files whatever the number of partitions of the table, as the files make the batches."""
    parts = pieces(spark, sf_dir, "documents")
    cut = -(-parts // FEEDS)

    def land(rows, row_tag, root_tag, to):
        dealt = rows.repartition(max(parts, FEEDS), "feed_ord", F.pmod(F.xxhash64("title"), F.lit(cut)))
        writer = dealt.write.format("xml").option("rowTag", row_tag).option("rootTag", root_tag)
        writer.option("maxRecordsPerFile", FEED_RECORDS).partitionBy("feed_ord").save(to)

    feeds = as_entries(documents(spark, sf_dir)).withColumn("atom", F.col("feed_ord") % 2 == 1)
    rss = feeds.where("not atom").select(
        "feed_ord", F.col("id").alias("guid"), "title", "link", F.col("summary").alias("description"),
        F.col("published").alias("pubDate"))
    link = F.when(F.col("link").isNotNull(), F.array(F.struct(F.col("link").alias("_href"))))
    atom = feeds.where("atom").select(
        "feed_ord", "id", "title", F.col("summary").alias("content"), F.col("published").alias("updated"),
        link.alias("link"))
    land(rss, "item", "channel", f"{path}/rss")
    land(atom, "entry", "feed", f"{path}/atom")
    item_json(spark, sf_dir).repartition(pieces(spark, sf_dir, "conversations", least=4)).write.text(f"{path}/items")
