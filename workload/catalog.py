"""Registered queries: name -> (spark, sf_dir) -> DataFrame."""

from dataclasses import replace
from datetime import datetime, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from feedstream.functions.categories import label_text
from feedstream.functions.records import to_json_record
from feedstream.functions.vectors import argmax_label as label_of_largest
from feedstream.operators import alerts, classify, dedup, enrich, metrics, parse
from feedstream.operators.clean import clean
from feedstream.plans import ingest, jobs as wired
from feedstream.plans.analysis import OLDER, WHOLE_TEXT, analyze
from feedstream.reference_data import (
    CATEGORIES_OLDER,
    MIN_TEXT_LENGTH,
    RECENT_KEPT,
)
from feedstream.schemas import RESULT_COLUMNS
from feedstream.session import work_dir
from feedstream.sources import feeds
from feedstream.sources.files import read_records
from feedstream.sources.ledger import create_ledger
from feedstream.streaming import jobs, sinks
from feedstream.streaming.monitor import ProgressLog, read_progress
from workload import inputs
from workload.inputs import table

QUERIES = {}
ORDER = ["timestamp", "seq"]


def query(function):
    QUERIES[function.__name__] = function
    return function


def big(*names):
    """The named integer columns as BIGINT, the type they have in the SQL."""
    return {name: F.col(name).cast("bigint") for name in names}


def ntz(name):
    return F.col(name).cast("timestamp_ntz")


def view(spark, sf_dir):
    return metrics.result_view(inputs.results(spark, sf_dir), keep=["seq"])


def counts(spark, sf_dir):
    return metrics.counters(view(spark, sf_dir))


# --- sources ------------------------------------------------------------------------------


def drain(writer):
    """Run a stream over all that is there and wait for its end."""
    jobs.start(writer, available_now=True).awaitTermination()


@query
def stream_scan(spark, sf_dir):
    out = work_dir(spark, "stream_scan")
    events = inputs.stream(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    drain(sinks.file_sink(events, f"{out}/table", f"{out}/checkpoint"))
    return spark.read.schema(events.schema).parquet(f"{out}/table")


@query
def results_scan(spark, sf_dir):
    out = work_dir(spark, "results_scan")
    records = inputs.results(spark, sf_dir).select(to_json_record(*RESULT_COLUMNS))
    records.write.text(f"{out}/topic")
    lines = read_records(spark, f"{out}/topic", "text", "json string", streaming=True)
    shown = metrics.result_view(parse.parse_results(lines, keep=["json"]), keep=["id"])
    shown = shown.withColumn("timestamp", ntz("timestamp")).withColumns(big("word_count"))
    drain(sinks.file_sink(shown, f"{out}/table", f"{out}/checkpoint"))
    return spark.read.schema(shown.schema).parquet(f"{out}/table")


@query
def rss_xml_scan(spark, sf_dir):
    out = work_dir(spark, "rss_xml_scan")
    landed = inputs.as_entries(inputs.documents(spark, sf_dir)).select(
        "feed_ord",
        F.col("id").alias("guid"),
        "title",
        "link",
        F.col("summary").alias("description"),
        F.col("published").alias("pubDate"),
    )
    writer = landed.write.format("xml").option("rowTag", "item").option("rootTag", "channel")
    writer.partitionBy("feed_ord").save(out)
    return feeds.rss_entries(spark, out, ignoreSurroundingSpaces=False).withColumns(
        big("feed_ord")
    )


@query
def atom_xml_scan(spark, sf_dir):
    out = work_dir(spark, "atom_xml_scan")
    link = F.when(F.col("link").isNotNull(), F.array(F.struct(F.col("link").alias("_href"))))
    landed = inputs.as_entries(inputs.documents(spark, sf_dir)).select(
        "feed_ord", "id", "title", "summary", "published", link.alias("link")
    )
    writer = landed.write.format("xml").option("rowTag", "entry").option("rootTag", "feed")
    writer.partitionBy("feed_ord").save(out)
    return feeds.atom_entries(spark, out, ignoreSurroundingSpaces=False).withColumns(
        big("feed_ord")
    )


@query
def hn_first_n_ids(spark, sf_dir):
    lists = enrich.parse_id_lists(inputs.id_lists(spark, sf_dir))
    return enrich.first_ids(lists).withColumns(big("pos"))


@query
def hn_item_lookup(spark, sf_dir):
    out = work_dir(spark, "hn_items")
    inputs.item_json(spark, sf_dir).write.text(out)
    ids = enrich.first_ids(enrich.parse_id_lists(inputs.id_lists(spark, sf_dir)))
    found = enrich.lookup_items(ids, feeds.hn_items(spark, out))
    return found.withColumns(big("pos"))


# --- projections, filters, text -----------------------------------------------------------


@query
def parse_article(spark, sf_dir):
    messages = inputs.article_json(spark, sf_dir).select(F.col("json").cast("binary").alias("value"))
    return parse.parse_articles(parse.decode(messages))


@query
def article_json(spark, sf_dir):
    schema = (
        "source string, id string, title string, link string, published string, "
        "summary string, `by` string, score bigint, time bigint, type string, "
        "text_combined string, category string, fetch_timestamp bigint"
    )
    return parse.parse_json(inputs.article_json(spark, sf_dir), schema)


@query
def corrupt_records(spark, sf_dir):
    record = F.to_json(F.struct(F.lit("rss").alias("source"), F.col("doc_id").alias("id")))
    raw = F.when(F.col("lang") == "es", F.col("text")).otherwise(record)
    lines = inputs.documents(spark, sf_dir).select("doc_id", raw.alias("json"))
    flagged = parse.flag_corrupt(lines, keep=["doc_id"])
    return flagged.select("doc_id", "source", "id", "is_corrupt", "raw")


@query
def clean_article(spark, sf_dir):
    parsed = parse.parse_articles(inputs.article_json(spark, sf_dir))
    cleaned = clean(parsed, MIN_TEXT_LENGTH, processing_time=False)
    return cleaned.select(
        "source", "id", "link", "text", "text_lower", "word_count", "text_length"
    ).withColumns(big("word_count", "text_length"))


@query
def rss_enrich(spark, sf_dir):
    enriched = enrich.enrich_rss(inputs.entries(spark, sf_dir), F.lit(0), keep=["entry_ord"])
    return enriched.drop("fetch_timestamp")


@query
def hn_defaults(spark, sf_dir):
    return enrich.enrich_hn(inputs.items(spark, sf_dir), F.lit(0)).drop("fetch_timestamp")


@query
def article_union(spark, sf_dir):
    return inputs.articles(spark, sf_dir).drop("fetch_timestamp")


@query
def feed_default_category(spark, sf_dir):
    return inputs.entries(spark, sf_dir).select("entry_ord", "feed_category", "feed_url")


@query
def keyword_category(spark, sf_dir):
    documents = inputs.documents(spark, sf_dir).select("doc_id", "text")
    return enrich.tag_category(documents, "text").select("doc_id", "category")


@query
def category_label_text(spark, sf_dir):
    documents = inputs.documents(spark, sf_dir).select("doc_id", "text")
    predicted = classify.classify_words(documents, sentiment=False)
    labels = classify.category_labels(spark).select(
        F.col("category").alias("predicted_category"), label_text(F.col("keywords")).alias("label")
    )
    return predicted.join(labels, "predicted_category").select(
        "doc_id", "predicted_category", "label"
    )


# --- classification -----------------------------------------------------------------------


@query
def sentiment_lexicon(spark, sf_dir):
    documents = inputs.documents(spark, sf_dir).select("doc_id", "text")
    return classify.classify_words(
        documents, positive=inputs.POSITIVE, negative=inputs.NEGATIVE, category=False
    ).select("doc_id", "sentiment")


def word_counters():
    """words -> (texts -> counts of these words, a row per text). Made here so that executors get it
    by value."""
    def word_counter(words):
        import numpy as np
        import regex

        letters = regex.compile(r"\p{L}+")
        place = {word: i for i, word in enumerate(words)}

        def counts(texts):
            cells = [
                row * len(words) + place[word]
                for row, text in enumerate(texts) for word in letters.findall(text.lower()) if word in place
            ]
            return np.bincount(np.array(cells, dtype=np.int64), minlength=len(texts) * len(words)).reshape(
                len(texts), len(words))

        return counts

    return word_counter


def word_list_scorer():
    """A scorer plug-in with the rule of the lexicon: word counts times a matrix of class weights."""
    positive, negative = list(inputs.POSITIVE), list(inputs.NEGATIVE)
    word_counter = word_counters()

    def factory():
        import numpy as np

        counts = word_counter(positive + negative)
        weights = np.array([1] * len(positive) + [-1] * len(negative))

        def score(texts):
            total = counts(texts) @ weights
            return np.column_stack([-total, np.full(len(total), 0.5), total])

        return score

    return factory


@query
def sentiment_udf(spark, sf_dir):
    label = classify.sentiment_udf(word_list_scorer())
    documents = inputs.documents(spark, sf_dir)
    return documents.select("doc_id", label(F.col("text")).alias("sentiment"))


@query
def predicted_category(spark, sf_dir):
    documents = inputs.documents(spark, sf_dir).select("doc_id", "text")
    return classify.classify_words(
        documents, categories=inputs.LANGUAGES, sentiment=False
    ).select("doc_id", "predicted_category")


@query
def category_array(spark, sf_dir):
    documents = inputs.documents(spark, sf_dir).select("doc_id", "text")
    predicted = classify.classify_words(
        documents, categories=CATEGORIES_OLDER, sentiment=False
    ).select("doc_id", F.array("predicted_category").alias("categories"))
    return predicted.select(
        "doc_id",
        F.element_at("categories", 1).alias("first_category"),
        F.size("categories").cast("bigint").alias("n_categories"),
    )


def centroids(spark, sf_dir):
    return classify.category_centroids(table(spark, sf_dir, "embeddings"))


@query
def category_centroids(spark, sf_dir):
    return centroids(spark, sf_dir).select(
        F.col("category").cast("bigint").alias("category"),
        "n",
        F.posexplode("vector").alias("dim", "value"),
    ).withColumns({**big("dim"), "value": F.round("value", 6)})


@query
def cosine_scores(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.col("label").alias("category")
    )
    scored = classify.own_category_score(vectors, centroids(spark, sf_dir))
    return scored.select("vec_id", F.round("score", 6).alias("score"))


@query
def nearest_category(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    categories = centroids(spark, sf_dir).withColumn("ord", F.col("category"))
    nearest = classify.nearest_category(vectors, categories)
    return nearest.select(
        "vec_id",
        F.col("category").cast("bigint").alias("category"),
        F.round("score", 6).alias("score"),
    )


@query
def argmax_label(spark, sf_dir):
    labels = [f"d{i}" for i in range(64)]
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", label_of_largest(F.col("embedding"), labels).alias("label")
    )


def lexicon(variant_of=WHOLE_TEXT, **changes):
    return replace(
        variant_of, positive=tuple(inputs.POSITIVE), negative=tuple(inputs.NEGATIVE), **changes
    )


ANALYSIS = lexicon(processing_time=False)


@query
def analyze_articles(spark, sf_dir):
    parsed = parse.parse_articles(inputs.article_json(spark, sf_dir))
    return analyze(parsed, ANALYSIS).withColumns(big("word_count", "text_length"))


@query
def analyze_older(spark, sf_dir):
    parsed = parse.parse_articles(inputs.article_json(spark, sf_dir))
    analysed = analyze(parsed, lexicon(OLDER))
    flat = analysed.withColumn("category_1", F.element_at("categories", 1)).drop("categories")
    return flat.withColumns(big("word_count", "text_length"))


@query
def analyze_plugged(spark, sf_dir):
    plugged = lexicon(processing_time=False, sentiment=classify.sentiment_udf(word_list_scorer()))
    parsed = parse.parse_articles(inputs.article_json(spark, sf_dir))
    return analyze(parsed, plugged).withColumns(big("word_count", "text_length"))


def language_embedder():
    """An embedder plug-in: counts of the languages' function words."""
    words = sorted({word for words in inputs.LANGUAGES.values() for word in words})
    word_counter = word_counters()

    def factory():
        return word_counter(words)

    return factory


@query
def analyze_embedded(spark, sf_dir):
    category = classify.embedded_category(language_embedder(), inputs.LANGUAGES)
    parsed = parse.parse_articles(inputs.article_json(spark, sf_dir))
    variant = lexicon(processing_time=False, category=category)
    return analyze(parsed, variant).withColumns(big("word_count", "text_length"))


# --- de-duplication -----------------------------------------------------------------------


def rss_articles(spark, sf_dir):
    articles = enrich.enrich_rss(inputs.entries(spark, sf_dir), keep=["entry_ord"])
    return articles.select("entry_ord", "id", "title")


@query
def dedup_first_seen(spark, sf_dir):
    return dedup.first_seen(rss_articles(spark, sf_dir), ["entry_ord"])


@query
def dedup_unseen(spark, sf_dir):
    unsent = dedup.unseen(rss_articles(spark, sf_dir), inputs.ledger(spark, sf_dir))
    return unsent.select("entry_ord", "id", "title")


@query
def dedup_ledger(spark, sf_dir):
    sent = inputs.ledger(spark, sf_dir)
    return dedup.first_unseen(rss_articles(spark, sf_dir), sent, ["entry_ord"])


# --- results: JSON, view, counters --------------------------------------------------------


@query
def results_json(spark, sf_dir):
    lines = inputs.results(spark, sf_dir).select(to_json_record(*RESULT_COLUMNS).alias("json"))
    parsed = parse.parse_results(lines).withColumn("processing_time", ntz("processing_time"))
    return parsed.withColumns(big("word_count", "text_length"))


@query
def result_defaults(spark, sf_dir):
    parsed = parse.parse_articles(inputs.article_json(spark, sf_dir))
    messages = analyze(parsed, ANALYSIS).select(to_json_record().alias("json"))
    shown = metrics.result_view(parse.parse_results(messages), keep=["id", "link"])
    return shown.drop("timestamp").withColumns(big("word_count"))


@query
def kpi_totals(spark, sf_dir):
    totals = metrics.kpi_totals(counts(spark, sf_dir))
    return totals.select("total", "positive", "sources", "categories")


@query
def positive_rate(spark, sf_dir):
    totals = metrics.kpi_totals(counts(spark, sf_dir))
    return totals.select(F.round("positive_rate", 6).alias("positive_rate"), "positive_rate_shown")


@query
def count_by_source(spark, sf_dir):
    return metrics.count_by(view(spark, sf_dir), "source")


@query
def count_by_sentiment(spark, sf_dir):
    return metrics.count_by(view(spark, sf_dir), "sentiment")


@query
def count_by_category(spark, sf_dir):
    return metrics.count_by(view(spark, sf_dir), "category")


@query
def sentiment_share(spark, sf_dir):
    shares = metrics.share(counts(spark, sf_dir), "sentiment")
    return shares.withColumn("share", F.round("share", 6))


@query
def top5_categories(spark, sf_dir):
    return metrics.top(counts(spark, sf_dir))


def newest(spark, sf_dir, n):
    """View of the last n results, cut on the stored columns before any field is derived."""
    events = metrics.recent(table(spark, sf_dir, "events"), ["ts", "event_id"], n)
    return metrics.result_view(inputs.as_results(events), keep=["seq"])


@query
def recent_500(spark, sf_dir):
    kept = newest(spark, sf_dir, RECENT_KEPT)
    return kept.withColumn("timestamp", ntz("timestamp")).withColumns(big("word_count"))


@query
def recent_n(spark, sf_dir):
    return metrics.recent_shown(newest(spark, sf_dir, RECENT_KEPT), ORDER)


@query
def timeline_minute(spark, sf_dir):
    return metrics.timeline(view(spark, sf_dir)).withColumn("minute", ntz("minute"))


@query
def timeline_last100(spark, sf_dir):
    kept = newest(spark, sf_dir, RECENT_KEPT)
    return metrics.timeline_last(kept, ORDER).withColumn("minute", ntz("minute"))


# --- long-running queries, drained over the whole table -----------------------------------


def result_stream(spark, sf_dir):
    records = inputs.as_results(inputs.stream(spark, sf_dir, "events"))
    return metrics.result_view(records, keep=["seq"])


@query
def stream_counters(spark, sf_dir):
    out = work_dir(spark, "stream_counters")
    drain(jobs.running_counters(result_stream(spark, sf_dir), f"{out}/table", f"{out}/checkpoint"))
    return jobs.latest_version(spark, f"{out}/table")


@query
def stream_kpi(spark, sf_dir):
    totals = metrics.kpi_totals(stream_counters(spark, sf_dir))
    return totals.select("total", "positive", "sources", "categories")


@query
def stream_timeline(spark, sf_dir):
    out = work_dir(spark, "stream_timeline")
    drain(jobs.running_timeline(result_stream(spark, sf_dir), f"{out}/table", f"{out}/checkpoint"))
    return jobs.latest_version(spark, f"{out}/table").withColumn("minute", ntz("minute"))


@query
def stream_timeline_bounded(spark, sf_dir):
    """Over several batches, whose records are in no order of time."""
    out = work_dir(spark, "stream_timeline_bounded")
    lines = inputs.result_topic(spark, sf_dir, f"{out}/topic")
    results = metrics.result_view(parse.parse_results(lines))
    drain(jobs.running_timeline_parts(results, f"{out}/table", f"{out}/checkpoint"))
    counted = jobs.merged_counts(spark, f"{out}/table", "minute", "sentiment")
    return counted.withColumn("minute", ntz("minute"))


@query
def stream_recent(spark, sf_dir):
    out = work_dir(spark, "stream_recent")
    results = result_stream(spark, sf_dir)
    drain(jobs.running_recent(results, ORDER, f"{out}/table", f"{out}/checkpoint"))
    newest = jobs.latest_version(spark, f"{out}/table").drop(jobs.ROW)
    return newest.withColumn("timestamp", ntz("timestamp")).withColumns(big("word_count"))


@query
def stream_timeline_last100(spark, sf_dir):
    out = work_dir(spark, "stream_timeline_last100")
    results = result_stream(spark, sf_dir)
    drain(jobs.running_recent(results, ORDER, f"{out}/table", f"{out}/checkpoint"))
    newest = jobs.latest_version(spark, f"{out}/table")
    return metrics.timeline_last(newest, ORDER).withColumn("minute", ntz("minute"))


@query
def stream_ingest(spark, sf_dir):
    out = work_dir(spark, "stream_ingest")
    registry = enrich.feed_registry(spark)
    documents = inputs.as_entries(inputs.stream(spark, sf_dir, "documents"))
    with_feed = enrich.attach_feed(documents, registry, "feed_ord")
    articles = enrich.enrich_rss(with_feed, keep=["entry_ord"])
    create_ledger(spark, f"{out}/ledger")
    publish = sinks.batch_files(f"{out}/topic")
    drain(jobs.ingest(articles, ["entry_ord"], f"{out}/ledger", publish, f"{out}/checkpoint"))
    return spark.read.schema(articles.schema).parquet(f"{out}/topic").select(
        "entry_ord", "id", "title"
    )


@query
def stream_ingest_many_batches(spark, sf_dir):
    """Ids only, over more batches than the ledger keeps unmerged, with copies in different batches."""
    out = work_dir(spark, "stream_ingest_many_batches")
    files = inputs.pieces(spark, sf_dir, "documents", least=18)
    landed = inputs.as_entries(inputs.documents(spark, sf_dir)).repartition(files, F.xxhash64("entry_ord"))
    landed.write.parquet(f"{out}/landed")
    entries = read_records(
        spark, f"{out}/landed", schema=landed.schema, streaming=True, maxFilesPerTrigger=files // 18)
    with_feed = enrich.attach_feed(entries, enrich.feed_registry(spark), "feed_ord")
    articles = enrich.enrich_rss(with_feed, keep=["entry_ord"])
    publish = sinks.batch_files(f"{out}/topic")
    drain(jobs.ingest(articles, ["entry_ord"], f"{out}/ledger", publish, f"{out}/checkpoint"))
    return spark.read.schema(articles.schema).parquet(f"{out}/topic").select("id")


@query
def stream_ingest_by_state(spark, sf_dir):
    """Ids only: which of several copies comes first is up to the files' order."""
    out = work_dir(spark, "stream_ingest_by_state")
    documents = inputs.as_entries(inputs.stream(spark, sf_dir, "documents"))
    articles = documents.select(F.coalesce("id", "link").alias("id"))
    publish = sinks.batch_files(f"{out}/topic")
    drain(jobs.ingest_by_state(articles, publish, f"{out}/checkpoint"))
    return spark.read.schema(articles.schema).parquet(f"{out}/topic").select("id")


@query
def stream_analysis(spark, sf_dir):
    out = work_dir(spark, "stream_analysis")
    items = enrich.enrich_hn(inputs.as_items(inputs.stream(spark, sf_dir, "conversations")))
    messages = items.select(to_json_record().alias("json"))
    analysed = analyze(parse.parse_articles(messages), ANALYSIS)
    both = [sinks.batch_files(f"{out}/table"), sinks.batch_json_lines(f"{out}/topic")]
    drain(jobs.publish_results(analysed, both, f"{out}/checkpoint"))
    topic = read_records(spark, f"{out}/topic", "text", "json string")
    published = parse.parse_results(topic).drop("processing_time")
    return published.withColumns(big("word_count", "text_length"))


# --- anomalies, alerts, time series -------------------------------------------------------


def daily(spark, sf_dir):
    return alerts.windowed_counts(table(spark, sf_dir, "events"), "event_type", "ts")


@query
def anomaly_zscore(spark, sf_dir):
    found = alerts.anomalies(daily(spark, sf_dir))
    return found.select("key", "win", "n", F.round("z", 4).alias("z"))


RULES = [("count", ">", 80.0, "high"), ("count", "<", 55.0, "low")]


@query
def threshold_alerts(spark, sf_dir):
    broken = alerts.threshold_alerts(daily(spark, sf_dir), RULES)
    return broken.select("key", "win", "n", "level", "threshold")


@query
def pattern_alerts(spark, sf_dir):
    found = alerts.pattern_alerts(daily(spark, sf_dir), threshold=66)
    return found.select("key", "win", "n")


def hourly(spark, sf_dir):
    """Hours without an event of a type are missing."""
    return alerts.windowed_counts(table(spark, sf_dir, "events"), "event_type", "ts", "1 hour")


@query
def pattern_alerts_hourly(spark, sf_dir):
    found = alerts.pattern_alerts(hourly(spark, sf_dir), threshold=2, width="1 hour")
    return found.select("key", "win", "n")


@query
def anomaly_hourly(spark, sf_dir):
    found = alerts.anomalies(hourly(spark, sf_dir), history=5, width="1 hour")
    return found.select("key", "win", "n", F.round("z", 4).alias("z"))


@query
def timeseries_long(spark, sf_dir):
    out = work_dir(spark, "timeseries_long")
    events = table(spark, sf_dir, "events")
    series = alerts.time_series(events, "ts", ["event_type"], ["value", "user_id"])
    for _ in range(2):  # a repeated run replaces its own rows
        alerts.write_time_series(series, out, "2024-01")
    stored = spark.read.parquet(out)
    return stored.select("ts", "event_type", "metric", "value")


# --- the shipped jobs, as __main__ wires them, drained over several batches ------------------

ONCE = {"every": None, "available_now": True}


def finish(queries):
    for started in queries if isinstance(queries, list) else [queries]:
        started.awaitTermination()


@query
def job_ingest(spark, sf_dir):
    """RSS, Atom and items; a second run goes on from the ledger with a new checkpoint."""
    out = work_dir(spark, "job_ingest")
    inputs.landed_feeds(spark, sf_dir, out)
    publish = sinks.batch_json_lines(f"{out}/topic")
    for checkpoint in ("first", "second"):
        articles = ingest.articles(
            spark, f"{out}/rss", f"{out}/items", streaming=True, atom_path=f"{out}/atom", maxFilesPerTrigger=5,
            ignoreSurroundingSpaces=False)
        if checkpoint == "second":
            articles = articles.where("id is not null")  # those without an id are sent again
        finish(wired.start_ingest(articles, f"{out}/ledger", publish, f"{out}/{checkpoint}", **ONCE))
    sent = parse.parse_articles(read_records(spark, f"{out}/topic", "text", "json string"))
    return sent.select("source", "id", F.when(F.col("id").isNull(), F.col("title")).alias("title"))


@query
def job_list_ingest(spark, sf_dir):
    """Items that a list names among its first ids; lists and items land in files of any order, and
    most ids are in two lists."""
    out = work_dir(spark, "job_list_ingest")
    inputs.id_lists(spark, sf_dir, short=False).select("json").repartition(3, "json").write.text(f"{out}/lists")
    inputs.item_json(spark, sf_dir).repartition(6).write.text(f"{out}/items")
    articles = ingest.listed_articles(spark, f"{out}/lists", f"{out}/items", maxFilesPerTrigger=2)
    publish = sinks.batch_json_lines(f"{out}/topic")
    finish(wired.start_ingest(articles, f"{out}/ledger", publish, f"{out}/checkpoint", **ONCE))
    return parse.parse_articles(read_records(spark, f"{out}/topic", "text", "json string")).select("id", "title")


@query
def job_analysis(spark, sf_dir):
    out = work_dir(spark, "job_analysis")
    lines = inputs.text_topic(spark, sf_dir, inputs.article_json(spark, sf_dir), f"{out}/topic")
    publish = sinks.batch_json_lines(f"{out}/results")
    finish(wired.start_analysis(lines, publish, f"{out}/checkpoint", lexicon(), show=False, **ONCE))
    results = parse.parse_results(read_records(spark, f"{out}/results", "text", "json string"))
    return results.drop("processing_time").withColumns(big("word_count", "text_length"))


def raising_scorer():
    """The word-list scorer, which fails on every batch that holds a text of a length that 7 divides."""
    inner = word_list_scorer()

    def factory():
        score = inner()

        def checked(texts):
            if any(len(t) % 7 == 0 for t in texts):
                raise ValueError("length")
            return score(texts)

        return checked

    return factory


@query
def job_isolation(spark, sf_dir):
    """Published records and those set aside, with the reason: a model that raises on some texts, and
    records that are no JSON."""
    out = work_dir(spark, "job_isolation")
    good = inputs.article_json(spark, sf_dir)
    broken = inputs.documents(spark, sf_dir).select(F.concat(F.lit("no JSON "), "doc_id").alias("json"))
    lines = inputs.text_topic(spark, sf_dir, good.union(broken), f"{out}/topic")
    variant = replace(lexicon(), sentiment=classify.isolated_sentiment_udf(raising_scorer()))
    finish(wired.start_analysis(
        lines, sinks.batch_json_lines(f"{out}/results"), f"{out}/checkpoint", variant, show=False,
        quarantine=sinks.batch_files(f"{out}/bad"), **ONCE))
    results = parse.parse_results(read_records(spark, f"{out}/results", "text", "json string"))
    bad = spark.read.schema("raw string, error string").parquet(f"{out}/bad")
    no_text = F.lit(None).cast("string")
    return results.select("id", "sentiment", no_text.alias("raw"), no_text.alias("error")).unionByName(bad.select(
        F.get_json_object("raw", "$.id").alias("id"), no_text.alias("sentiment"),
        F.when(F.col("error") == "not JSON", F.col("raw")).alias("raw"), "error"))


@query
def job_progress(spark, sf_dir):
    """Input rows of two queries as their progress reports them, one of which fails."""
    out = work_dir(spark, "job_progress")
    log = ProgressLog(spark, f"{out}/progress")
    spark.streams.addListener(log)
    try:
        results = result_stream(spark, sf_dir)

        def fail(batch, batch_id):
            raise ValueError("no place to write to")

        writers = {"counts": jobs.running_counters(results, f"{out}/table", f"{out}/first"),
                   "fails": sinks.batch_sink(results, fail, f"{out}/second")}
        for name, writer in writers.items():
            started = jobs.start(writer, name=name, available_now=True)
            try:
                started.awaitTermination()
            except StreamingQueryException:
                pass
        if not log.wait(len(writers)):
            raise TimeoutError("the ends of the queries were not reported")
    finally:
        spark.streams.removeListener(log)
    table = read_progress(spark, f"{out}/progress")
    return table.groupBy("query").agg(
        F.sum("input_rows").alias("input_rows"), F.count_if(F.col("error").contains("no place")).alias("failures"))


@query
def job_processing_time(spark, sf_dir):
    """Records per source whose times lie within the run: ingest in seconds, then processing."""
    out = work_dir(spark, "job_processing_time")
    began = F.lit(datetime.now(timezone.utc).replace(microsecond=0))
    items = enrich.enrich_hn(inputs.as_items(inputs.stream(spark, sf_dir, "conversations")))
    analysed = analyze(items, lexicon(), keep=["fetch_timestamp"])
    drain(jobs.publish_results(analysed, [sinks.batch_files(f"{out}/table")], f"{out}/checkpoint"))
    stored = spark.read.parquet(f"{out}/table")
    fetched = F.timestamp_seconds("fetch_timestamp")
    in_order = (fetched >= began) & (fetched <= F.col("processing_time")) & (
        F.col("processing_time") <= F.lit(datetime.now(timezone.utc)))
    return stored.groupBy("source").agg(F.count("*").alias("n"), F.count_if(in_order).alias("in_order"))


def viewed(spark, sf_dir, name):
    out = work_dir(spark, name)
    lines = inputs.result_topic(spark, sf_dir, f"{out}/topic")
    for checkpoint in ("first", "second"):  # a new checkpoint counts anew
        finish(wired.start_view(lines, f"{out}/view", f"{out}/{checkpoint}", "processing_time", **ONCE))
    return wired.read_view(spark, f"{out}/view")


@query
def job_view_recent(spark, sf_dir):
    return viewed(spark, sf_dir, "job_view_recent")["recent"]


@query
def job_view_minutes(spark, sf_dir):
    return viewed(spark, sf_dir, "job_view_minutes")["minutes"].withColumn("minute", ntz("minute"))


@query
def job_view_categories(spark, sf_dir):
    return viewed(spark, sf_dir, "job_view_categories")["by_category"]


@query
def job_alerts(spark, sf_dir):
    out = work_dir(spark, "job_alerts")
    lines = inputs.result_topic(spark, sf_dir, f"{out}/topic")
    for checkpoint in ("first", "second"):  # a new checkpoint counts anew
        finish(wired.start_alerts(
            lines, f"{out}/alerts", f"{out}/{checkpoint}", RULES, threshold=66, width="1 day", **ONCE))
    return wired.read_alerts(spark, f"{out}/alerts").withColumn("win", ntz("win"))


@query
def job_timeseries(spark, sf_dir):
    """Roll-ups by hour and by day, from the minutes of several unordered batches; the first run stops
    and its checkpoint goes on with files that landed late."""
    out = work_dir(spark, "job_timeseries")
    lines = inputs.result_topic(spark, sf_dir, f"{out}/topic")
    late = inputs.results(spark, sf_dir).where("source = 'error'").select(to_json_record(*RESULT_COLUMNS).alias("json"))
    for again in (False, True):
        if again:
            late.write.mode("append").parquet(f"{out}/topic")
        finish(wired.start_series(lines, f"{out}/series", f"{out}/checkpoint", **ONCE))
    tags = ["source", "sentiment"]
    both = [jobs.merged_series(spark, f"{out}/series", unit, *tags).withColumn("unit", F.lit(unit)) for unit in ("hour", "day")]
    return both[0].unionByName(both[1]).select(
        "unit", ntz("ts").alias("ts"), *tags, "metric", "n", *[F.col(c).cast("long").alias(c) for c in ("total", "least", "most")])
