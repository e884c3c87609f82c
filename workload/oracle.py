"""The registered queries in SQL, over the same tables."""

from feedstream.reference_data import (
    CATEGORIES_MAIN,
    CATEGORIES_OLDER,
    FEED_REGISTRY,
    INGEST_KEYWORDS,
    RESULT_DEFAULTS,
    WHITESPACE,
)
from workload.inputs import LANGUAGES, NEGATIVE, POSITIVE


def lit(value):
    return "'" + value.replace("'", "''") + "'"


def in_list(words):
    return "(" + ", ".join(map(lit, words)) + ")"


def keyword_case(text, default):
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains({text}, {lit(w)})" for w in words) + f" THEN {lit(name)}"
        for name, words in INGEST_KEYWORDS.items()
    )
    return f"CASE {whens} ELSE {default} END"


def feed_values():
    feeds = [(category, url) for category, urls in FEED_REGISTRY.items() for url in urls]
    return ", ".join(f"({i}, {lit(c)}, {lit(u)})" for i, (c, u) in enumerate(feeds))


SPACES = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)

ENTRIES = f"""
raw_entries AS (
  SELECT doc_id AS entry_ord, CAST(regexp_extract(source, '[0-9]+') AS INTEGER) AS feed_ord,
    CASE WHEN lang <> 'es' THEN md5(text) END AS id,
    CASE WHEN source <> 'src0' THEN 'http://x/' || doc_id END AS link,
    split_part(text, chr(10), 1) AS title,
    CASE WHEN contains(text, chr(10)) THEN substr(text, strpos(text, chr(10)) + 1) END AS summary,
    lang AS published
  FROM documents),
feeds(feed_ord, feed_category, feed_url) AS (VALUES {feed_values()}),
entries AS (
  SELECT e.*, coalesce(f.feed_category, 'General') AS feed_category, f.feed_url
  FROM raw_entries e LEFT JOIN feeds f ON e.feed_ord = f.feed_ord),
rss_text AS (
  SELECT *, trim(replace(replace(coalesce(title, '') || ' ' || coalesce(summary, ''),
      chr(10), ' '), chr(13), ' '), {SPACES}) AS text_combined
  FROM entries),
rss AS (
  SELECT entry_ord, 'rss' AS source, coalesce(id, link) AS id, coalesce(title, '') AS title,
    coalesce(link, '') AS link, published, coalesce(summary, '') AS summary, text_combined,
    {keyword_case('lower(text_combined)', 'feed_category')} AS category
  FROM rss_text)"""

ITEMS = f"""
items AS (
  SELECT conv_id * 100 + turn AS id, text AS title,
    CASE WHEN role = 'user' THEN 'http://hn/' || (conv_id * 100 + turn) END AS url,
    CASE WHEN role <> 'system' THEN role END AS "by",
    CASE WHEN role = 'assistant' THEN turn END AS score,
    CASE WHEN turn > 0 THEN conv_id END AS time, 'story' AS type
  FROM conversations),
hn AS (
  SELECT 'hn' AS source, CAST(id AS VARCHAR) AS id, coalesce(title, '') AS title,
    coalesce(url, '') AS link, coalesce("by", '') AS "by", coalesce(score, 0) AS score,
    coalesce(time, 0) AS time, type, coalesce(title, '') AS text_combined,
    {keyword_case("lower(coalesce(title, ''))", "'HN'")} AS category
  FROM items)"""

ARTICLES = f"""{ENTRIES}, {ITEMS},
articles AS (
  SELECT source, id, title, link, published, summary, NULL::VARCHAR AS "by",
    NULL::BIGINT AS score, NULL::BIGINT AS time, NULL::VARCHAR AS type, text_combined, category
  FROM rss
  UNION ALL
  SELECT source, id, title, link, NULL, NULL, "by", score, time, type, text_combined, category
  FROM hn)"""

RESULTS = """
results AS (
  SELECT event_id AS seq, event_type AS source, CAST(event_id AS VARCHAR) AS id,
    CASE WHEN event_type <> 'click' THEN 'event ' || event_id END AS title,
    'http://e/' || event_id AS link,
    CASE WHEN event_type <> 'error' THEN 'u' || user_id END AS "by",
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'positive'
      WHEN event_type = 'error' THEN 'negative'
      WHEN event_type = 'click' THEN 'neutral' END AS sentiment,
    CASE WHEN json_extract_string(props, '$.k') <> '0'
      THEN 'c' || json_extract_string(props, '$.k') END AS predicted_category,
    CASE WHEN event_type <> 'signup' THEN CAST(length(props) AS BIGINT) END AS word_count,
    CAST(length(props) AS BIGINT) AS text_length, ts AS processing_time
  FROM events)"""


def shown(source, extra="", timestamp="processing_time"):
    d = {k: lit(v) if isinstance(v, str) else v for k, v in RESULT_DEFAULTS.items()}
    stamp = f"{timestamp} AS timestamp," if timestamp else ""
    return f"""SELECT {extra} {stamp} coalesce(source, {d['source']}) AS source,
    substr(coalesce(title, {d['title']}), 1, 100) AS title,
    coalesce(sentiment, {d['sentiment']}) AS sentiment,
    coalesce(predicted_category, {d['predicted_category']}) AS category,
    coalesce("by", {d['by']}) AS "by", coalesce(word_count, {d['word_count']}) AS word_count
  FROM {source}"""


VIEW = f"{RESULTS}, view AS ({shown('results', 'seq,')})"


def sentiment_sql(text, source, key):
    return f"""SELECT {key}, CASE WHEN score > 0 THEN 'positive' WHEN score < 0 THEN 'negative'
    ELSE 'neutral' END AS sentiment
  FROM (SELECT {key}, len(list_filter(w, lambda x: x IN {in_list(POSITIVE)}))
      - len(list_filter(w, lambda x: x IN {in_list(NEGATIVE)})) AS score
    FROM (SELECT {key}, string_split_regex(lower({text}), '[^\\p{{L}}]+') AS w FROM {source}))"""


def category_ctes(text, source, key, categories, prefix=""):
    """Term counts as joins: words x keywords, summed per (record, category)."""
    p = prefix
    names = list(categories)
    ords = ", ".join(f"({i}, {lit(name)})" for i, name in enumerate(names))
    words = [
        (i, w) for i, name in enumerate(names) for w in " ".join(categories[name]).split(" ")
    ]
    rows = ", ".join(f"({i}, {lit(w)})" for i, w in words)
    return f"""
{p}cats(ord, category) AS (VALUES {ords}),
{p}label_words(ord, word) AS (VALUES {rows}),
{p}weights AS (SELECT ord, word, count(*) AS weight FROM {p}label_words GROUP BY ALL),
{p}lengths AS (SELECT ord, sqrt(sum(weight * weight)) AS length FROM {p}weights GROUP BY ord),
{p}words AS (SELECT {key},
    unnest(string_split_regex(lower({text}), '[^\\p{{L}}]+')) AS word FROM {source}),
{p}tf AS (SELECT {key}, word, count(*) AS n FROM {p}words
  WHERE word IN (SELECT word FROM {p}weights) GROUP BY ALL),
{p}norms AS (SELECT {key}, sqrt(sum(n * n)) AS norm FROM {p}tf GROUP BY {key}),
{p}dots AS (SELECT {key}, ord, sum(n * weight) AS dot FROM {p}tf JOIN {p}weights USING (word)
  GROUP BY ALL),
{p}ranked AS (SELECT {key}, ord, row_number() OVER (PARTITION BY {key}
    ORDER BY round(dot / (norm * length), 9) DESC, ord) AS place
  FROM {p}dots JOIN {p}norms USING ({key}) JOIN {p}lengths USING (ord)),
{p}best AS (SELECT s.{key}, coalesce(c.category, {lit(names[0])}) AS category
  FROM (SELECT {key} FROM {source}) s
  LEFT JOIN (SELECT * FROM {p}ranked WHERE place = 1) r USING ({key})
  LEFT JOIN {p}cats c USING (ord))"""


def analysis(categories, min_length):
    kept = f"WHERE length(text_combined) > {min_length}" if min_length is not None else ""
    return f"""{ARTICLES},
numbered AS (SELECT *, row_number() OVER () AS rn FROM articles {kept}),
feelings AS ({sentiment_sql('text_combined', 'numbered', 'rn')}),
{category_ctes('text_combined', 'numbered', 'rn', categories)},
analysed AS (SELECT source, id, title, link, "by", sentiment, b.category AS predicted_category,
    CAST(len(string_split(text_combined, ' ')) AS BIGINT) AS word_count,
    CAST(length(text_combined) AS BIGINT) AS text_length,
    a.score, a.time, a.type, a.text_combined, a.category
  FROM numbered a JOIN feelings USING (rn) JOIN best b USING (rn))"""


ANALYSED = analysis(CATEGORIES_MAIN, 10)
ANALYSIS_SELECT = f"""WITH {ANALYSED}
SELECT source, id, title, link, "by", sentiment, predicted_category, word_count, text_length
FROM analysed"""

FIRST_SEEN = f"""{ENTRIES},
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY entry_ord) AS place
  FROM rss) WHERE place = 1 OR id IS NULL),
ledger AS (SELECT md5(text) AS id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))"""

MEANS = """dims AS (SELECT vec_id, label, unnest(embedding) AS x,
    unnest(range(0, len(embedding))) AS dim FROM embeddings),
means AS (SELECT label, dim, avg(CAST(x AS DOUBLE)) AS value FROM dims GROUP BY ALL),
centres AS (SELECT label, list(value ORDER BY dim) AS vector FROM means GROUP BY label)"""

COUNTS = """SELECT source, sentiment, category, count(*) AS n FROM view GROUP BY ALL"""

TIMELINE = """SELECT CAST(date_trunc('minute', timestamp) AS TIMESTAMP) AS minute, sentiment,
  count(*) AS n FROM {source} GROUP BY ALL"""

RECENT = "SELECT * FROM view ORDER BY timestamp DESC, seq DESC LIMIT {n}"

DAILY = """daily AS (SELECT event_type AS key, CAST(date_trunc('day', ts) AS TIMESTAMP) AS win,
  count(*) AS n FROM events GROUP BY ALL)"""

HOURLY = """hourly AS (SELECT event_type AS key, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS win,
  count(*) AS n FROM events GROUP BY ALL)"""

PARSED_SCAN = """SELECT feed_ord::BIGINT AS feed_ord, id, title, link, summary, published
FROM raw_entries"""

MILLIS = "date_trunc('milliseconds', processing_time)"

def id_lists(other):
    """listed (id, pos): places in the lists of roles and of other groups of items."""
    return f"""named AS (
  SELECT id, coalesce("by", 'none') || ' ' || id // 10000 AS list FROM items
  UNION ALL SELECT id, 'of ' || {other} FROM items),
listed AS (SELECT id, row_number() OVER (PARTITION BY list ORDER BY id DESC) - 1 AS pos FROM named)"""


def exact_past(counts, n, interval):
    """past (key, win, n, seen, s, q): sums of the n windows before, in whole numbers."""
    return f"""past AS (
  SELECT a.key, a.win, a.n, count(*) AS seen, sum(b.n)::HUGEINT AS s, sum(b.n::HUGEINT * b.n) AS q
  FROM {counts} a JOIN {counts} b ON a.key = b.key AND b.win < a.win AND b.win >= a.win - {interval}
  GROUP BY ALL),
far AS (
  SELECT *, round(CAST({n} * n - s AS DOUBLE) / sqrt({n} * CAST({n} * q - s * s AS DOUBLE) / {n - 1}), 4) AS z FROM past
  WHERE seen = {n} AND {n} * q - s * s > 0
  AND ({n} * n - s) * ({n} * n - s) * {n - 1} > 4 * {n} * ({n} * q - s * s))"""


ORACLE = {
    "stream_scan": "SELECT event_id, event_type, ts FROM events",
    "results_scan": f"WITH {RESULTS} {shown('results', 'id,', MILLIS)}",
    "rss_xml_scan": f"WITH {ENTRIES} {PARSED_SCAN}",
    "atom_xml_scan": f"WITH {ENTRIES} {PARSED_SCAN}",
    "hn_first_n_ids": f"""WITH {ITEMS}, {id_lists('id // 100')}
SELECT id, pos FROM listed WHERE pos < 200""",
    "hn_item_lookup": f"""WITH {ITEMS}, {id_lists('id // 100')}
SELECT i.*, pos FROM items i JOIN listed USING (id) WHERE i."by" IS NOT NULL AND pos < 200""",
    "parse_article": f"""WITH {ARTICLES}
SELECT source, id, title, link, "by", CAST(score AS VARCHAR) AS score,
  CAST(time AS VARCHAR) AS time, type, text_combined, category, '0' AS fetch_timestamp
FROM articles""",
    "article_json": f"WITH {ARTICLES} SELECT *, 0::BIGINT AS fetch_timestamp FROM articles",
    "corrupt_records": """
SELECT doc_id, CASE WHEN lang <> 'es' THEN 'rss' END AS source,
  CASE WHEN lang <> 'es' THEN CAST(doc_id AS VARCHAR) END AS id, lang = 'es' AS is_corrupt,
  CASE WHEN lang = 'es' THEN text END AS raw FROM documents""",
    "clean_article": f"""WITH {ARTICLES}
SELECT source, id, link, text_combined AS text, lower(text_combined) AS text_lower,
  CAST(len(string_split(text_combined, ' ')) AS BIGINT) AS word_count,
  CAST(length(text_combined) AS BIGINT) AS text_length
FROM articles WHERE length(text_combined) > 10""",
    "rss_enrich": f"WITH {ENTRIES} SELECT * FROM rss",
    "hn_defaults": f"WITH {ITEMS} SELECT * FROM hn",
    "article_union": f"WITH {ARTICLES} SELECT * FROM articles",
    "feed_default_category": f"""WITH {ENTRIES}
SELECT entry_ord, feed_category, feed_url FROM entries""",
    "keyword_category": f"""
SELECT doc_id, {keyword_case('lower(text)', "'General'")} AS category FROM documents""",
    "category_label_text": f"""WITH
{category_ctes('text', 'documents', 'doc_id', CATEGORIES_MAIN)},
labels(category, label) AS (VALUES {", ".join(
    f"({lit(name)}, {lit(' '.join(words))})" for name, words in CATEGORIES_MAIN.items())})
SELECT doc_id, category AS predicted_category, label FROM best JOIN labels USING (category)""",
    "sentiment_lexicon": sentiment_sql("text", "documents", "doc_id"),
    "sentiment_udf": sentiment_sql("text", "documents", "doc_id"),
    "predicted_category": f"""WITH {category_ctes('text', 'documents', 'doc_id', LANGUAGES)}
SELECT doc_id, category AS predicted_category FROM best""",
    "category_array": f"""WITH {category_ctes('text', 'documents', 'doc_id', CATEGORIES_OLDER)}
SELECT doc_id, category AS first_category, 1::BIGINT AS n_categories FROM best""",
    "category_centroids": f"""WITH {MEANS},
sizes AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label)
SELECT CAST(label AS BIGINT) AS category, n, CAST(dim AS BIGINT) AS dim, round(value, 6) AS value
FROM means JOIN sizes USING (label)""",
    "cosine_scores": f"""WITH {MEANS}
SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), vector), 6) AS score
FROM embeddings JOIN centres USING (label)""",
    "nearest_category": f"""WITH {MEANS},
scored AS (SELECT vec_id, c.label, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), vector), 9) AS s
  FROM embeddings CROSS JOIN centres c),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, label) AS place FROM scored)
SELECT vec_id, CAST(label AS BIGINT) AS category, round(s, 6) AS score FROM ranked WHERE place = 1""",
    "argmax_label": """
SELECT vec_id, 'd' || (list_position(embedding, list_max(embedding)) - 1) AS label FROM embeddings""",
    "analyze_articles": ANALYSIS_SELECT,
    "analyze_plugged": ANALYSIS_SELECT,
    "analyze_older": f"""WITH {analysis(CATEGORIES_OLDER, None)}
SELECT source, id, title, link, "by", CAST(score AS VARCHAR) AS score, CAST(time AS VARCHAR) AS time,
  type, text_combined, category, '0' AS fetch_timestamp, text_combined AS text,
  lower(text_combined) AS text_lower, word_count, text_length, sentiment,
  predicted_category AS category_1
FROM analysed""",
    "dedup_first_seen": f"WITH {FIRST_SEEN} SELECT entry_ord, id, title FROM firsts",
    "dedup_unseen": f"""WITH {FIRST_SEEN} SELECT entry_ord, id, title FROM rss
WHERE id IS NULL OR id NOT IN (SELECT id FROM ledger)""",
    "dedup_ledger": f"""WITH {FIRST_SEEN} SELECT entry_ord, id, title FROM firsts
WHERE id IS NULL OR id NOT IN (SELECT id FROM ledger)""",
    "results_json": f"""WITH {RESULTS} SELECT * EXCLUDE (seq) REPLACE ({MILLIS} AS processing_time)
FROM results""",
    "result_defaults": f"WITH {ANALYSED} {shown('analysed', 'id, link,', None)}",
    "kpi_totals": f"""WITH {VIEW} SELECT count(*) AS total,
  count(*) FILTER (sentiment = 'positive') AS positive, count(DISTINCT source) AS sources,
  count(DISTINCT category) AS categories FROM view""",
    "positive_rate": f"""WITH {VIEW},
rate AS (SELECT count(*) FILTER (sentiment = 'positive') * 100.0::DOUBLE / count(*) AS r FROM view)
SELECT round(r, 6) AS positive_rate, round_even(r, 1) AS positive_rate_shown FROM rate""",
    "count_by_source": f"WITH {VIEW} SELECT source, count(*) AS n FROM view GROUP BY source",
    "count_by_sentiment": f"WITH {VIEW} SELECT sentiment, count(*) AS n FROM view GROUP BY sentiment",
    "count_by_category": f"WITH {VIEW} SELECT category, count(*) AS n FROM view GROUP BY category",
    "sentiment_share": f"""WITH {VIEW}
SELECT sentiment, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM view GROUP BY sentiment""",
    "top5_categories": f"""WITH {VIEW}
SELECT category, count(*) AS n FROM view GROUP BY category ORDER BY n DESC, category LIMIT 5""",
    "recent_500": f"WITH {VIEW} {RECENT.format(n=500)}",
    "recent_n": f"""WITH {VIEW}, latest AS ({RECENT.format(n=15)})
SELECT strftime(timestamp, '%H:%M:%S') AS time, source, title, sentiment, category FROM latest""",
    "timeline_minute": f"WITH {VIEW} {TIMELINE.format(source='view')}",
    "timeline_last100": f"""WITH {VIEW}, latest AS ({RECENT.format(n=100)})
{TIMELINE.format(source='latest')}""",
    "stream_counters": f"WITH {VIEW} {COUNTS}",
    "stream_kpi": f"""WITH {VIEW} SELECT count(*) AS total,
  count(*) FILTER (sentiment = 'positive') AS positive, count(DISTINCT source) AS sources,
  count(DISTINCT category) AS categories FROM view""",
    "stream_timeline_last100": f"""WITH {VIEW}, latest AS ({RECENT.format(n=100)})
{TIMELINE.format(source='latest')}""",
    "stream_timeline": f"WITH {VIEW} {TIMELINE.format(source='view')}",
    "stream_timeline_bounded": f"WITH {VIEW} {TIMELINE.format(source='view')}",
    "stream_recent": f"WITH {VIEW} {RECENT.format(n=500)}",
    "stream_ingest": f"WITH {FIRST_SEEN} SELECT entry_ord, id, title FROM firsts",
    "stream_ingest_by_state": f"WITH {FIRST_SEEN} SELECT id FROM firsts",
    "stream_analysis": f"""WITH {ANALYSED}
SELECT source, id, title, link, "by", sentiment, predicted_category, word_count, text_length
FROM analysed WHERE source = 'hn'""",
    "anomaly_zscore": f"WITH {DAILY}, {exact_past('daily', 7, 'INTERVAL 7 DAY')} SELECT key, win, n, z FROM far",
    "anomaly_hourly": f"WITH {HOURLY}, {exact_past('hourly', 5, 'INTERVAL 5 HOUR')} SELECT key, win, n, z FROM far",
    "pattern_alerts_hourly": f"""WITH {HOURLY}
SELECT a.key, a.win, a.n FROM hourly a
JOIN hourly b ON b.key = a.key AND b.win = a.win - INTERVAL 1 HOUR AND b.n > 2
JOIN hourly c ON c.key = a.key AND c.win = a.win - INTERVAL 2 HOUR AND c.n > 2
WHERE a.n > 2""",
    "analyze_embedded": f"""WITH {analysis(LANGUAGES, 10)}
SELECT source, id, title, link, "by", sentiment, predicted_category, word_count, text_length
FROM analysed""",
    "job_ingest": f"""WITH {FIRST_SEEN}, {ITEMS}
SELECT source, id, CASE WHEN id IS NULL THEN title END AS title FROM firsts
UNION ALL SELECT source, id, NULL FROM hn WHERE "by" <> ''""",
    "stream_ingest_many_batches": f"WITH {FIRST_SEEN} SELECT id FROM firsts",
    "job_list_ingest": f"""WITH {ITEMS}, {id_lists('id // 6000')}
SELECT DISTINCT hn.id, hn.title FROM hn JOIN listed ON hn.id = CAST(listed.id AS VARCHAR)
WHERE hn."by" <> '' AND pos < 200""",
    "job_analysis": ANALYSIS_SELECT,
    "job_isolation": f"""WITH {ANALYSED}
SELECT id, CASE WHEN length(text_combined) % 7 <> 0 THEN sentiment END AS sentiment, NULL AS raw,
  CASE WHEN length(text_combined) % 7 = 0 THEN 'ValueError: length' END AS error FROM analysed
UNION ALL SELECT NULL, NULL, 'no JSON ' || doc_id, 'not JSON' FROM documents""",
    "job_progress": """SELECT 'counts' AS query, count(*) AS input_rows, 0 AS failures FROM events
UNION ALL SELECT 'fails', 0, 1""",
    "job_processing_time": f"""WITH {ITEMS}
SELECT source, count(*) AS n, count(*) AS in_order FROM hn WHERE length(title) > 10 GROUP BY source""",
    "job_timeseries": f"""WITH {RESULTS},
landed AS (SELECT * FROM results UNION ALL SELECT * FROM results WHERE source = 'error'),
long AS (
  SELECT processing_time, source, sentiment, 'word_count' AS metric, CAST(word_count AS BIGINT) AS v FROM landed
  UNION ALL SELECT processing_time, source, sentiment, 'text_length', CAST(text_length AS BIGINT) FROM landed),
units(unit) AS (VALUES ('hour'), ('day'))
SELECT unit, CAST(date_trunc(unit, processing_time) AS TIMESTAMP) AS ts, source, sentiment, metric, count(*) AS n,
  CAST(sum(v) AS BIGINT) AS total, min(v) AS least, max(v) AS most
FROM long, units WHERE v IS NOT NULL GROUP BY ALL""",
    "job_view_recent": f"""WITH {VIEW}, latest AS ({RECENT.format(n=15)})
SELECT strftime(timestamp, '%H:%M:%S') AS time, source, title, sentiment, category FROM latest""",
    "job_view_minutes": f"WITH {VIEW} {TIMELINE.format(source='view')}",
    "job_view_categories": f"WITH {VIEW} SELECT category, count(*) AS n FROM view GROUP BY category",
    "job_alerts": f"""WITH {DAILY}, {exact_past('daily', 7, 'INTERVAL 7 DAY')}
SELECT key, win, n, CASE WHEN n > 80 THEN 'high' ELSE 'low' END AS alert FROM daily WHERE n > 80 OR n < 55
UNION ALL SELECT key, win, n, 'anomaly' FROM far
UNION ALL SELECT a.key, a.win, a.n, 'pattern' FROM daily a
JOIN daily b ON b.key = a.key AND b.win = a.win - INTERVAL 1 DAY AND b.n > 66
JOIN daily c ON c.key = a.key AND c.win = a.win - INTERVAL 2 DAY AND c.n > 66
WHERE a.n > 66""",
    "threshold_alerts": f"""WITH {DAILY},
rules(op, threshold, level) AS (VALUES ('>', 80.0::DOUBLE, 'high'), ('<', 55.0::DOUBLE, 'low'))
SELECT key, win, n, level, threshold FROM daily JOIN rules
  ON (op = '>' AND n > threshold) OR (op = '<' AND n < threshold)""",
    "pattern_alerts": f"""WITH {DAILY},
runs AS (SELECT *, sum(CASE WHEN n > 66 THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY win
  ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS breaches FROM daily)
SELECT key, win, n FROM runs WHERE breaches = 3""",
    "timeseries_long": """
SELECT ts, event_type, 'value' AS metric, value FROM events
UNION ALL SELECT ts, event_type, 'user_id', CAST(user_id AS DOUBLE) FROM events""",
}
