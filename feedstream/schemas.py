"""Record schemas shared by sources, operators and sinks."""

from pyspark.sql import types as T


def _strings(*names):
    return [T.StructField(name, T.StringType()) for name in names]


# The field names and their order are those of the records on the topics, of the
# ledger and of the landed feeds and items.

# Everything on the article topic is read as a nullable string; other keys are dropped.
ARTICLE_SCHEMA = T.StructType(_strings(
    "source", "id", "title", "link", "by", "score", "time", "type", "text_combined",
    "category", "fetch_timestamp",
))

RESULT_SCHEMA = T.StructType(
    _strings("source", "id", "title", "link", "by", "sentiment", "predicted_category")
    + [
        T.StructField("word_count", T.IntegerType()),
        T.StructField("text_length", T.IntegerType()),
        T.StructField("processing_time", T.TimestampType()),
    ]
)
RESULT_COLUMNS = RESULT_SCHEMA.names

LEDGER_SCHEMA = T.StructType(
    _strings("id", "source", "title", "link") + [T.StructField("timestamp", T.LongType())]
)

RSS_ITEM_SCHEMA = T.StructType(_strings(
    "guid", "title", "link", "description", "pubDate", "content:encoded", "dc:date",
))

ATOM_ENTRY_SCHEMA = T.StructType(
    _strings("id", "title", "summary", "published", "content", "updated")
    + [T.StructField("link", T.ArrayType(T.StructType(_strings("_href", "_rel"))))]
)

HN_ITEM_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("by", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("time", T.LongType()),
    T.StructField("type", T.StringType()),
])
