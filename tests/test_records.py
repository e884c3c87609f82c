"""JSON records: bad input, types, defaults."""

from datetime import datetime

from pyspark.sql import functions as F

from feedstream.functions.records import percent, to_json_record
from feedstream.operators.metrics import result_view
from feedstream.operators.parse import decode, flag_corrupt, parse_articles, parse_results
from feedstream.schemas import ARTICLE_SCHEMA, RESULT_SCHEMA

RAW = [
    "not json",
    '{"id": "cut',
    "",
    None,
    '{"id": 5, "time": 1700000000, "score": 0}',
    '{"id": {"a": [1, 2]}, "title": [1, "x"]}',
    '{"id": "a", "published": "dropped", "summary": "dropped"}',
    "{}",
]


def frame(spark):
    return spark.createDataFrame(list(enumerate(RAW)), "n int, json string")


def test_parse_articles(spark):
    parsed = parse_articles(frame(spark), keep=["n"]).orderBy("n").collect()
    assert [r.id for r in parsed] == [None, None, None, None, "5", '{"a":[1,2]}', "a", None]
    assert (parsed[4].time, parsed[4].score) == ("1700000000", "0")
    assert parsed[5].title == '[1,"x"]'
    assert parsed[0].asDict().keys() - {"n"} == set(ARTICLE_SCHEMA.names)


def test_flag_corrupt(spark):
    flagged = flag_corrupt(frame(spark), keep=["n"]).orderBy("n").collect()
    assert [r.n for r in flagged if r.is_corrupt] == [0, 1]
    assert [r.raw for r in flagged if r.is_corrupt] == RAW[:2]
    assert len(flagged) == len(RAW)


def test_decode(spark):
    df = spark.createDataFrame([(bytearray("é{}".encode()),)], "value binary")
    assert decode(df).first().json == "é{}"


def test_to_json_leaves_nulls_out(spark):
    when = datetime(2024, 1, 2, 3, 4, 5, 123456)
    row = ("rss", "1", None, None, None, "neutral", "AI", 3, 20, when)
    df = spark.createDataFrame([row], RESULT_SCHEMA)
    assert df.select(to_json_record()).first()[0] == (
        '{"source":"rss","id":"1","sentiment":"neutral","predicted_category":"AI",'
        '"word_count":3,"text_length":20,"processing_time":"2024-01-02T03:04:05.123Z"}'
    )


def test_view_defaults(spark):
    df = spark.createDataFrame([("{}",), ('{"title": "' + "é" * 150 + '"}',)], "json string")
    first, second = result_view(parse_results(df)).collect()
    assert tuple(first) == (None, "unknown", "No title", "neutral", "uncategorized", "unknown", 0)
    assert second.title == "é" * 100


def test_percent(spark):
    df = spark.createDataFrame([(1, 8), (0, 5), (0, 0)], "p int, w int")
    got = [r[0] for r in df.select(percent(F.col("p"), F.col("w"))).collect()]
    assert got == [12.5, 0.0, 0.0]
