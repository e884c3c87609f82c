"""Properties over random records."""

from hypothesis import HealthCheck, given, settings, strategies as st

from feedstream.functions.text import combine_text, word_count
from feedstream.operators import dedup, metrics
from feedstream.operators.enrich import union_articles
from pyspark.sql import functions as F

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
ids = st.lists(st.one_of(st.none(), st.sampled_from("abcdef")), max_size=40)
views = st.lists(
    st.tuples(st.sampled_from(["rss", "hn"]), st.sampled_from(["positive", "neutral", "negative"]),
              st.sampled_from("ABCDEFG")), min_size=1, max_size=40)
texts = st.lists(st.text(
    st.characters(blacklist_categories=["Cs"], blacklist_characters="\x00")), min_size=1, max_size=30)


@few
@given(ids)
def test_first_seen_is_what_a_loop_would_keep(spark, values):
    seen, want = set(), []
    for i, v in enumerate(values):
        if v is None or v not in seen:
            want.append(i)
            seen.add(v)
    df = spark.createDataFrame(list(enumerate(values)), "ord int, id string").repartition(3)
    once = dedup.first_seen(df, ["ord"])
    assert sorted(r.ord for r in once.collect()) == want
    assert sorted(r.ord for r in dedup.first_seen(once, ["ord"]).collect()) == want


@few
@given(ids, ids)
def test_union_keeps_every_record(spark, left, right):
    a = spark.createDataFrame([(v, 1) for v in left], "id string, published int")
    b = spark.createDataFrame([(v, 1) for v in right], "id string, score int")
    both = union_articles(a, b)
    assert both.count() == len(left) + len(right)
    assert both.columns == ["id", "published", "score"]


@few
@given(views)
def test_shares_sum_to_one_and_lists_are_bounded(spark, rows):
    df = spark.createDataFrame(rows, "source string, sentiment string, category string")
    counts = metrics.counters(df)
    shares = metrics.share(counts, "sentiment").collect()
    assert abs(sum(r.share for r in shares) - 1) < 1e-9
    assert sum(r.n for r in shares) == len(rows)
    kept = metrics.top(counts, n=3).collect()
    by_name = sorted({c: sum(r[2] == c for r in rows) for _, _, c in rows}.items(), key=lambda x: (-x[1], x[0]))
    assert [tuple(r) for r in kept] == by_name[:3][::-1]
    assert metrics.recent(df, ["category"], 5).count() == min(5, len(rows))


@few
@given(texts)
def test_text_functions_are_those_of_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, t string")
    got = df.select("n", word_count(F.col("t")).alias("w"),
                    combine_text(F.col("t"), F.lit("x\n")).alias("c")).orderBy("n").collect()
    assert [r.w for r in got] == [len(v.split(" ")) for v in values]
    assert [r.c for r in got] == [f"{v} x\n".replace("\n", " ").replace("\r", " ").strip() for v in values]
