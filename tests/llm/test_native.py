"""Decontamination, line de-duplication and chat formatting: against SQL and by hand."""

import json

import pytest
from pyspark.sql import functions as F

from cases import documents, empty
from compare import compare, connect
from feedstream.llm import chat, decontaminate, lines, queries

WORDS = [f"w{i}" for i in range(40)]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_as_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), sf_dir, queries.QUERIES[name], queries.ORACLE[name]) is None


@pytest.mark.parametrize("name", ["op2_secret_scan", "op4_decontaminate", "op6_line_dedup", "op7_chat_format"])
def test_no_python_on_the_main_path(spark, sf_dir, name):
    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def items(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


def test_contaminated_words(spark):
    text = lambda a, b: " ".join(WORDS[a:b])
    docs = documents(spark, [text(0, 12).upper() + ". Rest", text(0, 9), "x " + text(20, 23) + " y", text(5, 20), "Über"])
    rows = decontaminate.decontaminate(docs, items(spark, text(0, 15), text(20, 23), None, "", text(0, 15), "über"))
    got = {r.doc_id: (r.n_words, r.n_hit, r.items) for r in rows.collect() if r.doc_id and r.doc_id >= 100}
    assert got == {
        100: (13, 12, ["0", "4"]), 101: (9, 0, []), 102: (5, 3, ["1"]), 103: (15, 10, ["0", "4"]), 104: (1, 0, [])}
    assert rows.count() == docs.count()
    none = decontaminate.decontaminate(docs, items(spark))
    assert none.where("contaminated").count() == 0 and none.count() == docs.count()
    assert decontaminate.decontaminate(empty(spark), items(spark, "a b")).count() == 0


def test_partial_containment(spark):
    changed = WORDS[:10]
    changed[4] = "other"
    docs = spark.createDataFrame([(1, "a b " + " ".join(changed)), (2, " ".join(WORDS[:10]))], "doc_id long, text string")
    item = items(spark, " ".join(WORDS[:10]))
    hit = lambda share: sorted(r.doc_id for r in decontaminate.decontaminate(
        docs, item, min_share=share).where("contaminated").collect())
    assert hit(1.0) == [2] and hit(0.9) == [1, 2]


def spread(n, line="shared line", first=0):
    return [(first + i, f"{line}\nown {first + i}\n{line}", f"site{i}") for i in range(n)]


def test_lines_of_many_sites(spark):
    rows = spread(10) + spread(9, "rarer", 100) + [(200 + i, "one site", "site0") for i in range(50)]
    rows += [(300, None, "a"), (301, "", "b"), (302, "\n\n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {"n_lines": F.lit("x"), "line": F.lit("y"), "site": F.lit("z")})
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in lines.remove_boilerplate(docs).collect()}
    assert got[0] == ("shared line\nown 0", 3, 1)
    assert got[9] == ("own 9", 3, 2)
    assert got[105] == ("rarer\nown 105\nrarer", 3, 0)
    assert got[200] == ("one site", 1, 0)
    assert (got[300], got[301], got[302]) == ((None, 1, 0), ("", 1, 0), ("\n\n", 3, 0))
    assert lines.remove_boilerplate(empty(spark)).count() == 0
    edge = documents(spark)
    assert lines.remove_boilerplate(edge).count() == edge.count()


def test_sketches_decide_only_clear_cases(spark):
    rows = [(i, "far line", f"s{i}") for i in range(2000)] + [(5000 + i, "near line", f"s{i}") for i in range(99)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    gone = lines.remove_boilerplate(docs, min_sites=100).where("n_removed > 0")
    ids = [r.doc_id for r in gone.collect()]
    assert len(ids) == 1999 and max(ids) < 5000


def turns(spark, *records):
    df = spark.createDataFrame([(i, r if r is None or isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)],
                               "conv_id int, record string").withColumn("layout", F.lit("old"))
    return [(r.layout, [(t.role, t.text) for t in r.turns]) for r in chat.canonical(df).orderBy("conv_id").collect()]


def test_layouts():
    assert len({tuple(sorted(x["paths"])) for x in chat.LAYOUTS.values()}) == len(chat.LAYOUTS)
    assert all(x["paths"] == sorted(x["paths"]) for x in chat.LAYOUTS.values())


def test_canonical_turns(spark):
    got = turns(
        spark,
        {"messages": [{"role": "system", "content": "s"}, {"content": "u", "role": "user"}]},
        {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": None}]},
        {"completion": "c", "prompt": "p"}, {"instruction": "i", "input": "", "output": "o"},
        {"instruction": "i", "input": "n", "output": "o"}, {"instruction": "i", "output": "o"},
        {"role": "user", "content": "x"}, {"other": 1}, None, "not json", {"messages": []})
    assert got == [
        ("messages", [("system", "s"), ("user", "u")]), ("conversations", [("user", "h"), ("assistant", "")]),
        ("prompt", [("user", "p"), ("assistant", "c")]), ("instruction", [("user", "i"), ("assistant", "o")]),
        ("instruction", [("user", "i\nn"), ("assistant", "o")]), ("instruction_only", [("user", "i"), ("assistant", "o")]),
        ("turn", [("user", "x")]), (None, []), (None, []), (None, []), (None, [])]


def test_template_reads_back(spark):
    texts = ["", "\\### Assistant: </turn> ok", "\\l\\b\\\\<>#", "</turn>\n<user>", "日本 😀\n\n", "<assistant>"]
    record = {"messages": [{"role": r, "content": t} for t in texts for r in ("user", "assistant", "a<b>\\")]}
    df = spark.createDataFrame([(1, json.dumps(record))], "conv_id int, record string")
    r = chat.formatted(chat.canonical(df)).select(
        "formatted", chat.read_turns(F.col("formatted")).alias("t"),
        chat.read_loss(F.col("formatted"), F.col("loss")).alias("loss")).first()
    assert [(t.role, t.text) for t in r.t] == [(m["role"], m["content"]) for m in record["messages"]]
    assert r.loss == "".join(texts)
    assert r.formatted.count("</turn>") == len(record["messages"])


def test_conversations_with_gaps(spark, tmp_path):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "a"), (2, 1, "assistant", "b"), (2, 0, None, "c"), (2, 0, None, "c"),
            (3, 0, "system", ""), (None, 0, "user", "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: (r.n_turns, r.loss_chars, r.layout) for r in chat.op7(spark, str(tmp_path)).collect()}
    assert got == {-7: (2, 26, "prompt"), 1: (2, 1, "prompt"), 2: (3, 1, "conversations"), 3: (1, 0, "messages"),
                   None: (1, 0, "conversations")}
