"""Spelling variants against a plain dictionary of words with one letter left out."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from cases import documents, empty
from feedstream.llm import variants


def plain_counts(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]+", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def plain(n, factor=10):
    shorter, near = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            shorter[w[:i] + "\0" + w[i + 1:]].add(w)
            if (v := w[:i] + w[i + 1:]) in n:
                near[w].add(v)
                near[v].add(w)
    for group in shorter.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, others in near.items():
        if not others:
            continue
        best = min(others, key=lambda v: (-n[v], v))
        if n[best] >= factor * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out)


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


def spelled(spark, words):
    return variants.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long"))


@pytest.mark.parametrize("letters, least, most, parts", [("ab", 1, 9, 8), ("abcé", 3, 8, 40), ("aÿ", 0, 12, 3)])
def test_all_neighbours(spark, letters, least, most, parts):
    chosen = random.Random(most)
    words = {"".join(chosen.choices(letters, k=chosen.randint(least, most))): chosen.choice([1, 2, 11, 20, 115, 2000])
             for _ in range(1500)}
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert got(spelled(spark, words)) == plain(words)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_one_prefix_in_every_word(spark):
    words = {"prefix" * 5 + str(i).translate(str.maketrans("0123456789", "abcdefghij")) + "suffix" * 3: 2 + i % 40 for i in range(3000)}
    assert got(spelled(spark, words)) == plain(words)


def test_very_long_words(spark):
    long = "abcdefghij" * 2_000
    words = {long: 5, long[:10_000] + long[10_001:]: 50, long + "k": 500, "z" + long[1:]: 3, "aaaaaaaa": 2, "aaaaaaa": 30}
    assert got(spelled(spark, words)) == plain(words)


def test_ties_and_chains(spark):
    words = {"colours": 1, "colour": 10, "colou": 100, "colo": 1000, "xolour": 10, "solitary": 4}
    rows = {r[0]: r[1:3] for r in got(spelled(spark, words))}
    assert rows == {"colours": ("colour", "colo"), "colour": ("colou", "colo"), "colou": ("colo", "colo"), "colo": (None, "colo"),
                    "xolour": (None, "xolour"), "solitary": (None, "solitary")}


def test_runs_of_texts(spark):
    texts = [f"Wörters÷{w} {w.upper()} {w}X-{w} été{w}" for w in ("letters", "answers", "ÀÉÎõü×÷ÿ")] * 40
    docs = documents(spark, texts)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(variants.spelling_variants(variants.counted(variants.runs(docs)))) == plain(plain_counts(rows))
    assert got(variants.spelling_variants(variants.counted(variants.runs(empty(spark))))) == []


def test_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert got(variants.op12(spark, sf_dir)) == plain(plain_counts(rows))
