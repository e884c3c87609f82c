"""Against a dictionary of all strings."""

import hashlib
import random
from collections import Counter

import pytest

from cases import documents, empty
from feedstream.llm import suffixes


def brute(texts, length):
    count = Counter()
    for text in texts:
        count.update(text[s:s + length] for s in range(len(text) - length + 1))
    out = []
    for text in texts:
        gone = [False] * len(text)
        for s in range(len(text) - length + 1):
            if count[text[s:s + length]] > 1:
                gone[s:s + length] = [True] * length
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False, *gone], strict=False))
        out.append((len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def found(spark, texts, length=200):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = sorted(suffixes.remove_repeats(docs, length).collect(), key=lambda r: r.doc_id)
    return [(r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in rows]


def texts_with_repeats(seed):
    chosen = random.Random(seed)
    word = lambda: "".join(chosen.choices("abcdeé", k=chosen.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(n) for n in (20, 45, 50, 60, 90, 200)]
    out = ["", "a" * 199, "b" * 200, "c" * 201, "ab" * 300, "x" * 900, text(100)]
    for _ in range(40):
        parts = [text(chosen.randint(0, 60))]
        for _ in range(chosen.randint(0, 3)):
            p = chosen.choice(passages)
            at = chosen.randint(0, 40)
            parts += [p[at:] if chosen.random() < 0.5 else p, text(chosen.randint(0, 30))]
        out.append("".join(parts))
    base = text(150)
    for _ in range(8):
        words = base.split()
        for _ in range(chosen.randint(0, 3)):
            words[chosen.randrange(len(words))] = word()
        out.append(" ".join(words))
    return out + [out[-1], out[-1]]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(spark, seed):
    texts = texts_with_repeats(seed)
    assert found(spark, texts) == brute([t.encode() for t in texts], 200)


def test_blocks_cut_texts(spark, monkeypatch):
    texts = texts_with_repeats(3)
    assert list(suffixes.blocks([b"x" * 5000], 200))[0][1] == [(0, 0, 5000)]
    monkeypatch.setattr(suffixes, "BLOCK", 1024)
    pieces = [p for _, ps in suffixes.blocks([t.encode() for t in texts], 200) for p in ps]
    for row, text in enumerate(texts):
        starts = [s for r, at, size in pieces if r == row for s in range(at, at + size - 199)]
        assert starts == list(range(max(len(text.encode()) - 199, 0)))
    assert found(spark, texts) == brute([t.encode() for t in texts], 200)


def test_edge_rows(spark):
    docs = documents(spark, ["q" * 150])
    rows = suffixes.remove_repeats(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id not in (None, 6)}
    assert (by_id[1].n_bytes, by_id[1].n_removed) == (0, 0)
    assert by_id[4].n_removed == by_id[4].n_bytes == 93000
    assert suffixes.remove_repeats(empty(spark)).count() == 0


def test_repeated_rows_are_copies(spark):
    text = " ".join(map(str, range(200)))
    docs = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert [r.n_removed for r in suffixes.remove_repeats(docs).collect()] == [len(text)] * 2


def test_query(spark, sf_dir):
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r.doc_id)
    want = brute([(r.text or "").encode() for r in docs], 200)
    rows = sorted(suffixes.op3(spark, sf_dir).collect(), key=lambda r: r.doc_id)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows] == want
