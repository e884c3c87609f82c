"""Against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cases import documents, empty
from feedstream.llm import components, simhash


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def groups(fps, radius):
    fps = np.array(fps, dtype=np.uint64)
    label = list(range(len(fps)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(fps)):
        for b in np.flatnonzero(np.bitwise_count(fps[a] ^ fps) <= radius):
            x, y = find(a), find(int(b))
            label[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(fps))]


def test_query_against_all_pairs(spark, sf_dir):
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r.doc_id)
    fps = [fingerprint(r.text) for r in docs]
    want = {r.doc_id: (f"{fp:016x}", docs[g].doc_id) for r, fp, g in zip(docs, fps, groups(fps, 4), strict=True)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op9(spark, sf_dir).collect()}
    assert got == want


@pytest.mark.parametrize("tile", [8, 2048])
def test_links_of_close_fingerprints(spark, tile):
    chosen = random.Random(tile)
    base = [chosen.getrandbits(64) for _ in range(6)]
    fps = {0, *base}
    for b in base:
        for _ in range(60):
            x = b
            for bit in chosen.sample(range(64), chosen.randint(1, 6)):
                x ^= 1 << bit
            fps.add(x)
    fps = sorted(fps)
    signed = [fp - (1 << 64) if fp >> 63 else fp for fp in fps]
    points = spark.createDataFrame([(s,) for s in signed], "node long").select(
        "node", F.array("node").alias("fp"), simhash.bit_ranges(F.col("node"), 4).alias("keys"))
    labels = {r.node: r.component for r in components.components(simhash.links(points, 4, tile)).collect()}
    want = groups(fps, 4)
    by_group = {}
    for s, g in zip(signed, want, strict=True):
        by_group.setdefault(g, set()).add(labels.get(s, s))
    assert all(len(found) == 1 for found in by_group.values())
    assert len({min(x) for x in by_group.values()}) == len(by_group)


def test_components_of_chains(spark):
    chosen = random.Random(3)
    nodes = list(range(300))
    chosen.shuffle(nodes)
    edges = [(nodes[i], nodes[i + 1]) for i in range(199)] + [(nodes[i], nodes[200]) for i in range(201, 300)]
    df = spark.createDataFrame(edges + [(1000, 1000), (None, 5)], "a long, b long")
    got = {r.node: r.component for r in components.components(df).collect()}
    assert got == {**dict.fromkeys(nodes[:200], min(nodes[:200])), **dict.fromkeys(nodes[200:], min(nodes[200:]))}
    assert components.components(df.where("a = 1000")).count() == 0


def test_edge_rows(spark):
    docs = documents(spark, ["same text here", "Same TEXT here", "a b"])
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    got = {r.doc_id: (r.fp, r.component_id) for r in rows if r.doc_id}
    assert got[1] == got[2] == got[3] == (0, 1)
    assert {got[i][1] for i in (6, 7, 100, 101)} == {6}
    assert simhash.near_duplicates(empty(spark)).count() == 0
    kept = simhash.similar_texts(docs).collect()
    assert len(kept) == len(rows) and {r.doc_id: r.kept for r in kept}[6] and not {r.doc_id: r.kept for r in kept}[7]
    assert simhash.similar_texts(empty(spark)).count() == 0


def test_near_copies_of_texts(spark):
    chosen = random.Random(9)
    word = lambda: "".join(chosen.choices("abcdefghij", k=6))
    rows, copies = [], set()
    for i in range(60):
        words = [word() for _ in range(300)]
        rows.append((i * 10, " ".join(words)))
        for k in range(1, 4):
            changed = list(words)
            for at in chosen.sample(range(300), k * 2):
                changed[at] = word()
            rows.append((i * 10 + k, " ".join(changed)))
            copies.add(i * 10 + k)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in simhash.similar_texts(docs).where("kept").collect()}
    assert kept >= {i * 10 for i in range(60)} and len(kept & copies) <= 0.03 * len(copies)


def test_similar_texts_against_brute_force(spark):
    chosen = random.Random(12)
    word = lambda: "".join(chosen.choices("abcdefghij", k=6))
    texts = []
    for same in [*range(247, 285), 240, 230] * 3:  # of 300 shingles of both: a similarity of 0.70 to 0.90
        words = [word() for _ in range(304)]
        texts += [words, words[:same + 4] + [word() for _ in range(300 - same)]]
    for _ in range(5):  # a chain whose neighbours have 0.78, and short texts of 4 and 5 shingles
        words = [word() for _ in range(304 + 3 * 37)]
        texts += [words[k * 37:k * 37 + 304] for k in range(4)] + [words[:8], words[:9]]
    sets = [{" ".join(t[k:k + 5]) for k in range(len(t) - 4)} for t in texts]
    root = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            shared = len(sets[a] & sets[b])
            if shared and 5 * shared >= 4 * len(sets[a] | sets[b]):
                root = [root[a] if r == root[b] else r for r in root]
    docs = spark.createDataFrame([(n, " ".join(t)) for n, t in enumerate(texts)], "doc_id long, text string")
    kept = {r.doc_id for r in simhash.similar_texts(docs).where("kept").collect()}
    assert kept == {root.index(r) for r in root}


def test_true_links_of_one_large_cluster(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE_HASHES", 2000)
    chosen = random.Random(13)
    word = lambda: "".join(chosen.choices("abcdefghij", k=6))
    words = [word() for _ in range(104)]
    texts = [words[:4 + same] + [word() for _ in range(100 - same)] for same in [86] * 40 + [91] * 40]
    docs = spark.createDataFrame([(n, " ".join(t)) for n, t in enumerate(texts)], "doc_id long, text string")
    kept = {r.doc_id for r in simhash.similar_texts(docs).where("kept").collect()}
    assert kept == set(range(41))  # 86/114 and 86/(105 + 9) are below 0.8, 91/109 above


def test_first_of_groups(spark):
    chosen = random.Random(4)
    word = lambda: "".join(chosen.choices("abcdefghij", k=6))
    rows = []
    for i in range(20):
        words = [word() for _ in range(2000)]
        rows += [(i * 10 + 5, " ".join(words)), (i * 10 + 2, " ".join(words[:999] + [word()] + words[1000:])), (i * 10, " ".join(words[:1000]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(
        documents(spark, ["same text here"]), allowMissingColumns=True)
    groups_of = {r.rk: r.component_id for r in simhash.near_duplicates(docs).collect()}
    firsts = simhash.first_of_groups(docs).collect()
    kept = [r for r in firsts if r.kept]
    assert len(firsts) == docs.count()
    assert len({groups_of[r.rk] for r in kept}) == len({r.rk for r in kept}) == len(set(groups_of.values()))
    assert {r.doc_id for r in kept} >= {i * 10 for i in range(20)}
    assert simhash.first_of_groups(empty(spark)).count() == 0
