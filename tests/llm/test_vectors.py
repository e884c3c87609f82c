"""Against brute force."""

import numpy as np
import pytest

from feedstream.llm import vectors


def brute(rows, threshold=0.93):
    good = {}
    for n, (_, v, label) in enumerate(rows):
        if label is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v):
            good[n] = np.array(v, dtype=float)
    links = {n: [m for m in good if m != n and rows[m][2] == rows[n][2] and len(good[m]) == len(good[n])
                 and vectors.cosine(good[n], good[m]) >= threshold] if n in good else [] for n in range(len(rows))}
    component = {}
    for n in range(len(rows)):
        seen, todo = {n}, [n]
        while todo:
            for m in links[todo.pop()]:
                if m not in seen:
                    seen.add(m)
                    todo.append(m)
        component[n] = min(rows[m][0] for m in seen)
    return {rows[n][0]: (len(links[n]), component[n], component[n] == rows[n][0]) for n in range(len(rows))}


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def test_close_groups(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD", 100)
    rng = np.random.default_rng(4)
    rows = []
    for label in (0, 1):
        for g in range(40):
            base = rng.normal(size=16)
            for _ in range(int(rng.integers(1, 12))):
                rows.append((len(rows), (base + rng.normal(size=16) * 0.05).tolist(), label))
    rows += [(len(rows) + k, rows[5][1], 0) for k in range(5)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(table(spark, rows)).collect()}
    want = brute(rows)
    assert sum(got[i][0] for i in want) >= 0.97 * sum(w[0] for w in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i] == want[i] for i in want) >= 0.97 * len(want)


def test_rows_that_cannot_link(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, v, 1), (3, v, None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0, 0.0], 1), (7, [1.0, None, 3.0], 1),
            (8, [1.0, float("nan"), 3.0], 1), (9, [float("inf"), 1.0, 1.0], 1), (10, [2.0, 4.0, 6.0], 1), (11, [1.0, 2.0], 1),
            (12, [1e200, 2e200, 3e200], 1), (13, [1e-200, 2e-200, 3e-200], 1), (14, [-1.0, -2.0, -3.0], 1), (15, v, 2)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(table(spark, rows)).collect()}
    linked = {1, 2, 10, 12, 13}
    for i, *_ in rows:
        assert got[i] == ((4, 1, i == 1) if i in linked else (0, i, True)), i
    assert vectors.near_vectors(table(spark, [])).count() == 0


def test_repeated_rows(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1)]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.near_vectors(table(spark, rows)).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 0, 2)]


def test_query(spark, sf_dir):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.op10(spark, sf_dir).collect()}
    assert got == brute(rows)


def test_recall_that_is_not_reached_raises(spark, monkeypatch):
    monkeypatch.setattr(vectors, "found_links", lambda dealt, graph, threshold: dealt.selectExpr(
        "node", "0L as partners", "node as other"))
    rows = [(i, [1.0, 0.001 * i], 1) for i in range(200)]
    with pytest.raises(ValueError, match="recall"):
        vectors.near_vectors(table(spark, rows))


def test_dense_group_over_many_shards(spark, monkeypatch):
    """One group of different near copies, whose links cross all shards: every link is counted."""
    monkeypatch.setattr(vectors, "SHARD", 25)
    rng = np.random.default_rng(6)
    base = rng.normal(size=16)
    rows = [(n, (base + rng.normal(size=16) * 0.2).tolist(), 0) for n in range(600)]
    rows += [(600 + n, rng.normal(size=16).tolist(), 0) for n in range(300)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(table(spark, rows)).collect()}
    want = brute(rows)
    assert sum(w[0] for w in want.values()) > 100_000
    assert got == want


def test_shard_of_many_close_vectors_is_split(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD", 10)
    rng = np.random.default_rng(7)
    rows = [(n, [1.0, *(rng.normal(size=3) * 1e-9).tolist()], 0) for n in range(200)]
    rows += [(200 + n, rng.normal(size=4).tolist(), 0) for n in range(100)]
    monkeypatch.setattr(vectors, "centroids", lambda classes: {"0:4": np.eye(4)})
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(table(spark, rows)).collect()}
    assert got == brute(rows)


def test_links_agree_with_components(spark, monkeypatch):
    """Whatever the shards, members of one pair of linked groups count all links that join them."""
    monkeypatch.setattr(vectors, "SHARD", 15)
    rng = np.random.default_rng(8)
    rows = [(n, (np.eye(8)[n % 4] + rng.normal(size=8) * 0.13).tolist(), 0) for n in range(240)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(table(spark, rows)).collect()}
    assert got == brute(rows)


def test_search_alone_reaches_recall(spark, monkeypatch):
    """Groups that lie apart are found by the graph search, over several shards, without completion."""
    def unused(dealt, threshold):
        raise AssertionError("completed")

    monkeypatch.setattr(vectors, "SHARD", 100)
    monkeypatch.setattr(vectors, "paired_links", unused)
    rng = np.random.default_rng(12)
    rows = []
    for _ in range(60):
        base = rng.normal(size=16)
        rows += [(len(rows) + k, (base + rng.normal(size=16) * 0.04).tolist(), 0) for k in range(int(rng.integers(2, 14)))]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(table(spark, rows)).collect()}
    want = brute(rows)
    assert 0.95 * sum(w[0] for w in want.values()) <= sum(g[0] for g in got.values()) <= sum(w[0] for w in want.values())


def test_graph_is_pruned_and_searched():
    rng = np.random.default_rng(13)
    v = rng.normal(size=(400, 8))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    near = vectors.build_graph(v)
    assert all(a in near[b] for a in range(400) for b in near[a])
    assert sum(map(len, near)) < 400 * 2 * vectors.DEGREE
    near = [np.array(sorted(n)) for n in near]
    hit = true = 0
    for q in range(400):
        got = set(vectors.range_search(q, v, near, 0, 0.8).tolist())
        want = set(np.flatnonzero(v @ v[q] >= 0.8).tolist())
        assert got <= want
        hit, true = hit + len(got), true + len(want)
    assert hit >= 0.95 * true
