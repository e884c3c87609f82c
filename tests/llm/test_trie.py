"""The prefix trie against a plain dictionary of prefixes, and against SQL."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from compare import compare, connect
from feedstream.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, n string, path string, code string, depth string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA)


def sorted_turns(rows):
    def key(r):
        named = hashlib.sha256(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest()
        return r[1] is not None, r[1] or 0, r[2] or "", named

    own = {}
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return own


def mixed(own):
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    return {c: own.get(c - c % 20, [])[:h[c]] + t[h[c]:] for c, t in own.items()}


def plain(own):
    """Every node by its prefix, from a dictionary of all prefixes."""
    members = {}
    for c, turns in own.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for p, ids in members.items():
        below = [q for q in members if q[:len(p)] == p]
        childless = lambda q: not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in members)
        words = lambda q: len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) if q else 0
        ends = ",".join(str(c) for c in sorted(ids) if len(own[c]) == len(p))
        out.append((
            min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids),
            sum(len(q) == len(p) + 1 for q in below), sum(map(childless, below)),
            sum((len(members[q]) - 1) * words(q) for q in below), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(spark, rows, **options):
    df = trie.prefix_trie(trie.rebuilt(table(spark, rows)), **options).drop("turn")
    return sorted((tuple(r) for r in df.collect()), key=repr)


EDGES = [
    (1, 0, "user", None), (1, None, None, "first of all"), (2, 0, "user", ""), (2, 1, "assistant", "x y z"),
    (3, 0, "user", "same"), (3, 0, "user", "same"), (3, 0, "assistant", "same"), (None, 0, "user", "no id"),
    (-7, 0, "user", "below zero"), (-20, 0, "user", "base of -7"), (-20, 1, "assistant", "second"), (41, 0, "user", "base is absent"),
    (2**40, 0, "user", "word " * 50_000), (4, 5, "1:user", "a"), (5, 5, "1", "user:a")]


def test_edge_rows(spark):
    assert got(spark, EDGES) == plain(mixed(sorted_turns(EDGES)))


@pytest.mark.parametrize("container", [1, 3, 128])
def test_same_as_a_dictionary(spark, container):
    chosen = random.Random(container)
    rows = []
    for c in range(300):
        long = chosen.choice([1, 2, 3, 4, 9])
        rows += [(c, t, chosen.choice(["user", "assistant"]), chosen.choice(["a", "b b", "c  c c"])) for t in range(long)]
    shared = [(t, "user", f"line {t}") for t in range(40)]
    for c in range(1000, 1060):  # many conversations that part late, and copies
        rows += [(c * 20, *x) for x in shared[:chosen.choice([38, 39, 40])]] + [(c * 20, 99, "user", str(c % 7))]
    assert got(spark, rows, container=container) == plain(mixed(sorted_turns(rows)))


def test_hot_copies(spark):
    rows = [(c * 20, t, "user", "the same") for c in range(1500) for t in range(2)]
    assert got(spark, rows) == plain(mixed(sorted_turns(rows)))


def test_empty_and_turnless(spark):
    assert got(spark, []) == []
    alone = [(c, 0, "user", "x") for c in range(21, 40)]  # without a base the first turns are gone
    assert got(spark, alone) == plain(mixed(sorted_turns(alone)))
    assert any(not t for t in mixed(sorted_turns(alone)).values())


def test_turns_of_nodes(spark):
    rows = table(spark, [(20, 0, "user", "a"), (20, 1, "assistant", None), (40, 0, "user", "a")])
    paths = trie.listed(trie.turn_codes(rows), "conv_id").select("conv_id", trie.path_of(F.col("codes")).alias("path"))
    nodes = trie.with_turns(trie.prefix_trie(paths), rows)
    assert {(r.depth, r.role, r.text) for r in nodes.collect()} == {(0, None, None), (1, "user", "a"), (2, "assistant", "")}


def test_same_as_sql(spark, sf_dir):
    assert compare(spark, connect(sf_dir), sf_dir, trie.op13, trie.ORACLE_OP13) is None
