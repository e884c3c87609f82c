"""Connected components by repeated contraction, as joins and minimum aggregations."""

from pyspark.sql import functions as F

from feedstream.llm.common import stored


def components(edges):
    """(node, component) of every node of edges (a, b); component is the smallest node reachable.

    Each round sends a node to its smallest neighbour and redraws the edges between the targets. On
    groups whose nodes are numbered at random the rounds grow with the logarithm of the input; a chain
    whose nodes ascend along it loses one node a round, so it takes as many rounds as it has links. A
    node with very many neighbours meets only partial minimums and joins whose two sides are
    exchanged tables, which adaptive execution can split. Null ends and loops are ignored.
    """
    def ordered(df):
        return df.where("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        ).distinct()

    left = stored(ordered(edges.select("a", "b")), "edges")
    rounds = []
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        target = stored(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
            .select("node", F.least("node", "m").alias("to")), "targets")
        rounds.append(target)
        of_a = target.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        of_b = target.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        left = stored(ordered(
            left.join(of_a, "a").join(of_b, "b").select(F.col("ta").alias("a"), F.col("tb").alias("b"))
        ), "edges")
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = rounds[0].select("node", F.col("to").alias("component"))
    for target in rounds[1:]:
        step = target.select(F.col("node").alias("component"), "to")
        labels = labels.join(step, "component", "left").select(
            "node", F.coalesce("to", "component").alias("component"))
    return labels


def forest(n, i, j):
    """For each of n places the least place that the links (i, j) reach, in numpy."""
    import numpy as np

    label = np.arange(n)
    while len(i):
        a, b = label[i], label[j]
        open_ = a != b
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]
    return label
