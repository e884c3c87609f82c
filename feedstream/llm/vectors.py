"""Near-duplicate vectors by robust-pruned flat graphs on overlapping shards.

Vectors of a label are dealt to their nearest centroids; each shard builds a graph whose adjacency is
robustly pruned, a vector's lists from its shards are united, and a search runs greedily from the
shard's medoid and then spreads over everything within range. Every link is verified by cosine in
double precision. Recall is audited per label against brute force. Labels where it falls short, such as
dense groups over many shards, are completed: their shards are compared in all pairs that can hold links.
"""

from pyspark.sql import functions as F

from feedstream.llm.common import stored
from feedstream.llm.components import components, forest

SHARD = 1500  # vectors per shard that the number of centroids aims at
MAX_CENTROIDS = 8192  # bounds what is broadcast
CENTROID_SAMPLE = 40  # sampled vectors per centroid, for fitting the centroids
OVERLAP = 2  # shards that a vector is dealt to
DEGREE = 24  # neighbours that pruning leaves
ALPHA = 1.2
BEAM = 24
SLACK = 0.08  # the search spreads over vectors this much below the threshold
BLOCK = 256  # vectors compared with a shard at once
CLOSE = 1e-6  # products of unit vectors this near the threshold are verified
QUERY_STEP = 50  # the audit asks for vectors whose id is divisible by this


def members_of(rows, id_col, vector_col, label_col):
    """(vec_id, node, label, v) of every row. Equal vectors of a label share a node; node is null
    where a vector links with nothing. Vectors of another length count as another label."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    links = F.col(label_col).isNotNull() & F.coalesce(
        finite & F.exists(v, lambda x: x != 0), F.lit(False))
    label = F.concat_ws(":", F.col(label_col).cast("string"), F.size(v).cast("string"))
    return rows.select(
        F.col(id_col).alias("vec_id"), F.when(links, F.xxhash64(label, v)).alias("node"),
        F.when(links, label).alias("label"), F.when(links, v).alias("v"))


def centroids(classes):
    """label -> unit centroids for every label with more vectors than a shard should hold, fitted
    by k-means on CENTROID_SAMPLE sampled vectors per centroid. At most MAX_CENTROIDS in all; where
    more would be needed, shards grow instead."""
    import numpy as np

    total = classes.count()
    shard = max(SHARD, -(-total // MAX_CENTROIDS))
    large = classes.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") > shard).collect()
    want = {r["label"]: -(-r["n"] // shard) for r in large}
    if not want:
        return {}
    parts = classes.sparkSession.createDataFrame(
        [(r["label"], min(1.0, want[r["label"]] * CENTROID_SAMPLE / r["n"])) for r in large], "label string, part double")
    drawn = F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < F.col("part") * (1 << 20)
    sample = classes.join(F.broadcast(parts), "label").where(drawn).select("label", "node", "v")

    def run(pdf):
        import pandas as pd

        label = pdf["label"].iloc[0]
        _, _, v = pack_shard(pdf)
        rng = np.random.default_rng(10)
        k = min(want[label], len(v))
        c = v[rng.choice(len(v), k, replace=False)]
        for _ in range(8):
            total, size = np.zeros_like(c), np.zeros(k)
            for at in range(0, len(v), BLOCK):
                near = (v[at:at + BLOCK] @ c.T).argmax(axis=1)
                np.add.at(total, near, v[at:at + BLOCK])
                np.add.at(size, near, 1)
            c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], c)
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        return pd.DataFrame({"label": label, "c": list(c)})

    found = {}
    for r in sample.groupBy("label").applyInPandas(run, "label string, c array<double>").collect():
        found.setdefault(r["label"], []).append(r["c"])
    return {label: np.array(c) for label, c in found.items()}


def by_centroid(batch, centers):
    """(places, unit centroids or None, unit vectors) of at most BLOCK vectors of one label each."""
    import numpy as np

    label = np.array(batch.column("label").to_pylist(), dtype=object)
    for name in dict.fromkeys(label):
        whole = np.flatnonzero(label == name)
        for at in range(0, len(whole), BLOCK):
            places = whole[at:at + BLOCK]
            raw = even(batch.column("v").take(places).flatten().to_numpy().reshape(len(places), -1))
            yield places, name, centers.get(name), raw / np.linalg.norm(raw, axis=1, keepdims=True)


def apart(u, c):
    import numpy as np

    return np.sqrt(np.maximum((u * u).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None] - 2 * u @ c.T, 0))


def nearest(u, c, overlap):
    """The places of the `overlap` nearest centroids of each vector, nearest first."""
    import numpy as np

    sims = u @ c.T
    if overlap == 1:
        return sims.argmax(axis=1)[:, None]
    some = np.argpartition(-sims, min(overlap, len(c)) - 1, axis=1)[:, :overlap]
    return np.take_along_axis(some, np.argsort(-np.take_along_axis(sims, some, axis=1), axis=1, kind="stable"), axis=1)


def extents(classes, centers, overlap=1):
    """label -> (first shard, number of shards, radius) of each centroid, where a vector belongs to
    its `overlap` nearest: vectors of a centroid with more than two shards should hold, times the
    overlap, are dealt to several by hash."""
    import numpy as np

    shared = classes.sparkSession.sparkContext.broadcast(centers)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for _, name, c, u in by_centroid(batch, shared.value):
                if c is not None:
                    near = nearest(u, c, overlap)
                    far = np.take_along_axis(apart(u, c), near, axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * near.size), pa.array(near.ravel(), pa.int64()), pa.array(far.ravel())],
                        ["label", "centroid", "far"])

    rows = classes.select("label", "v").mapInArrow(run, "label string, centroid long, far double").groupBy(
        "label", "centroid").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect() if centers else []
    found = {label: (np.zeros(len(c), dtype=np.int64), np.ones(len(c), dtype=np.int64), np.full(len(c), -np.inf))
             for label, c in centers.items()}
    for r in rows:
        _, count, radius = found[r["label"]]
        count[r["centroid"]], radius[r["centroid"]] = -(-r["n"] // (2 * SHARD * overlap)), r["far"]
    for first, count, _ in found.values():
        first[1:] = count.cumsum()[:-1]
    return found


def overlapping(classes, centers, overlap=OVERLAP):
    """(label, shard, node, members, home, every, v): every class in a shard of each of its nearest
    centroids, `overlap` of them, listed in every; home marks the nearest. A label without centroids
    is one shard."""
    shared = classes.sparkSession.sparkContext.broadcast((centers, extents(classes, centers, overlap)))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            nodes = batch.column("node").to_numpy()
            for places, name, c, u in by_centroid(batch, shared.value[0]):
                every = np.zeros((len(u), 1), np.int64)
                if c is not None:
                    first, count, _ = shared.value[1][name]
                    near = nearest(u, c, overlap)
                    salt = nodes[places].view(np.uint64)[:, None] % count[near].astype(np.uint64)
                    every = first[near] + salt.astype(np.int64)
                width = every.shape[1]
                where = pa.array(np.repeat(places, width))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(every.size + 1) * width, pa.int32()), pa.array(np.repeat(every, width, axis=0).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").take(where), pa.array(every.ravel()), batch.column("node").take(where),
                     batch.column("members").take(where), pa.array(np.arange(every.size) % width == 0), lists,
                     batch.column("v").take(where)],
                    ["label", "shard", "node", "members", "home", "every", "v"])

    return classes.select("label", "node", "members", "v").mapInArrow(
        run, "label string, shard long, node long, members long, home boolean, every array<long>, v array<double>")


def distance(sims):
    import numpy as np

    return np.sqrt(np.maximum(2 - 2 * sims, 0))


def prune(order, sims, v):
    """Robust pruning of candidates in order of nearness: the nearest one stays and drops those
    that are clearly nearer to it."""
    kept = []
    while len(order) and len(kept) < DEGREE:
        best = order[0]
        kept.append(int(best))
        order = order[1:]
        order = order[distance(sims[order]) <= ALPHA * distance(v[order] @ v[best])]
    return kept


def build_graph(v):
    """Adjacency lists of one shard: candidates by similarity, robustly pruned, edges both ways."""
    import numpy as np

    near = [set() for _ in range(len(v))]
    width = min(len(v) - 1, 3 * DEGREE)
    for at in range(0, len(v) if width else 0, BLOCK):
        sims = v[at:at + BLOCK] @ v.T
        sims[np.arange(len(sims)), at + np.arange(len(sims))] = -2
        top = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        for r in range(len(sims)):
            order = top[r][np.argsort(-sims[r, top[r]], kind="stable")]
            for other in prune(order, sims[r], v):
                near[at + r].add(other)
                near[other].add(at + r)
    return near


def adjacency(dealt):
    """(label, node, near): a class's lists of neighbours from its shards, united."""
    def run(pdf):
        import pandas as pd

        pdf, _, v = pack_shard(pdf)
        nodes = pdf["node"].to_numpy()
        near = [nodes[sorted(n)] for n in build_graph(v)]
        return pd.DataFrame({"label": pdf["label"].iloc[0], "node": nodes, "near": near})

    lists = dealt.groupBy("label", "shard").applyInPandas(run, "label string, node long, near array<long>")
    return lists.groupBy("label", "node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def range_search(own, v, near, start, threshold):
    """Places within the threshold of the vector at the place own: greedy search from start with a
    beam, then, step by step from what it saw and from own, over all neighbours of what lies within
    the threshold less the slack."""
    import heapq

    import numpy as np

    query = v[own]
    first = float(v[start] @ query)
    sims = np.full(len(v), -np.inf)
    sims[start] = first
    best, heap = [(first, start)], [(-first, start)]
    while heap:
        s, at = heapq.heappop(heap)
        if len(best) >= BEAM and -s < best[0][0]:
            break
        fresh = near[at][sims[near[at]] == -np.inf]
        sims[fresh] = v[fresh] @ query
        for n, sim in zip(fresh.tolist(), sims[fresh].tolist(), strict=True):
            if len(best) < BEAM or sim > best[0][0]:
                heapq.heappush(heap, (-sim, n))
                (heapq.heappush if len(best) < BEAM else heapq.heapreplace)(best, (sim, n))
    sims[own] = 1
    frontier = np.flatnonzero(sims >= threshold - SLACK)
    while len(frontier):
        fresh = np.concatenate([near[n] for n in frontier])
        fresh = np.unique(fresh[sims[fresh] == -np.inf])
        sims[fresh] = v[fresh] @ query
        frontier = fresh[sims[fresh] >= threshold - SLACK]
    return np.flatnonzero(sims >= threshold - CLOSE)


def shards(classes, centers, threshold):
    """(label, shard, with, node, members, home, v): every class in the pair of its own shard with
    itself (home) and in every pair, in order, of its own shard and another that can hold links of
    it. Two linked classes meet in the pair of their shards and nowhere else. A label without
    centroids is one shard.
    """
    shared = classes.sparkSession.sparkContext.broadcast((centers, extents(classes, centers)))
    reach = (2 - 2 * threshold) ** 0.5 + 1e-6

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            nodes = batch.column("node").to_numpy()
            for places, name, c, u in by_centroid(batch, shared.value[0]):
                if c is None:
                    row, own, other = np.arange(len(u)), np.zeros(len(u), np.int64), np.zeros(len(u), np.int64)
                else:
                    first, count, radius = shared.value[1][name]
                    sims = u @ c.T
                    near = sims.argmax(axis=1)
                    margin = sims[np.arange(len(u)), near][:, None] - sims
                    meets = (margin <= reach * apart(c[near], c) + 1e-6) & (apart(u, c) <= radius + reach)
                    meets[np.arange(len(u)), near] = True
                    row, other = np.nonzero(meets)
                    salt = nodes[places].view(np.uint64) % count[near].astype(np.uint64)
                    own = (first[near] + salt.astype(np.int64))[row]
                    times = count[other]
                    step = np.arange(times.sum()) - np.repeat(times.cumsum() - times, times)
                    row, own, other = np.repeat(row, times), np.repeat(own, times), np.repeat(first[other], times) + step
                where = pa.array(places[row])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").take(where), pa.array(np.minimum(own, other)), pa.array(np.maximum(own, other)),
                     batch.column("node").take(where), batch.column("members").take(where), pa.array(own == other),
                     pa.array(own > other), batch.column("v").take(where)],
                    ["label", "shard", "with", "node", "members", "home", "second", "v"])

    return classes.select("label", "node", "members", "v").mapInArrow(
        run, "label string, shard long, with long, node long, members long, home boolean, second boolean, v array<double>")


def even(raw):
    """Vectors over a power of two near their largest component, which changes no digit of them."""
    import numpy as np

    return raw / np.exp2(np.floor(np.log2(np.abs(raw).max(axis=-1, keepdims=True))))


def cosine(a, b):
    import numpy as np

    return (a * b).sum(axis=-1) / (np.sqrt((a * a).sum(axis=-1)) * np.sqrt((b * b).sum(axis=-1)))


def pack_shard(pdf):
    """Rows in order of node, their vectors, and these as unit vectors."""
    import numpy as np

    pdf = pdf.sort_values("node")
    raw = even(np.stack(pdf["v"].to_numpy()).astype(float))
    return pdf, raw, raw / np.linalg.norm(raw, axis=1, keepdims=True)


def asked(step=QUERY_STEP):
    """Whether the audit asks for a class: one in `step`."""
    return F.pmod(F.xxhash64("node"), F.lit(step)) == 0


LINKS = "label string, node long, partners long, other long"


def link_rows(label, nodes, partners, root, i, j):
    """Rows of LINKS of one task: partners by place, each place's root in the forest, asked links i, j."""
    import numpy as np
    import pandas as pd

    some, inner = np.flatnonzero(partners), np.flatnonzero(root != np.arange(len(nodes)))
    sizes = (len(some), len(inner), len(i))

    def column(values, null):
        return pd.arrays.IntegerArray(np.concatenate(values).astype(np.int64), np.repeat(null, sizes))

    return pd.DataFrame({
        "label": label, "node": np.concatenate([nodes[some], nodes[inner], nodes[i]]),
        "partners": column([partners[some], np.zeros(len(inner)), np.full(len(i), -1)], [False, True, False]),
        "other": column([np.zeros(len(some), dtype=np.int64), nodes[root[inner]], nodes[j]], [True, False, False]),
    })


def found_links(dealt, graph, threshold):
    """Rows (label, node, partners, other) of links: partners, the members of linked classes, of nodes;
    other, edges that span what is linked (partners null); and all links of the nodes that the audit
    asks for (partners -1). With a graph, what searches of overlapping shards find; without, what the
    pairs of shards hold."""
    dealt = dealt.withColumn("asked", asked())
    return paired_links(dealt, threshold) if graph is None else searched_links(dealt, graph, threshold)


def searched_links(dealt, graph, threshold):
    """found_links by a search for every class of a shard. A link is found from either end. Two classes
    may share several shards: the least of them gives their link to partners, forest and audit alike,
    so no pair has to be told apart from a second finding of it."""
    def run(pdf):
        import numpy as np

        label, shard = pdf["label"].iloc[0], pdf["shard"].iloc[0]
        pdf, raw, v = pack_shard(pdf)
        nodes, members, ask = pdf["node"].to_numpy(), pdf["members"].to_numpy(), pdf["asked"].to_numpy()
        every = np.stack(pdf["every"].to_numpy())
        near = []
        for listed in pdf["near"]:
            at = np.minimum(np.searchsorted(nodes, listed), len(nodes) - 1)
            near.append(at[nodes[at] == listed])
        medoid = int((v @ v.mean(axis=0)).argmax())
        hit = np.zeros((len(v), len(v)), dtype=bool)
        for q in range(len(v)):
            hits = range_search(q, v, near, medoid, threshold)
            hits = hits[hits != q]
            hits = hits[cosine(raw[hits], raw[q]) >= threshold]
            shared = (every[hits][:, :, None] == every[q]).any(axis=2)
            hits = hits[np.where(shared, every[hits], np.iinfo(np.int64).max).min(axis=1) == shard]
            hit[q, hits] = hit[hits, q] = True
        root, told = np.arange(len(v)), [np.zeros((2, 0), dtype=np.int64)]
        for at in range(0, len(v), BLOCK):
            i, j = np.nonzero(hit[at:at + BLOCK])
            i += at
            root = forest(len(v), root[i], root[j])[root]
            told.append(np.stack([i, j])[:, (ask[i] | ask[j]) & (i < j)])
        return link_rows(label, nodes, hit @ members, root, *np.concatenate(told, axis=1))

    return dealt.join(graph, ["label", "node"]).groupBy("label", "shard").applyInPandas(run, LINKS)


def paired_links(dealt, threshold):
    """found_links by complete comparison of pairs of shards."""
    def run(pdf):
        import numpy as np

        name = pdf["label"].iloc[0]
        same = pdf["shard"].iloc[0] == pdf["with"].iloc[0]
        pdf, raw, v = pack_shard(pdf)
        nodes, members, ask = pdf["node"].to_numpy(), pdf["members"].to_numpy().astype(float), pdf["asked"].to_numpy()
        second = pdf["second"].to_numpy()
        one, two = (np.arange(len(v)),) * 2 if same else (np.flatnonzero(~second), np.flatnonzero(second))
        partners, label, pairs = np.zeros(len(v)), np.arange(len(v)), []
        for at in range(0, len(one), BLOCK):
            part = one[at:at + BLOCK]
            sims = v[part] @ v[two].T
            hit = sims >= threshold
            i, j = np.nonzero(np.abs(sims - threshold) <= CLOSE)
            for k in range(0, len(i), 1 << 16):
                x, y = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
                hit[x, y] = cosine(raw[part[x]], raw[two[y]]) >= threshold
            if same:
                hit &= part[:, None] < two[None]
            partners[part] += hit @ members[two]
            partners[two] += members[part] @ hit
            i, j = np.nonzero(hit)
            i, j = part[i], two[j]
            pairs.append(np.stack([i, j])[:, ask[i] | ask[j]])
            label = forest(len(v), label[i], label[j])[label]
        i, j = np.concatenate([np.zeros((2, 0), dtype=np.int64), *pairs], axis=1)
        return link_rows(name, nodes, partners, label, i, j)

    return dealt.groupBy("label", "shard", "with").applyInPandas(run, LINKS)


def true_links(dealt, threshold, step=QUERY_STEP):
    """(label, node, other): all links of the classes that the audit asks for, among all classes of
    their label by brute force, block against block."""
    home = dealt.where("home")
    one = F.collect_list(F.struct("node", "v"))
    queries = home.where(asked(step)).groupBy("label", F.floor(F.col("shard") / step).alias("block")).agg(one.alias("q"))
    blocks = home.groupBy("label", "shard").agg(one.alias("c"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for label, q, c in zip(batch.column("label").to_pylist(), batch.column("q"), batch.column("c"), strict=True):
                (qn, qv), (cn, cv) = [
                    (x.values.field("node").to_numpy(), even(np.stack(x.values.field("v").to_numpy(zero_copy_only=False))))
                    for x in (q, c)]
                for node, vector in zip(qn, qv, strict=True):
                    hit = cn[(cosine(cv, vector) >= threshold) & (cn != node)]
                    if len(hit):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([label] * len(hit)), pa.array(np.minimum(hit, node)), pa.array(np.maximum(hit, node))],
                            ["label", "node", "other"])

    return queries.join(blocks, "label").select("label", "q", "c").mapInArrow(
        run, "label string, node long, other long").distinct()


def recalls(true, links):
    """(label, links, found): the true links of each label and how many of them links hold."""
    hit = links.where("partners = -1").select(
        F.least("node", "other").alias("node"), F.greatest("node", "other").alias("other"), F.lit(1).alias("hit")).distinct()
    return true.join(hit, ["node", "other"], "left").groupBy("label").agg(
        F.count("*").alias("links"), F.count("hit").alias("found"))


def near_vectors(rows, threshold=0.93, recall=0.95, id_col="vec_id", vector_col="embedding", label_col="label"):
    """(vec_id, n_links, component_id, kept) of every row: vectors of one label (not null) link at
    a cosine of at least the threshold; component_id is the smallest vec_id reachable by links.

    Links are what searches of the graph find. Labels of which an audit of some classes by brute force
    sees less than `recall` found are completed by comparing all pairs of shards that can hold links,
    which finds all; less than that after it is an error and raises. Equal vectors of a label are one
    class with a number of members, which link with each other and alike with others, so copies are
    never paired up. Null, empty or zero
    vectors and those with null or non-finite components link with nothing; so do vectors of
    different lengths. Repeated rows are copies. A null id counts as a member but names no
    component. An empty table gives no rows.
    """
    members = stored(members_of(rows, id_col, vector_col, label_col), "vectors")
    classes = stored(members.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("members"),
        F.min("vec_id").alias("first")), "vector-classes")
    centers = centroids(classes)
    dealt = stored(overlapping(classes, centers), "shards")
    links = stored(found_links(dealt, stored(adjacency(dealt), "graph"), threshold), "links")
    true = stored(true_links(dealt, threshold), "true-links")
    fails = F.col("found") < recall * F.col("links")
    short = stored(recalls(true, links), "recalls").where(fails).select("label")
    if not short.isEmpty():
        pairs = stored(shards(classes.join(short, "label", "left_semi"), centers, threshold), "shard-pairs")
        completed = stored(found_links(pairs, None, threshold), "completed-links")
        missed = recalls(true.join(short, "label", "left_semi"), completed).where(fails).first()
        if missed:
            raise ValueError(f"recall of links {missed['found'] / missed['links']:.3f} of {missed['label']} is below {recall}")
        links = links.join(short, "label", "left_anti").unionByName(completed)
    partners = links.where("partners >= 0").groupBy("node").agg(F.sum("partners").alias("partners"))
    labels = components(links.where("partners is null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    rooted = stored(
        classes.select("node", "first", "members").join(partners, "node", "left").join(labels, "node", "left").select(
            "node", "first", F.coalesce("component", "node").alias("root"),
            (F.col("members") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links")), "rooted-vectors")
    ids = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "vector-components")
    named = stored(rooted.join(ids, "root").select("node", "n_links", "component_id"), "named-vectors")
    found = members.select("vec_id", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return found.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))


def op10(spark, sf_dir):
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
