"""SimHash fingerprints and exact links by tiled comparison with numpy."""

from pyspark.sql import functions as F

from feedstream.llm.common import keyed, stored
from feedstream.llm.components import components, forest

BITS = 64
TILE = 2048  # fingerprints compared in one task; larger groups are split into pairs of tiles
SUB_TILE = 256
WORDS, BANDS, BAND_ROWS = 8, 12, 3  # of the wide sketch
SIMILARITY = 0.8  # of the sets of shingles of near copies
# Of the 512 bits of the sketch: sets of a similarity of 0.8 differ in 76 to 78 on average, with a
# deviation of 8, and in 96 where they have only 4 and 5 members.
CERTAIN, POSSIBLE = 36, 128
READ = 256  # texts whose sets of shingles are held at once
TILE_HASHES = 1 << 20  # shingle hashes of a chunk whose pairs are verified in one task


def shingle_hashes(text, shingle, seed=42):
    """XXH64 of every run of `shingle` words, lower-cased in ASCII and joined by spaces; of the whole
    sequence where it is shorter; none without words."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype="<u8")
    joined = b" ".join(words)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    last = min(shingle, len(words)) - 1
    return np.fromiter(
        (xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends[last:], strict=False)),
        dtype="<u8", count=len(words) - last)


def majority(hashes):
    """Bit i of the result is set if over half of the hashes have it set; 0 for none."""
    import numpy as np

    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 255):  # so that sums fit into bytes
        part = hashes[at:at + 255].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    bits = np.packbits((ones * 2 > len(hashes)).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def shingle_set(text, shingle):
    """The distinct shingle hashes of a text, in order."""
    import numpy as np

    return np.unique(shingle_hashes(text, shingle))


def sketch(hashes):
    """(WORDS words of fingerprint, BANDS keys) of a set of shingles. Keys are hashes of the least
    values that BAND_ROWS permutations give the shingles; like sets share some key."""
    import numpy as np

    scaled = [hashes]
    for k in range(1, WORDS):
        mixed = hashes * np.uint64(2 * k * 0x9E3779B97F4A7C15 + 1 & (1 << 64) - 1)
        scaled.append((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9))
    if not len(hashes):
        return [0] * WORDS, []
    factor = np.random.default_rng(5).integers(1 << 62, size=BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    spun = hashes ^ (hashes >> np.uint64(31))
    least = np.array([(spun * f).min() for f in factor], dtype=np.uint64).reshape(BANDS, BAND_ROWS)
    key = np.zeros(BANDS, dtype=np.uint64)
    for column in least.T:
        key = (key ^ column) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    return [majority(h) for h in scaled], key.view(np.int64).tolist()


def fingerprints(docs, shingle=4, id_col="doc_id", text_col="text"):
    """(doc_id, rk, fp long) of every row of docs."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            fps = [majority(shingle_hashes(text.as_py(), shingle)) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rk"), pa.array(fps, pa.int64())],
                ["doc_id", "rk", "fp"])

    rows = keyed(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, rk long, fp long")


def tile_forest(fps, *radii):
    """For each radius (node -> root): a spanning forest of the links among fingerprints (rows of
    words), as an array of positions. Sub-tiles in order of population count are skipped when their
    counts differ by more than the largest radius."""
    import numpy as np

    ones = np.bitwise_count(fps).sum(axis=1, dtype=np.int64)
    order = np.argsort(ones, kind="stable")
    fps, ones = fps[order], ones[order]
    labels = [np.arange(len(fps)) for _ in radii]
    for x in range(0, len(fps), SUB_TILE):
        one = fps[x:x + SUB_TILE]
        for y in range(x, len(fps), SUB_TILE):
            if ones[y] - ones[min(x + SUB_TILE, len(fps)) - 1] > max(radii):
                break
            apart = bits_apart(one, fps[y:y + SUB_TILE])
            for k, radius in enumerate(radii):
                i, j = np.nonzero(apart <= radius)
                keep = i + x < j + y
                label = labels[k]
                i, j = label[i[keep] + x], label[j[keep] + y]
                labels[k] = forest(len(fps), i, j)[label]
    roots = []
    for label in labels:
        root = np.empty_like(label)
        root[order] = order[label]
        roots.append(root)
    return roots


def bits_apart(one, other):
    """Bits in which each fingerprint of one differs from each of other."""
    import numpy as np

    apart = np.zeros((len(one), len(other)), dtype=np.uint16)
    for k in range(one.shape[1]):
        apart += np.bitwise_count(one[:, None, k] ^ other[None, :, k])
    return apart


def links(points, radius, tile=TILE, certain=None):
    """Edges (a, b, certain) between nodes of points (node, fp array<long>, keys array<struct<k, v>>),
    as spanning forests of all links between nodes that share a key and lie within the radius, and,
    marked as certain, of those within the smaller radius `certain`, where one is given.

    A tile is what shares a key. A key with more than `tile` nodes is split into chunks, and every
    pair of chunks is a tile, so a task never holds more than two chunks and no pair is lost.
    """
    spread = points.select("node", "fp", F.explode("keys").alias("r")).select("node", "fp", "r.k", "r.v")
    large = stored(
        spread.groupBy("k", "v").count().where(F.col("count") > tile)
        .select("k", "v", F.ceil(F.col("count") / tile).alias("chunks")), "hot-keys")
    small = spread.join(large, ["k", "v"], "left_anti").withColumn("pair", F.lit("0"))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks"))
    split = spread.join(large, ["k", "v"]).withColumn("chunk", chunk).select(
        "node", "fp", "k", "v", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    ).select("node", "fp", "k", "v", F.concat_ws(
        "-", F.least("chunk", "other").cast("string"), F.greatest("chunk", "other").cast("string")).alias("pair"))
    tiles = small.unionByName(split).groupBy("k", "v", "pair").agg(
        F.collect_list(F.struct("node", "fp")).alias("rows")).where(F.size("rows") > 1).select("rows")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            left, right, sure = [], [], []
            for rows in batch.column("rows"):
                nodes = rows.values.field("node").to_numpy()
                fps = rows.values.field("fp").flatten().to_numpy().view(np.uint64).reshape(len(nodes), -1)
                own = np.arange(len(nodes))
                near, wide = tile_forest(fps, -1 if certain is None else certain, radius)
                for root, edge, mark in ((near, near != own, True), (wide, (wide != own) & (wide != near), False)):
                    left.append(nodes[edge])
                    right.append(nodes[root[edge]])
                    sure.append(np.full(int(edge.sum()), mark))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in (left, right, sure)], ["a", "b", "certain"])

    return tiles.mapInArrow(run, "a long, b long, certain boolean").distinct()


def bit_ranges(fp, radius):
    """Keys of a 64-bit fingerprint: two within the radius agree on one of radius + 1 bit ranges."""
    cuts = [round(BITS * k / (radius + 1)) for k in range(radius + 2)]
    return F.array(*[
        F.struct(F.lit(k).alias("k"), F.shiftrightunsigned(fp, cuts[k]).bitwiseAND(
            (1 << cuts[k + 1] - cuts[k]) - 1).alias("v"))
        for k in range(radius + 1)])


def grouped(rows, edges, first):
    """rows (node, ...) with `first`, the least of `first` over all rows whose nodes are linked."""
    classes = stored(rows.groupBy("node").agg(F.min(first).alias("first")), "classes")
    labels = components(edges).withColumnRenamed("node", "linked")
    rooted = stored(classes.join(labels, classes["node"] == labels["linked"], "left").select(
        "node", "first", F.coalesce("component", "node").alias("root")), "rooted")
    least = stored(rooted.groupBy("root").agg(F.min("first").alias("first")), "firsts")
    named = stored(rooted.select("node", "root").join(least, "root").select("node", "first"), "named")
    return rows.join(named, "node")


def near_duplicates(docs, shingle=4, radius=4, id_col="doc_id", text_col="text", tile=TILE):
    """(doc_id, rk, fp, component_id) of every row: fingerprints within the radius link, and
    component_id is the smallest doc_id reachable.

    No words (null, empty or blank text): fingerprint 0, linked like any other. Repeated rows and
    exact copies share a fingerprint and are compared once. Null ids get a component but name none
    (component_id is null where no member has an id). An empty table gives no rows.
    """
    rows = stored(fingerprints(docs, shingle, id_col, text_col).withColumnRenamed("fp", "node"), "fingerprints")
    points = rows.select("node").distinct().select(
        "node", F.array("node").alias("fp"), bit_ranges(F.col("node"), radius).alias("keys"))
    return grouped(rows, links(points, radius, tile), F.col("doc_id")).select(
        "doc_id", "rk", F.col("node").alias("fp"), F.col("first").alias("component_id"))


def first_of_groups(docs, shingle=4, radius=4, id_col="doc_id", text_col="text", tile=TILE):
    """(doc_id, rk, kept) of every row: of each group that near_duplicates links the row with the least
    (doc_id, rk) is kept. Null ids come first; rows equal in id and text stay or go together."""
    rows = stored(fingerprints(docs, shingle, id_col, text_col).withColumnRenamed("fp", "node"), "fingerprints")
    points = rows.select("node").distinct().select(
        "node", F.array("node").alias("fp"), bit_ranges(F.col("node"), radius).alias("keys"))
    me = F.struct("doc_id", "rk")
    return grouped(rows, links(points, radius, tile), me).select(
        "doc_id", "rk", me.eqNullSafe(F.col("first")).alias("kept"))


def true_forest(sets, fps, label, similarity):
    """For each set of hashes the place of a set that verified links reach; sets of one label are
    linked already. A pair is looked at if its sizes allow the similarity, its fingerprints differ
    in at most POSSIBLE bits and it is not linked yet."""
    import numpy as np

    root = np.unique(label, return_index=True, return_inverse=True)
    root = root[1][root[2]]
    sizes = np.array([len(x) for x in sets])

    def find(n):
        while root[n] != n:
            root[n] = n = root[root[n]]
        return n

    for x in range(0, len(sets), SUB_TILE):
        for y in range(x, len(sets), SUB_TILE):
            a, b = sizes[x:x + SUB_TILE, None], sizes[None, y:y + SUB_TILE]
            apart = bits_apart(fps[x:x + SUB_TILE], fps[y:y + SUB_TILE])
            likely = (apart <= POSSIBLE) & (np.minimum(a, b) >= similarity * np.maximum(a, b) - 1e-6)
            likely &= root[x:x + SUB_TILE, None] != root[None, y:y + SUB_TILE]
            for i, j in np.argwhere(likely).tolist():
                i, j = i + x, j + y
                one, other = find(i), find(j)
                if i < j and one != other:
                    shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if shared >= similarity * (sizes[i] + sizes[j] - shared) - 1e-6:
                        root[max(one, other)] = min(one, other)
    return np.array([find(n) for n in range(len(sets))], dtype=np.int64)


def verified(docs, points, edges, shingle, similarity):
    """Edges (a, b) that span the pairs of points (node, fp, size, doc_id, rk of a text) which may
    link by edges (a, b, certain) and have the similarity; certain edges hold already.

    Points that any edges connect are a cluster. One that certain edges do not connect is dealt by
    pairs of chunks, of at most about TILE nodes or TILE_HASHES hashes, to tasks that compare the
    texts' sets of shingles.
    """
    sure = stored(components(edges.where("certain")), "certain").withColumnRenamed("component", "root")
    placed = stored(
        components(edges).join(sure, "node", "left")
        .select("node", "component", F.coalesce("root", "node").alias("root"))
        .join(points, "node"), "candidates")
    open_ = placed.groupBy("component").agg(
        F.min("root").alias("least"), F.max("root").alias("most"),
        F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("size") / TILE_HASHES)).alias("chunks")
    ).where("least <> most").select("component", "chunks")
    asked = placed.join(open_, "component").select(
        "component", "chunks", "node", "root", "fp", F.col("doc_id").alias("_id"), F.col("rk").alias("_rk"))
    rows = keyed(docs)
    rows = rows.join(asked, rows["doc_id"].eqNullSafe(asked["_id"]) & (rows["rk"] == asked["_rk"]))

    def read(batches):
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, READ):
                batch = whole.slice(at, READ)
                sets = [shingle_set(text.as_py(), shingle).view("<i8") for text in batch.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(sets, pa.list_(pa.int64()))],
                    ["component", "chunks", "node", "root", "fp", "hashes"])

    kinds = "component long, chunks long, node long, root long, fp array<long>, hashes array<long>"
    sets = stored(rows.select("component", "chunks", "node", "root", "fp", "text").mapInArrow(read, kinds)
                  .dropDuplicates(["node"]), "shingle-sets")
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks"))
    tiles = sets.withColumn("chunk", chunk).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).groupBy(
        "component", F.least("chunk", "other"), F.greatest("chunk", "other")).agg(
        F.collect_list(F.struct("node", "root", "fp", "hashes")).alias("rows")).where(F.size("rows") > 1).select("rows")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for rows in batch.column("rows"):
                nodes, label = [rows.values.field(c).to_numpy() for c in ("node", "root")]
                fps = rows.values.field("fp").flatten().to_numpy().view(np.uint64).reshape(len(nodes), -1)
                hashes = rows.values.field("hashes")
                ends = hashes.value_lengths().to_numpy().cumsum()
                root = true_forest(np.split(hashes.flatten().to_numpy(), ends[:-1]), fps, label, similarity)
                edge = root != np.arange(len(nodes))
                yield pa.RecordBatch.from_arrays([pa.array(nodes[edge]), pa.array(nodes[root[edge]])], ["a", "b"])

    return edges.where("certain").select("a", "b").union(tiles.mapInArrow(run, "a long, b long"))


def similar_texts(docs, shingle=5, similarity=SIMILARITY, id_col="doc_id", text_col="text", tile=TILE):
    """(doc_id, rk, kept) of every row: texts whose sets of shingles have at least the similarity
    (Jaccard) link; of each group the row with the least (doc_id, rk) is kept.

    Texts of equal sets are one node. Pairs are sought among those that share a key of least hashes:
    where 512-bit fingerprints differ in at most CERTAIN bits the similarity is beyond doubt, up to
    POSSIBLE bits the sets themselves decide. Texts without words are one group. Repeated rows are
    one document and stay or go together. Null ids come first. An empty table gives no rows.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        for batch in batches:
            node, size, fps, bands = [], [], [], []
            for text in batch.column("text"):
                hashes = shingle_set(text.as_py(), shingle)
                fp, keys = sketch(hashes)
                node.append(xxh64_intdigest(hashes.tobytes(), 11))
                size.append(len(hashes))
                fps.append(fp)
                bands.append(keys)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rk"), pa.array(np.array(node, dtype=np.uint64).view(np.int64)),
                 pa.array(size, pa.int64()), pa.array(fps, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "rk", "node", "size", "fp", "bands"])

    keys = keyed(docs, id_col, text_col)
    kind = keys.schema["doc_id"].dataType.simpleString()
    sketched = stored(keys.mapInArrow(
        run, f"doc_id {kind}, rk long, node long, size long, fp array<long>, bands array<long>"), "sketches")
    once = sketched.dropDuplicates(["node"])
    points = once.select("node", "fp", F.transform(
        "bands", lambda v, k: F.struct(k.alias("k"), v.alias("v"))).alias("keys"))
    edges = stored(links(points, POSSIBLE, tile, CERTAIN), "possible-links")
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    true = stored(verified(source, once.drop("bands"), edges, shingle, similarity), "true-links")
    me = F.struct("doc_id", "rk")
    return grouped(sketched.select("doc_id", "rk", "node"), true, me).select(
        "doc_id", "rk", me.eqNullSafe(F.col("first")).alias("kept"))


def op9(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
