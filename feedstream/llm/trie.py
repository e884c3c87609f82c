"""The prefix trie of conversations, built as a burst trie over shards."""

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from feedstream.llm.common import stored

TURN = 20  # bytes of a turn in a path: 16 of the hash of its role and text, 4 for its number of words
CONTAINER = 128  # different sequences that a container holds before it bursts
BLOCK_BITS = 8  # ids of equal conversations are put in order by blocks of 2 ** BLOCK_BITS
NO_ENDS = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of no bytes
EMIT = 20_000  # nodes of an Arrow batch
NODES = (
    "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, turn binary")


def turn_codes(conversations, id_col="conv_id", turn_col="turn", role_col="role", text_col="text"):
    """(conv_id, at, role, code): code is a turn as hex digits, equal only for equal role and text.
    A null role or text counts as empty; rows without an id belong to no conversation and are left out."""
    role, text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col)]
    named = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("at"), role.alias("role"),
        F.concat(F.substring(named, 1, TURN * 2 - 8), F.lpad(F.hex(words), 8, "0")).alias("code"))


def listed(turns, *keys):
    """(keys..., codes): the codes of each group in order of turn, null first, then role, then code.
    The codes of one conversation meet in a row (40 bytes a turn), its texts do not."""
    return turns.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("at", "role", "code"))).alias("rows")
    ).select(*keys, F.col("rows.code").alias("codes"))


def path_of(codes):
    return F.unhex(F.array_join(codes, ""))


def sequences(paths):
    """(path, conv, n, ends) of each distinct path of paths (conv_id, path): the smallest id, the
    number of ids, and the SHA-256 of the ids in order.

    Blocks of ids are put in order apart, so a path of very many conversations reaches the task that
    hashes its ids as a stream of ready pieces of text, of which one is held at a time.
    """
    ids = F.sort_array(F.collect_list("conv_id"))
    block = F.shiftright("conv_id", BLOCK_BITS).alias("block")
    pieces = paths.groupBy("path", block).agg(ids.alias("ids")).select(
        "path", "block", F.get("ids", F.lit(0)).alias("conv"), F.size("ids").cast("long").alias("n"),
        F.array_join(F.col("ids").cast("array<string>"), ",").alias("text"))

    def run(batches):
        import hashlib

        import pyarrow as pa

        def packed(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    zip(*rows, strict=True), (pa.binary(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                ["path", "conv", "n", "ends"])

        path, conv, n, digest, done = None, 0, 0, None, []
        for batch in batches:
            for p, _, c, k, text in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                if p != path:
                    if path is not None:
                        done.append((path, conv, n, digest.hexdigest()))
                    path, conv, n, digest = p, c, 0, hashlib.sha256()
                elif n:
                    digest.update(b",")
                n += k
                digest.update(text.encode())
            if done:
                yield packed(done)
                done = []
        if path is not None:
            yield packed([(path, conv, n, digest.hexdigest())])

    ordered = pieces.repartition("path").sortWithinPartitions("path", "block")
    return ordered.mapInArrow(run, "path binary, conv long, n long, ends string")


def key_at(path, depth):
    """Name of the node at a depth of a path."""
    return F.md5(F.substring(path, F.lit(1), depth * TURN))


def burst(rows, container=CONTAINER):
    """(heads, settled) of rows (path, conv, n, ends).

    heads (key, depth, conv, n): the root and every prefix that more than `container` different
    sequences share. settled: rows with the depth and conv of the deepest head above them, whose next
    turn names their container. Containers too full burst by their next turns, several levels a
    round and twice as many in the next, so rounds grow with the logarithm of a shared prefix.
    """
    root = rows.agg(F.min("conv").alias("conv"), F.sum("n").alias("n")).where("n is not null")
    heads = [root.select(F.md5(F.lit(b"")).alias("key"), F.lit(0).alias("depth"), "conv", "n")]
    least = F.lit(None).cast("long")
    active = rows.withColumns({
        "size": F.floor(F.octet_length("path") / TURN).cast("int"), "depth": F.lit(0), "above": least})
    settled, step = [], 2
    while True:
        reach = F.sequence(F.col("depth") + 1, F.least("size", F.col("depth") + step))
        level = active.where("size > depth").select(
            "conv", "n", "path", F.explode(reach).alias("at")).select(
            F.col("conv").alias("of"), "conv", "n", "at", key_at(F.col("path"), F.col("at")).alias("key"))
        full = stored(level.groupBy("key", "at").agg(
            F.count("*").alias("held"), F.sum("n").alias("n"), F.min("conv").alias("conv")
        ).where(F.col("held") > container), "trie-heads")
        heads.append(full.select("key", F.col("at").alias("depth"), "conv", "n"))
        deepest = level.select("of", "key").join(
            full.select("key", "at", F.col("conv").alias("head")), "key"
        ).groupBy("of").agg(F.max("at").alias("found"), F.max_by("head", "at").alias("head"))
        moved = stored(active.join(deepest, active["conv"] == deepest["of"], "left").select(
            "path", "conv", "n", "ends", "size", F.coalesce("found", "depth").alias("depth"),
            F.coalesce("head", "above").alias("above"),
            F.coalesce((F.col("found") == F.col("depth") + step) & (F.col("size") > F.col("found")), F.lit(False))
            .alias("open")), "trie-rows")
        settled.append(moved.where("not open").drop("open"))
        active, step = moved.where("open").drop("open"), step * 2
        if active.isEmpty():
            break
    return reduce(DataFrame.union, heads), reduce(DataFrame.union, settled)


def swept(settled, root_conv):
    """NODES and `head` (the head above the top of a container) of the nodes in the containers.

    The sequences of a container are sorted and swept: the nodes on the way to the present one are
    open, and a node that closes adds itself to the one above it."""
    placed = settled.where("size > depth").select(
        key_at(F.col("path"), F.col("depth") + 1).alias("container"), "path", key_at(F.col("path"), F.col("depth")).alias("head"),
        "depth", F.coalesce("above", F.lit(root_conv)).alias("above"), "conv", "n", "ends")

    def run(batches):
        import pyarrow as pa

        kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.binary(), pa.string()]
        names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                 "ends_sha256", "turn", "head"]
        out, open_ = [], []
        # An open node: [depth, turn, smallest conv, members, children, leaves, saved, ends, rows of children]

        def close(head, above):
            depth, turn, conv, n, children, leaves, saved, ends, rows = open_.pop()
            for row in rows:
                row[2] = conv
                out.append(row)
            saved += (n - 1) * int.from_bytes(turn[16:], "big")
            leaves = leaves or 1
            row = [conv, depth, above, n, children, leaves, saved, ends, turn[:16], None]
            if not open_:
                row[9] = head
                out.append(row)
                return
            up = open_[-1]
            up[2] = min(up[2], conv)
            up[3] += n
            up[4] += 1
            up[5] += leaves
            up[6] += saved
            up[8].append(row)

        def packed():
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        last, before, top = None, b"", (None, None, 0)
        for batch in batches:
            for container, path, head, base, above, conv, n, ends in zip(
                    *[x.to_pylist() for x in batch.columns], strict=True):
                shared = base
                if container == last:
                    least = min(len(path), len(before)) // TURN
                    while shared < least and path[shared * TURN:shared * TURN + TURN] == before[shared * TURN:shared * TURN + TURN]:
                        shared += 1
                while open_ and (container != last or open_[-1][0] > shared):
                    close(top[0], top[1])
                for depth in range(shared, len(path) // TURN):
                    turn = path[depth * TURN:depth * TURN + TURN]
                    open_.append([depth + 1, turn, conv, 0, 0, 0, 0, NO_ENDS, []])
                end = open_[-1]
                end[2], end[3], end[7] = min(end[2], conv), end[3] + n, ends
                last, before, top = container, path, (head, above)
                if len(out) >= EMIT:
                    yield packed()
                    out.clear()
        while open_:
            close(top[0], top[1])
        if out:
            yield packed()

    ordered = placed.repartition("container").sortWithinPartitions("container", "path")
    return ordered.mapInArrow(run, NODES + ", head string")


def head_nodes(heads, settled, nodes):
    """NODES of the heads: sums over what lies below, carried to every head above by its path."""
    direct = nodes.where("head is not null").groupBy("head").agg(
        F.count("*").alias("tops"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    path = settled.select(F.col("conv").alias("of"), "path")
    last = F.conv(F.hex(F.substring("path", F.col("depth") * TURN - 3, F.lit(4))), 16, 10).cast("long")
    own = heads.join(path, heads["conv"] == path["of"]).select(
        "key", "depth", "conv", "n", F.when(F.col("depth") > 0, key_at(F.col("path"), F.col("depth") - 1)).alias("up"),
        F.when(F.col("depth") > 0, (F.col("n") - 1) * last).otherwise(0).alias("own"),
        F.when(F.col("depth") > 0, F.substring("path", F.col("depth") * TURN - TURN + 1, F.lit(16))).alias("turn"),
        F.transform(F.sequence(F.lit(0), F.col("depth")), lambda d: key_at(F.col("path"), d)).alias("chain"))
    own = stored(own.join(direct, own["key"] == direct["head"], "left"), "trie-head-nodes")
    zero = lambda c: F.coalesce(c, F.lit(0))
    sums = own.select(
        F.explode("chain").alias("key"), zero("leaves").alias("leaves"), (F.col("own") + zero("saved")).alias("saved")
    ).groupBy("key").agg(F.sum("leaves").alias("all_leaves"), F.sum("saved").alias("all_saved"))
    below = own.where("up is not null").groupBy(F.col("up").alias("key")).agg(F.count("*").alias("heads"))
    ends = settled.where("size = depth").select(F.md5("path").alias("key"), "ends")
    above = own.select(F.col("key").alias("up"), F.col("conv").alias("parent"))
    children = zero("tops") + zero("heads")
    return own.join(sums, "key").join(below, "key", "left").join(ends, "key", "left").join(above, "up", "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        children.alias("n_children"), F.when(children == 0, 1).otherwise(F.col("all_leaves")).cast("long").alias("n_leaves"),
        F.col("all_saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"), "turn")


def prefix_trie(paths, container=CONTAINER):
    """NODES of the trie of paths (conv_id long and unique, path binary as path_of makes it).

    A node is a distinct run of first turns, from the root of none (depth 0); its members are the
    conversations that begin with it. conv_id is the smallest member, parent_conv_id the parent's
    (root: null), n_leaves the childless nodes in its subtree, itself included, saved_tokens the sum
    over its subtree of (n_convs - 1) times the words of a node's last turn, ends_sha256 the SHA-256
    of the comma-joined ids, in order, of the members that end here, turn the hash of its last turn
    (root: null), which with_turns turns into role and text.

    Equal conversations are one sequence with several ids. Conversations without turns end at the
    root. Without any conversation there is no node, not even a root.
    """
    rows = stored(sequences(paths), "sequences")
    heads, settled = burst(rows, container)
    heads = stored(heads, "trie-all-heads")
    root = heads.where("depth = 0").select("conv").first()
    nodes = stored(swept(settled, root.conv if root else None), "trie-nodes")
    return nodes.drop("head").unionByName(head_nodes(heads, settled, nodes))


def with_turns(nodes, conversations, **columns):
    """nodes with role and text of their last turn."""
    role, text = [F.coalesce(F.col(columns.get(c, c[:-4])).cast("string"), F.lit("")) for c in ("role_col", "text_col")]
    named = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    known = conversations.select(F.unhex(F.substring(named, 1, 32)).alias("turn"), role.alias("role"), text.alias("text"))
    return nodes.join(known.dropDuplicates(["turn"]), "turn", "left")


def rebuilt(conversations):
    """(conv_id, path): every conversation c with its first h turns replaced by those of conversation
    c - c % 20, h being crc32 of c in decimal, modulo 4; a negative c counts down to the next multiple."""
    base = (F.col("conv_id") - F.pmod("conv_id", F.lit(20))).alias("base")
    turns = turn_codes(conversations).select(base, "conv_id", "at", "role", "code").repartition("base")
    own = listed(turns, "base", "conv_id")
    lead = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("codes", 1, 3))).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    none = F.array().cast("array<string>")
    known = own.select("conv_id", "codes", F.coalesce(lead, none).alias("lead"), h.alias("h"))
    return known.select("conv_id", path_of(F.concat(
        F.slice("lead", F.lit(1), F.col("h")), F.slice("codes", F.col("h") + 1, F.size("codes")))).alias("path"))


def op13(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie(rebuilt(conversations)).withColumn("depth", F.col("depth").cast("long")).drop("turn")


CRC32 = """
crc AS (
  SELECT c, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
    string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda p, q: CASE WHEN p & 1 = 1 THEN xor(p >> 1, 3988292384) ELSE p >> 1 END))) % 4 AS h
  FROM (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL))"""

ORACLE_OP13 = rf"""
WITH {CRC32},
own AS (
  SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
    ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':'
      || coalesce(role, '') || coalesce(text, ''))) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
mixed AS (
  SELECT own.c, list_concat(coalesce(list_slice(b.l, 1, h), []), list_slice(own.l, h + 1, len(own.l))) AS l
  FROM own JOIN crc USING (c) LEFT JOIN own b ON b.c = own.c - ((own.c % 20) + 20) % 20),
walks AS (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM mixed),
nodes AS (
  SELECT list_slice(l, 1, d) AS p, d, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(l) = d), '')) AS ends_sha256,
    len(regexp_extract_all(coalesce(list_extract(any_value(l), d).t, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM walks GROUP BY 1, 2),
kids AS (SELECT list_slice(p, 1, d - 1) AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
known AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (p)),
up AS (SELECT unnest(list_transform(range(0, d + 1), lambda k: list_slice(p, 1, k))) AS p,
    n_children = 0 AS leaf, CASE WHEN d > 0 THEN (n_convs - 1) * words ELSE 0 END AS saved FROM known),
sums AS (SELECT p, count(*) FILTER (leaf) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM up GROUP BY p)
SELECT known.conv_id, CAST(known.d AS BIGINT) AS depth, above.conv_id AS parent_conv_id, known.n_convs,
  known.n_children, n_leaves, saved_tokens, known.ends_sha256
FROM known JOIN sums USING (p)
LEFT JOIN known above ON known.d > 0 AND above.p = list_slice(known.p, 1, known.d - 1)
"""
