"""Removal of long byte strings that occur more than once: bucket-pointer refinement in tasks and
joins, on the suffixes that can start a repeated string.

The bucket of a suffix at depth 8 is its first 8 bytes; the bucket at depth 2d is drawn from the
bucket at depth d and the one of the suffix d bytes later, and so on, each level reusing the one
before. Buckets are named by 64-bit hashes, so tasks refine without knowing each other's buckets.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F, types as T

from feedstream.llm.common import keyed, stored

ANCHOR = 32  # depth of the initial buckets that are compared across the corpus
BLOCK = 1 << 20  # bytes refined at once; positions in a block fit into 20 bits
STRIDE = 16  # neighbouring strings that are first compared as one


@F.pandas_udf(T.BinaryType())
def packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Texts as compressed bytes, which exchanges move instead."""
    from zstandard import ZstdCompressor

    compress = ZstdCompressor(level=5).compress
    for texts in batches:
        yield texts.map(lambda t: compress(t.encode()))


def unpack(column):
    from zstandard import ZstdDecompressor

    expand = ZstdDecompressor().decompress
    return [expand(x) for x in column.to_pylist()]


def refine(first, later):
    """Buckets drawn from two levels of buckets."""
    import numpy as np

    x = first * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x += later
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    return x


def buckets(raw, *lengths):
    """Buckets of all suffixes long enough, at each of the given depths (ascending)."""
    import numpy as np

    n, depth, found = len(raw), 8, []
    level = np.ndarray((n - 7,), dtype="<u8", buffer=raw, strides=(1,)).copy()
    for length in lengths:
        while depth * 2 <= length:
            level = refine(level[:-depth], level[depth:])
            depth *= 2
        found.append(level if depth == length else refine(level[:n - length + 1], level[length - depth:]))
    return found


def blocks(texts, length):
    """Texts cut and put together into blocks: (bytes, pieces (row, offset in row, size)). Pieces of
    one text overlap by length - 1 bytes, so every string of that length lies in exactly one."""
    held, pieces, size = [], [], 0
    for row, text in enumerate(texts):
        at = 0
        while len(text) - at >= length:
            piece = text[at:at + BLOCK - size]
            if len(piece) >= length:
                held.append(piece)
                pieces.append((row, at, len(piece)))
                size += len(piece)
                at += len(piece) - length + 1
            if size + length > BLOCK:
                yield b"".join(held), pieces
                held, pieces, size = [], [], 0
    if pieces:
        yield b"".join(held), pieces


def anchors_of(raw, pieces, length):
    """Anchors of a block as arrays (row, q, ctx, pack).

    A string of the given length is owned by its suffix with the least bucket at depth ANCHOR, the
    leftmost of equals; that depends on the string alone, so equal strings are owned alike. pack
    holds the first string owned (its start in the text), the anchor's distance from it and the
    last string's. ctx names everything that the owned strings cover, with the anchor's place.
    """
    import numpy as np

    anchor, whole = buckets(raw, ANCHOR, length)
    mask = np.uint64(BLOCK - 1)
    order = (anchor & ~mask) | np.arange(len(anchor), dtype=np.uint64)
    span, width = length - ANCHOR + 1, 1
    while width * 2 <= span:
        order = np.minimum(order[:-width], order[width:])
        width *= 2
    if width < span:
        order = np.minimum(order[:len(order) - (span - width)], order[span - width:])
    owner = (order & mask).astype(np.int64)
    begins = np.cumsum([0, *(size for _, _, size in pieces)])[:-1]
    starts = np.concatenate([np.arange(b, b + size - length + 1) for b, (_, _, size) in zip(begins, pieces, strict=True)])
    own = owner[starts]
    turn = np.flatnonzero((np.diff(own) != 0) | (np.diff(starts) != 1))
    first, last = starts[np.append(0, turn + 1)], starts[np.append(turn, len(starts) - 1)]
    at = own[np.append(0, turn + 1)]
    shape = ((at - first) << 8 | (last - first)).astype(np.uint64)
    ctx = refine(refine(whole[first], whole[last]), shape)
    piece = np.searchsorted(begins, first, side="right") - 1
    rows = np.array([r for r, _, _ in pieces])[piece]
    offset = np.array([o for _, o, _ in pieces])[piece] - begins[piece]
    pack = (first + offset) << 16 | shape.astype(np.int64)
    return rows, anchor[at].view(np.int64), ctx.view(np.int64), pack


def find_anchors(rows, length):
    """(rk, q, ctx, pack) of every anchor of rows."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for raw, pieces in blocks(texts, length):
                where, *found = anchors_of(raw, pieces, length)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rk").take(pa.array(where)), *map(pa.array, found)], ["rk", "q", "ctx", "pack"])

    return rows.select("rk", "text").mapInArrow(run, "rk long, q long, ctx long, pack long")


def strides_of(texts, length):
    """(rk, q, times, start, count, core, hull): the strings of the listed anchors, up to STRIDE
    neighbours at a time. Equal hulls are equal in all their strings; where cores differ no string
    is equal. Strides lie alike about equal anchors."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        names = ["rk", "q", "times", "start", "count", "core", "hull"]
        for batch in batches:
            for n, raw in enumerate(unpack(batch.column("z"))):
                inner, whole = buckets(raw, length - STRIDE + 1, length)
                listed = batch.column("found")[n].values
                pack, q, times = (listed.field(k).to_numpy() for k in range(3))
                first, last = pack >> 16, (pack >> 16) + (pack & 255)
                at = first + (pack >> 8 & 255)
                low, high = (at - last) // STRIDE, (at - first) // STRIDE
                each = high - low + 1
                ends = np.cumsum(each)
                one = np.repeat(np.arange(len(pack)), each)
                j = np.arange(ends[-1]) - np.repeat(ends - each, each) + low[one]
                start = np.maximum(first[one], at[one] - STRIDE * j - STRIDE + 1)
                end = np.minimum(last[one], at[one] - STRIDE * j)
                core = refine(inner[at[one] - STRIDE * j], j.astype(np.uint64))
                shape = ((at[one] - start) << 8 | (end - start)).astype(np.uint64)
                hull = refine(refine(whole[start], whole[end]), shape)
                rk = pa.array(np.full(len(one), batch.column("rk")[n].as_py()))
                yield pa.RecordBatch.from_arrays([rk, *map(pa.array, (
                    q[one], times[one], start, end - start + 1, core.view(np.int64), hull.view(np.int64)))], names)

    return texts.select("rk", "z", "found").mapInArrow(
        run, "rk long, q long, times long, start long, count long, core long, hull long")


def strings_of(texts, length):
    """(rk, q, times, start, w): every string of the listed strides, w its bucket at full depth."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for n, raw in enumerate(unpack(batch.column("z"))):
                [whole] = buckets(raw, length)
                listed = batch.column("listed")[n].values
                first, count, q, times = (listed.field(k).to_numpy() for k in range(4))
                ends = np.cumsum(count)
                start = np.arange(ends[-1]) + np.repeat(first - ends + count, count)
                rk = pa.array(np.full(len(start), batch.column("rk")[n].as_py()))
                yield pa.RecordBatch.from_arrays([rk, *map(pa.array, (
                    np.repeat(q, count), np.repeat(times, count), start, whole[start].view(np.int64)))],
                    ["rk", "q", "times", "start", "w"])

    return texts.select("rk", "z", "listed").mapInArrow(
        run, "rk long, q long, times long, start long, w long")


def more_than_one(df, *keys):
    """Keys that several rows of df share."""
    return stored(df.groupBy(*keys).count().where("count > 1").select(*keys), "shared-keys")


def repeated_ranges(rows, length):
    """(rk, from, to): byte ranges that strings with another occurrence cover."""
    anchors = stored(find_anchors(rows, length), "anchors")
    shared = stored(anchors.join(more_than_one(anchors, "q"), "q", "left_semi"), "shared-anchors")
    contexts = stored(shared.groupBy("q", "ctx").agg(
        F.count("*").alias("times"), F.min(F.struct("rk", "pack")).alias("one")), "contexts")
    first, last = F.shiftright("pack", 16), F.shiftright("pack", 16) + F.col("pack").bitwiseAND(255)
    whole = shared.join(contexts.where("times > 1").select("q", "ctx"), ["q", "ctx"], "left_semi").select(
        "rk", first.alias("from"), (last + length).alias("to"))

    differ = contexts.join(more_than_one(contexts, "q"), "q", "left_semi")
    listed = differ.select("q", "times", "one.*").groupBy("rk").agg(
        F.collect_list(F.struct("pack", "q", "times")).alias("found"))
    open_ = stored(rows.select("rk", packed("text").alias("z")).join(
        listed.hint("shuffle_hash"), "rk"), "open-texts")
    strides = stored(strides_of(open_, length), "strides")
    live = stored(strides.join(more_than_one(strides, "q", "core"), ["q", "core"], "left_semi"), "live-strides")
    hulls = stored(live.groupBy("q", "core", "hull").agg(
        F.sum("times").alias("times"), F.min(F.struct("rk", "start", "count")).alias("one")), "hulls")
    evenly = live.where("times = 1").join(
        hulls.where("times > 1").select("q", "core", "hull"), ["q", "core", "hull"], "left_semi").select(
        "rk", F.col("start").alias("from"), (F.col("start") + F.col("count") - 1 + length).alias("to"))

    singly = hulls.join(more_than_one(hulls, "q", "core"), ["q", "core"], "left_semi").select(
        "q", "times", "one.*").groupBy("rk").agg(F.collect_list(F.struct("start", "count", "q", "times")).alias("listed"))
    strings = stored(strings_of(open_.select("rk", "z").join(singly.hint("shuffle_hash"), "rk"), length), "strings")
    again = stored(strings.groupBy("q", "w").agg(F.sum("times").alias("n")).where("n > 1").select("q", "w"), "repeated")
    partly = strings.where("times = 1").join(again, ["q", "w"], "left_semi").select(
        "rk", F.col("start").alias("from"), (F.col("start") + length).alias("to"))
    return whole.unionByName(evenly).unionByName(partly)


def remove_repeats(docs, length=200, id_col="doc_id", text_col="text"):
    """(doc_id, rk, n_bytes, n_removed, n_spans, kept binary) of every row: bytes covered by a
    string of `length` bytes that starts anywhere else as well, in the input, are removed.

    Suffixes enter the initial buckets only where they own strings (see anchors_of); buckets with
    one suffix are done. Where two suffixes of a bucket cover the same bytes, all their strings are
    repeated; the strings of the others are compared in strides, one suffix per distinct context,
    and only strides that share their core but not all of their bytes string by string. Counts are
    partial sums before any exchange, and joins are of exchanged tables, so that a passage in a
    third of all texts is split. A text is known by the 64-bit hash of its id and itself.

    Null or empty texts have 0 bytes. Repeated rows are copies of each other: both lose what is
    long enough. An empty table gives no rows.
    """
    rows = keyed(docs, id_col, text_col)
    ranges = repeated_ranges(rows, length).groupBy("rk").agg(
        F.collect_list(F.struct("from", "to")).alias("ranges"))
    joined = rows.select("doc_id", "rk", packed("text").alias("z")).join(ranges.hint("shuffle_hash"), "rk", "left").select(
        "doc_id", "rk", "z", "ranges")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out = [[], [], [], []]
            for n, raw in enumerate(unpack(batch.column("z"))):
                size, removed, spans = len(raw), 0, 0
                if batch.column("ranges")[n].is_valid:
                    listed = batch.column("ranges")[n].values
                    edge = np.zeros(size + 1, dtype=np.int64)
                    np.add.at(edge, listed.field(0).to_numpy(), 1)
                    np.add.at(edge, listed.field(1).to_numpy(), -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    removed = int(gone.sum())
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    raw = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
                for column, value in zip(out, (size, removed, spans, raw), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rk"), *(pa.array(c, pa.int64()) for c in out[:3]),
                 pa.array(out[3], pa.binary())], ["doc_id", "rk", "n_bytes", "n_removed", "n_spans", "kept"])

    schema = T.StructType([rows.schema["doc_id"], rows.schema["rk"]]).add("n_bytes", T.LongType()).add(
        "n_removed", T.LongType()).add("n_spans", T.LongType()).add("kept", T.BinaryType())
    return joined.mapInArrow(run, schema)


def op3(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
