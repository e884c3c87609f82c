"""Byte-level BPE: encoding by a segment tree over the ranks of adjacent pairs, and decoding."""

import json

from pyspark.sql import functions as F, types as T

from feedstream.llm.common import sha256

# Fixed value: how byte-level BPE vocabularies of this kind split a text into words.
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
SHORT = 64  # bytes; longer words are merged one by one, not as a matrix
PIECE = 1 << 21  # bytes tokenized at once
KEPT_WORDS = 300_000  # a task forgets its words beyond this number and starts again


def byte_letters():
    """Letter that stands for each byte in the vocabulary file: itself if printable."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


def load_vocabulary(path):
    """What encoding and decoding need of a tokenizer file (bounded by the size of that file)."""
    import numpy as np

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab, letters = spec["model"]["vocab"], byte_letters()
    of_letter = {c: b for b, c in letters.items()}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    size = max([*vocab.values(), *special.values()]) + 1
    table = [b""] * size
    for token, i in [*vocab.items(), *special.items()]:
        known = all(c in of_letter for c in token)
        table[i] = bytes(of_letter[c] for c in token) if known else token.encode()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], dtype=np.int64)
    order = np.argsort(keys)
    return {
        "size": size,
        "special": special,
        "bytes": table,
        "byte_ids": np.array([vocab.get(letters[b], -1) for b in range(256)], dtype=np.int64),
        "keys": keys[order],
        "ranks": order.astype(np.int64),
        "merged": np.array([vocab[a + b] for a, b in pairs], dtype=np.int64),
    }


NEVER = (1 << 62)


def merge_together(words, vocabulary):
    """Token ids of words of at most SHORT bytes each, all words stepping together.

    Row r of `tree` is the segment tree of word r: leaf i holds rank * width + i of the pair that
    starts at symbol i, a node the minimum of its children. So the root is the leftmost pair of the
    lowest rank; a merge changes three leaves and their paths to the root.
    """
    import numpy as np

    size, keys, ranks = vocabulary["size"], vocabulary["keys"], vocabulary["ranks"]
    width = 2
    while width < max(map(len, words)):
        width *= 2
    lengths = np.array([len(w) for w in words])
    flat = vocabulary["byte_ids"][np.frombuffer(b"".join(words), dtype=np.uint8)]
    column = np.arange(width)
    inside = column[None, :] < lengths[:, None]
    symbol = np.full((len(words), width + 1), -1, dtype=np.int64)
    symbol[:, :width][inside] = flat
    following = np.where(inside & (column[None, :] + 1 < lengths[:, None]), column[None, :] + 1, width)
    before = np.tile(np.arange(-1, width), (len(words), 1))

    def pair(a, b, at):
        key = a * size + b
        found = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where((a >= 0) & (b >= 0) & (keys[found] == key), ranks[found] * width + at, NEVER)

    tree = np.full((len(words), 2 * width), NEVER, dtype=np.int64)
    tree[:, width:] = pair(symbol[:, :width], symbol[:, 1:], column[None, :])
    level = width
    while level > 1:
        tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
        level //= 2

    def put(row, at, value):
        node = width + at
        tree[row, node] = value
        node = node >> 1
        while node[0]:
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
            node = node >> 1

    row = np.flatnonzero(tree[:, 1] < NEVER)
    while len(row):
        rank, at = np.divmod(tree[row, 1], width)
        gone = following[row, at]
        after = following[row, gone]
        symbol[row, at] = vocabulary["merged"][rank]
        symbol[row, gone] = -1
        following[row, at] = after
        before[row, after] = at
        put(row, gone, NEVER)
        put(row, at, pair(symbol[row, at], symbol[row, after], at))
        prior = before[row, at]
        has = np.flatnonzero(prior >= 0)
        if len(has):
            r, p = row[has], prior[has]
            put(r, p, pair(symbol[r, p], symbol[r, at[has]], p))
        row = row[tree[row, 1] < NEVER]
    left = symbol[:, :width]
    alive = left >= 0
    return np.split(left[alive].astype(np.int32), np.cumsum(alive.sum(axis=1))[:-1])


def merge_alone(word, vocabulary, rank_of):
    """The same for one long word, in time n log n."""
    import numpy as np

    size, merged = vocabulary["size"], vocabulary["merged"]
    symbol = vocabulary["byte_ids"][np.frombuffer(word, dtype=np.uint8)].tolist()
    n = len(symbol)
    width = 1 << (n - 1).bit_length()
    following, before = [*range(1, n + 1)], [*range(-1, n)]
    tree = [NEVER] * (2 * width)

    def pair(a, b):
        rank = rank_of.get(symbol[a] * size + symbol[b])
        return NEVER if rank is None else rank * width + a

    for i in range(n - 1):
        tree[width + i] = pair(i, i + 1)
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(at, value):
        node = width + at
        tree[node] = value
        while node > 1:
            node >>= 1
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

    while tree[1] < NEVER:
        rank, at = divmod(tree[1], width)
        gone = following[at]
        after = following[gone]
        symbol[at], symbol[gone], following[at] = int(merged[rank]), -1, after
        put(gone, NEVER)
        if after < n:
            before[after] = at
        put(at, pair(at, after) if after < n else NEVER)
        if before[at] >= 0:
            put(before[at], pair(before[at], at))
    return np.array([s for s in symbol if s >= 0], dtype=np.int32)


class Encoder:
    """Turns texts into ids; remembers the words it has met, up to kept_words."""

    def __init__(self, vocabulary, kept_words=None):
        import regex

        self.kept_words = KEPT_WORDS if kept_words is None else kept_words
        self.vocabulary = vocabulary
        self.words = regex.compile(WORD_PATTERN).findall
        special = sorted(vocabulary["special"], key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, special)) + ")").split if special else None
        self.special = vocabulary["special"]
        self.known = {}
        self.rank_of = None

    def pieces(self, text):
        if not self.split or not any(s in text for s in self.special):
            return self.words(text)
        parts = []
        for n, part in enumerate(self.split(text)):
            parts += [(part,)] if n % 2 else self.words(part)
        return parts

    def learn(self, words):
        import numpy as np

        by_width = {}
        for word in words:
            if isinstance(word, tuple):
                self.known[word] = np.array([self.special[word[0]]], dtype=np.int32).tobytes()
                continue
            raw = word.encode("utf-8")
            if len(raw) <= SHORT:
                by_width.setdefault((len(raw) - 1).bit_length(), []).append((word, raw))
                continue
            if self.rank_of is None:
                self.rank_of = dict(zip(self.vocabulary["keys"].tolist(), self.vocabulary["ranks"].tolist(), strict=True))
            self.known[word] = merge_alone(raw, self.vocabulary, self.rank_of).tobytes()
        for group in by_width.values():
            for at in range(0, len(group), 4096):
                part = group[at:at + 4096]
                for (word, _), ids in zip(part, merge_together([r for _, r in part], self.vocabulary), strict=True):
                    self.known[word] = ids.tobytes()

    def encode(self, texts):
        """For each text its ids as bytes of 32-bit numbers."""
        split = [self.pieces(text) for text in texts]
        new = set().union(*split) - self.known.keys()
        if len(self.known) + len(new) > self.kept_words:
            self.known.clear()
            new = set().union(*split)
        self.learn(new)
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]


def pieces_of(lengths):
    """Slices of a batch that hold about PIECE bytes each, by the lengths of its texts."""
    start = held = 0
    for n, length in enumerate(lengths):
        held += length
        if held >= PIECE:
            yield start, n + 1
            start, held = n + 1, 0
    if start < len(lengths):
        yield start, len(lengths)


def encode(df, path, text_col="text", ids_col="ids", kept_words=None, decoded_col=None):
    """df without its text column and with ids_col, the token ids of the whole text.

    path: a byte-level BPE tokenizer file, read once by the driver and broadcast (the file bounds
    its size). Special tokens inside a text become their own ids. Null or empty text: no ids. An
    existing column named ids_col is replaced. Rows are independent, so repeated rows, ties and
    empty tables need no rule. Arrow batches are cut into pieces of bounded size; a task remembers
    up to kept_words words (KEPT_WORDS if not given). With decoded_col, the ids are decoded again
    piece by piece, as decode does, by the same Python worker: two operators in a row would keep
    two of them for each task.
    """
    shared = df.sparkSession.sparkContext.broadcast(load_vocabulary(path))
    added = [ids_col] if decoded_col is None else [ids_col, decoded_col]
    rest = [c for c in df.columns if c not in (text_col, *added)]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        encoder = Encoder(shared.value, kept_words)
        tokens = token_table(shared.value["bytes"])
        for batch in batches:
            column = batch.column(len(rest))
            lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist()
            for a, b in pieces_of(lengths):
                found = encoder.encode([t or "" for t in column.slice(a, b - a).to_pylist()])
                ends = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(found), dtype=np.int32))
                ids = pa.ListArray.from_arrays(pa.array(ends), values)
                columns = [batch.column(k).slice(a, b - a) for k in range(len(rest))] + [ids]
                if decoded_col is not None:
                    columns.append(pa.array(texts_of(ids, tokens), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*rest, *added])

    source = df.select(*rest, F.col(text_col).cast("string"))
    schema = df.select(*rest).schema.add(ids_col, T.ArrayType(T.IntegerType()))
    if decoded_col is not None:
        schema = schema.add(decoded_col, T.StringType())
    return source.mapInArrow(run, schema)


def token_table(tokens):
    """Arrow array of the bytes of each id, and of no bytes behind them."""
    import pyarrow as pa

    return pa.array([*tokens, b""], pa.binary())


def texts_of(ids, tokens):
    """The text of each list of ids; tokens is a token_table."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    number = ids.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
    number = np.where((number >= 0) & (number < len(tokens) - 1), number, len(tokens) - 1)
    lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    joined = []
    ends = np.cumsum([0, *lengths])
    step = 256
    for a in range(0, len(lengths), step):
        cut = ends[a:a + step + 1]
        part = tokens.take(pa.array(number[cut[0]:cut[-1]]))
        lists = pa.ListArray.from_arrays(pa.array((cut - cut[0]).astype(np.int32)), part)
        joined += [x.as_py().decode("utf-8", "replace") for x in pc.binary_join(lists, b"")]
    return joined


def decode(df, path, ids_col="ids", text_col="decoded"):
    """df with text_col, the text of its ids (kept). Bytes that are not UTF-8 become U+FFFD, ids
    outside the vocabulary are passed over, null ids give an empty text."""
    shared = df.sparkSession.sparkContext.broadcast(load_vocabulary(path)["bytes"])
    rest = [c for c in df.columns if c != text_col]
    place = rest.index(ids_col)

    def run(batches):
        import pyarrow as pa

        tokens = token_table(shared.value)
        for batch in batches:
            joined = texts_of(batch.column(place), tokens)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(joined, pa.string())], [*rest, text_col])

    return df.select(*rest).mapInArrow(run, df.select(*rest).schema.add(text_col, T.StringType()))


def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def round_trip(docs, path):
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the whole texts."""
    return encode(docs.select("doc_id", "text"), path, decoded_col="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha256(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )


def op1(spark, sf_dir):
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())
