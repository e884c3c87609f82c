"""Spelling variants: words one letter apart, by a dictionary of pairs of trie nodes."""

from pyspark.sql import Window, functions as F

from feedstream.llm.common import ascii_lower, stored

MIN_CHARS = 7
MIN_COUNT = 2
FACTOR = 10
PART_WORDS = 200_000  # words that one task numbers
PART_BITS = 36  # a part numbers fewer than 2 ** PART_BITS nodes
BATCH = 4096


def counted(words, min_chars=MIN_CHARS, min_count=MIN_COUNT):
    """(word, n) of the words (word) of at least min_chars code points found min_count times or more."""
    return words.where(F.char_length("word") >= min_chars).groupBy("word").agg(
        F.count("*").alias("n")).where(F.col("n") >= min_count)


def common_prefix(a, b):
    """Length of the longest common prefix."""
    least = min(len(a), len(b))
    if a[:least] == b[:least]:
        return least
    low = 0
    while least - low > 1:
        mid = (low + least) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            least = mid
    return low


def border_numbers(bounds):
    """{part: (numbers of the prefixes that its first word shares with the part before, the same of
    its last word and the part after)}, from (part, first word, last word) in order. Parts follow each
    other in the order of words, so these are the only trie nodes that several parts see."""
    shared, counter = [[]], 0
    for k in range(1, len(bounds)):
        size = common_prefix(bounds[k - 1][2], bounds[k][1])
        old = shared[-1][:min(size, common_prefix(bounds[k - 1][1], bounds[k][1]))]
        shared.append([*old, *(-1 - counter - i for i in range(size - len(old)))])
        counter += size - len(old)
    shared.append([])
    return {part: (shared[k], shared[k + 1]) for k, (part, _, _) in enumerate(bounds)}


def numbered(words, key, name, with_ids=False):
    """(id, n, nodes, last) of words (id or none, n, key) that are distinct in the string column key.

    nodes holds the numbers of the trie nodes of the prefixes of key, by length from 0; equal numbers
    mean equal prefixes, over all rows. `last` says of each letter whether the next one differs. The
    words are put in order over parts, and a sweep numbers a node where its first word is met. With
    with_ids every word gets an id, in the order of words. Words may be of any length: time and
    memory grow with the letters, not with the letters of all prefixes.
    """
    spark = words.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), words.count() // PART_WORDS + 1)
    placed = stored(words.repartitionByRange(parts, key).withColumn("part", F.spark_partition_id()), f"{name}-parts")
    ends = placed.groupBy("part").agg(F.min(key).alias("first"), F.max(key).alias("last")).collect()
    bounds = sorted((r["part"], r["first"], r["last"]) for r in ends)
    # One row a part: the words at its ends, and what it shares with its neighbours.
    border = border_numbers(bounds)
    shared = spark.sparkContext.broadcast({
        p: (first[:len(border[p][0])], border[p][0], last[:len(border[p][1])], border[p][1]) for p, first, last in bounds})

    def run(batches):
        import pyarrow as pa

        part, place, counter, before, nodes = None, 0, 0, "", [0]
        head, head_ids, tail, tail_ids = "", [], "", []
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                ids, lists, lasts = [], [], []
                for p, word in zip(batch.column("part").to_pylist(), batch.column(key).to_pylist(), strict=True):
                    if p != part:
                        part, place, counter, before, nodes = p, 0, 0, "", [0]
                        head, head_ids, tail, tail_ids = shared.value[p]
                    keep = common_prefix(before, word)
                    del nodes[keep + 1:]
                    for own, own_ids in ((head, head_ids), (tail, tail_ids)):
                        if own_ids and len(nodes) <= len(own_ids):
                            nodes += own_ids[len(nodes) - 1:common_prefix(own, word)]
                    new = len(word) + 1 - len(nodes)
                    start = (p + 1 << PART_BITS) + counter
                    nodes += range(start, start + new)
                    counter += new
                    before = word
                    ids.append((p << PART_BITS) + place)
                    place += 1
                    lists.append(nodes.copy())
                    lasts.append([a != b for a, b in zip(word, [*word[1:], None], strict=False)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()) if with_ids else batch.column("id"), batch.column("n"), batch.column(key),
                     pa.array(lists, pa.list_(pa.int64())), pa.array(lasts, pa.list_(pa.bool_()))],
                    ["id", "n", key, "nodes", "last"])

    columns = ["n", key, "part"] if with_ids else ["id", "n", key, "part"]
    ordered = placed.select(*columns).repartition(parts, "part").sortWithinPartitions("part", key)
    return ordered.mapInArrow(run, f"id long, n long, {key} string, nodes array<long>, last array<boolean>")


def pairs(forward, backward):
    """(p, s, gap, canon, id, n): the pairs of a prefix node and a suffix node of every word, with the
    letter between them skipped (gap) and without a letter between. A letter can be left out of a run
    of equal letters anywhere with the same result; `canon` marks the last of a run."""
    size = F.size("last")
    places = F.sequence(F.lit(0), size)
    skipped = F.transform(F.filter(places, lambda i: i < size), lambda i: F.struct(
        F.get("nodes", i).alias("p"), F.get("rest", size - 1 - i).alias("s"), F.lit(True).alias("gap"),
        F.get("last", i).alias("canon")))
    split = F.transform(places, lambda i: F.struct(
        F.get("nodes", i).alias("p"), F.get("rest", size - i).alias("s"), F.lit(False).alias("gap"),
        F.lit(False).alias("canon")))
    both = forward.join(backward.select("id", F.col("nodes").alias("rest")), "id")
    return both.select("id", "n", F.inline(F.concat(skipped, split))).select("p", "s", "gap", "canon", "id", "n")


def near(found):
    """(id, n_near, best_n, best_id) of the words that have a near one, from their pairs.

    Words that skip a letter at one place and agree else share a pair; a word without the letter
    is split there. So a pair holds one word for each letter of the alphabet and one more at most: the
    rows of a pair are few, however common a prefix or suffix is. Every row sums up its own neighbours.
    """
    row = F.struct("n", "id", "gap", "canon")
    together = found.withColumn("rows", F.collect_list(row).over(Window.partitionBy("p", "s")))
    others = F.filter("rows", lambda r: (r["id"] != F.col("id")) & F.when(
        F.col("gap"), r["gap"] | F.col("canon")).otherwise(r["gap"] & r["canon"]))
    each = together.where(F.size("rows") > 1).select("id", others.alias("rows")).where(F.size("rows") > 0)
    order = F.array_max(F.transform("rows", lambda r: F.struct(r["n"].alias("n"), (-r["id"]).alias("id"))))
    return each.select("id", F.size("rows").alias("k"), order.alias("best")).groupBy("id").agg(
        F.sum("k").alias("n_near"), F.max("best").alias("best")).select(
        "id", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.id")).alias("best_id"))


def roots(forms):
    """(id, root) of forms (id, form): where the forms lead. Each round doubles the steps a word has gone."""
    way = stored(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        step = way.select(F.col("id").alias("root"), F.col("root").alias("next"))
        gone = stored(way.join(step, "root", "left").select("id", F.coalesce("next", "root").alias("root"),
                                                              F.col("next").isNotNull().alias("moved")), "roots")
        way = gone.drop("moved")
        if gone.where("moved").isEmpty():
            return way


def spelling_variants(words, factor=FACTOR):
    """(word, form, root, n, n_near, form_n) of words (word distinct and not null, n): how often a word
    is found, how many words are near, and the form it is a variant of.

    Near words differ in exactly one inserted, deleted or replaced code point. A word's form is its
    near word of the largest n (of equal ones the first in code-point order), if that n is at least
    `factor` (over 1) times its own, else null. root follows the forms to the last, and is the word
    itself without a form. An empty table gives no rows.
    """
    forward = stored(numbered(words.select("word", "n"), "word", "words", with_ids=True), "forward-nodes")
    backward = numbered(forward.select("id", "n", F.reverse("word").alias("reversed")), "reversed", "reversed")
    known = stored(near(pairs(forward.drop("word"), backward)), "near-words")
    vocabulary = forward.select("id", "word", "n")
    has = vocabulary.drop("word").join(known, "id").where(F.col("best_n") >= factor * F.col("n"))
    forms = stored(has.select("id", F.col("best_id").alias("form"), F.col("best_n").alias("form_n")), "forms")
    named = forms.join(roots(forms), "id")
    for c in ("form", "root"):
        named = named.join(vocabulary.select(F.col("id").alias(c), F.col("word").alias(f"{c}_word")), c)
    return vocabulary.join(known.select("id", "n_near"), "id", "left").join(
        named.select("id", "form_word", "root_word", "form_n"), "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def runs(docs, min_chars=MIN_CHARS, id_col="doc_id", text_col="text"):
    """(word) of every run of letters of min_chars or more, A-Z lower-cased; of one in 31 by the crc32
    of id and run a letter is left out. A null text has no runs, a null id counts as an empty one.
    A run is dropped early only if it is too short before a letter goes."""
    found = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(r"[A-Za-zÀ-ÿ]{%d,}" % min_chars), F.lit(0))
    each = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run")
    ).select("id", ascii_lower(F.col("run")).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    place = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.char_length("run")))
    return each.withColumn("h", h).select(F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run")).alias("word"))


def op12(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return spelling_variants(stored(counted(runs(docs)), "vocabulary"))
