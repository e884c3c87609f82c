"""Quality scores by co-training a text view and a metadata view."""

from pyspark.sql import functions as F

from feedstream.llm.common import stored
from feedstream.llm.learn import (
    Matrix, best_threshold, bounded_sample, fit, folds_of, out_of_fold, select_features, sigmoid, with_features)

SAMPLE = 10_000  # labelled rows, and as many that a view names, that models are fitted on, at most about
FEATURES = 512
ROUNDS = 3
SHARE = 0.05  # of the unlabelled rows that a view may name per round
FOLDS = 3
BITS = 1 << 25  # of the bitmap of labelled ids: 4 MB
SOURCES, LANGS = 64, 16  # hash buckets of the metadata view


def metadata(rows):
    """rows with `meta`, the numbers of the hashed source and language and of the length's order of
    magnitude (null values have their own), in place of those columns."""
    size = F.when(F.col("n_chars").isNull(), 0).otherwise(
        F.least(F.floor(F.log2(F.greatest(F.col("n_chars"), F.lit(0)) + 1.0) * 2), F.lit(62)) + 1)
    return rows.select(
        *[c for c in rows.columns if c not in ("source", "lang", "n_chars")],
        F.array(
            F.pmod(F.xxhash64("source"), F.lit(SOURCES)).cast("int"),
            (SOURCES + F.pmod(F.xxhash64("lang"), F.lit(LANGS))).cast("int"),
            (SOURCES + LANGS + size).cast("int")).alias("meta"))


META = SOURCES + LANGS + 64


def surest(counts, n):
    """(bin, share): the n surest rows are those beyond the bin and that share of the bin itself;
    counts maps bins over 0 to numbers of rows."""
    edge, share = 1, 1.0
    for edge in sorted(counts, reverse=True):
        if counts[edge] >= n:
            share = n / counts[edge]
            break
        n -= counts[edge]
    return edge, share


def named_rows(pool, name, width, model, good, share, bound):
    """(doc_id, x, meta, good) of the rows of pool (doc_id, draw, x, meta) that a view is surest of:
    `share` of all rows, in the proportion of the classes, by counts of its scores over the whole
    pool. Of more than about `bound` such rows that many are drawn."""
    shared = pool.sparkSession.sparkContext.broadcast(model)

    def bins(batch):
        import numpy as np

        z = np.clip(Matrix([v.values.to_numpy() for v in batch.column(name)], width).times(shared.value), -30, 30)
        return (np.sign(z) * np.ceil(np.abs(z) * 100)).astype(np.int64)

    def count(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            found = np.unique(bins(batch), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["bin", "n"])

    counts = {r["bin"]: r["n"] for r in pool.select(name).mapInArrow(count, "bin long, n long").groupBy("bin").agg(
        F.sum("n").alias("n")).collect()}
    n = int(sum(counts.values()) * share)
    edges = [(-1, *surest({-b: c for b, c in counts.items() if b < 0}, round(n * (1 - good)))),
             (1, *surest({b: c for b, c in counts.items() if b > 0}, round(n * good)))]
    part = min(1.0, bound / max(n, 1))

    def take(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            found, draw = bins(batch), batch.column("draw").to_numpy()
            second = draw * 1024 % 1
            for sign, edge, portion in edges:
                key = found * sign
                rows = np.flatnonzero(((key > edge) | (key == edge) & (draw < portion)) & (second < part))
                chosen = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [chosen.column("doc_id"), chosen.column("x"), chosen.column("meta"),
                     pa.array(np.full(len(rows), float(sign > 0)))], ["doc_id", "x", "meta", "good"])

    kind = pool.schema["doc_id"].dataType.simpleString()
    return pool.select("doc_id", "draw", "x", "meta").mapInArrow(
        take, f"doc_id {kind}, x array<int>, meta array<int>, good double").collect()


def co_train(labelled, pool, features, rounds=ROUNDS, share=SHARE, sample=SAMPLE):
    """Models of both views, their calibrations and their combination.

    Each round both views are fitted; each scores all unlabelled rows and names those it is surest
    of, in the proportion of the classes, and the other view learns from them from then on, from
    at most about `sample` of them in all. Views are calibrated and combined by logistic
    regressions on scores of the labelled rows by models that have learned from the other folds
    and from the same named rows as the view itself.
    """
    import numpy as np

    y = labelled["good"].to_numpy(dtype=float)
    views = [("x", max(features, 1)), ("meta", META)]
    taught = [{}, {}]  # doc_id -> features and class, per view

    def lessons(view):
        told = [taught[view][r] for r in sorted(taught[view])]
        lists = labelled[views[view][0]].tolist() + [r[0] for r in told]
        return Matrix(lists, views[view][1]), np.concatenate([y, [r[1] for r in told]])

    good = y.mean() if len(y) else 0.5
    for _ in range(rounds):
        for view in (0, 1):
            name, width = views[view]
            for r in named_rows(pool, name, width, fit(*lessons(view)), good, share, sample / rounds):
                taught[1 - view].setdefault(r["doc_id"], (r[views[1 - view][0]], r["good"]))
    fold = folds_of(labelled["doc_id"], FOLDS)
    models, calibrations, calibrated = [], [], []
    for view in (0, 1):
        matrix, told = lessons(view)
        models.append(fit(matrix, told))
        always = np.full(len(told) - len(y), -1)  # in no fold, so every model learns from them
        held_out = out_of_fold(matrix, told, np.concatenate([fold, always]), FOLDS)[:len(y)]
        one = Matrix([[]] * len(y), 1, held_out[:, None])
        calibrations.append(fit(one, y))
        calibrated.append(one.times(calibrations[-1]))
    pair = Matrix([[]] * len(y), 1, np.column_stack(calibrated))
    both = fit(pair, y)
    final = sigmoid(pair.times(both))
    threshold = 1 - best_threshold(1 - final, 1 - y)
    return {"views": models, "calibrations": calibrations, "both": both, "threshold": threshold,
            "score": final, "y": y}


def with_views(docs, number, id_col="doc_id", text_col="text"):
    """(doc_id, rk, meta, x) of every row of docs, straight from the scan."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), text).alias("rk"), "source", "lang", "n_chars",
        text.alias("text"))
    return with_features(metadata(rows), number)


def labelled_texts(texts, named):
    """texts (doc_id, text) joined with named (doc_id, good). Only texts that `likely` lets pass are shuffled
    to the exact join, which is of one kind at any size of the labels."""
    return likely(texts, named).join(named.hint("merge"), "doc_id")


def likely(texts, named):
    """The texts whose id is in named, and few others: a bitmap of hashed ids, of BITS bits at most, drops
    the rest where they are read."""
    at, chunk = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(BITS)), 8 * 4096
    maps = stored(
        named.select(F.floor(at / chunk).alias("_chunk"), (at % chunk).alias("_at"))
        .groupBy("_chunk").agg(F.bitmap_construct_agg("_at").alias("_bits")), "quality-bitmap")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    placed = texts.withColumns({"_chunk": F.floor(at / chunk), "_at": at % chunk})
    passed = F.getbit(byte, (F.col("_at") % 8).cast("int")) == 1
    return placed.join(F.broadcast(maps), "_chunk").where(passed).select("doc_id", "text")


def co_trained(docs, labels, sample=SAMPLE, features=FEATURES):
    """(model, rows): what labels (doc_id, quality 0/1) teach, and the stored features of all docs.

    Features are selected on all labelled rows. Those of all rows are derived once, and the sample,
    the pool of unlabelled rows and the final scores are all drawn from them. Of several rows of an
    id the one with the smallest (rk, meta) teaches; rows with a null label count as unlabelled.
    """
    named = stored(labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col("quality").cast("int")).alias("good")), "quality-labels")
    known = labelled_texts(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), named)
    number = select_features(known, ["good"], features)
    rows = stored(with_views(docs, number), "quality-features")
    draw = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 40)) / float(1 << 40)
    once = stored(
        rows.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(F.struct("rk", "meta", "x")).alias("r"))
        .join(named, "doc_id", "left").select("doc_id", "good", draw.alias("draw"), "r.x", "r.meta"), "quality-once")
    labelled = bounded_sample(once.where("good is not null"), sample, 8).select(
        "doc_id", "good", "x", "meta").toPandas().sort_values("doc_id")
    model = co_train(labelled, once.where("good is null").drop("good"), len(number), sample=sample)
    return model | {"number": number}, rows


def train(docs, labels, sample=SAMPLE, features=FEATURES):
    """Models from labels and documents (`co_trained`), fitted on samples of at most about `sample`
    labelled rows and as many that the views name; all unlabelled rows are scored in every round."""
    return co_trained(docs, labels, sample, features)[0]


def score(docs, model, id_col="doc_id", text_col="text"):
    """(doc_id, rk, p_text, p_meta, quality, keep) of every row; docs has source, lang and n_chars.

    p_text and p_meta are the calibrated views, quality their combination, keep whether it reaches
    the threshold with the best F1 for bad rows. Null metadata has its own features, null or empty
    texts none; repeated rows get equal results; an empty table gives no rows.
    """
    return score_views(with_views(docs, model["number"], id_col, text_col), model)


def score_views(rows, model):
    """The result of `score` for rows (doc_id, rk, meta, x)."""
    shared = rows.sparkSession.sparkContext.broadcast(
        {k: model[k] for k in ("views", "calibrations", "both")} | {"width": max(len(model["number"]), 1)})

    def run(batches):
        import numpy as np
        import pyarrow as pa

        m = shared.value
        for batch in batches:
            calibrated = []
            for k, (name, width) in enumerate((("x", m["width"]), ("meta", META))):
                raw = Matrix([v.values.to_numpy() for v in batch.column(name)], width).times(m["views"][k])
                calibrated.append(Matrix([[]] * len(raw), 1, raw[:, None]).times(m["calibrations"][k]))
            final = Matrix([[]] * batch.num_rows, 1, np.column_stack(calibrated)).times(m["both"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rk"),
                 *(pa.array(sigmoid(z)) for z in (*calibrated, final))], ["doc_id", "rk", "p_text", "p_meta", "quality"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.select("doc_id", "rk", "x", "meta").mapInArrow(
        run, f"doc_id {kind}, rk long, p_text double, p_meta double, quality double")
    return found.withColumn("keep", F.col("quality") >= model["threshold"])


def op8(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model, rows = co_trained(docs, labels)
    return score_views(rows, model).select(
        "doc_id", *[F.round(c, 6).alias(c) for c in ("p_text", "p_meta", "quality")], "keep")
