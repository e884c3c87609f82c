"""Linear models on words: features, selection of informative ones, and logistic regression.

Models are fitted on a bounded sample of rows, which the driver holds as feature numbers; counts
for the selection are aggregated on the executors, and scoring covers every row.
"""

from pyspark.sql import functions as F, types as T

MARKS = ".,;:!?\"'()[]{}*#$%&|<>-_/\\"
KEPT_TOKENS = 50_000  # a task forgets its tokens beyond this number and starts again
ROWS = 1000  # texts whose features are held at once


def token_features(token):
    """Word, its first letters (which inflected and compound forms share), and its shape."""
    core = token.lower().strip(MARKS)
    shape, last = "", ""
    for c in token:
        kind = "0" if c.isdigit() else c if not c.isalpha() else "A" if c.isupper() else "a"
        if kind != last:
            shape, last = shape + kind, kind
    return {f"w:{core}", f"4:{core[:4]}", f"5:{core[:5]}", f"s:{shape}"}


def feature_reader(number=None):
    """text -> set of its features, or of their numbers where `number` maps the known ones."""
    known = {}

    def read(text):
        tokens = set(text.split())
        if len(known) > KEPT_TOKENS:
            known.clear()
        found = set()
        for token in tokens:
            own = known.get(token)
            if own is None:
                own = token_features(token)
                own = tuple(own if number is None else {number[f] for f in own if f in number})
                known[token] = own
            found.update(own)
        return found

    return read


def bounded_sample(keys, bound, seed):
    """Rows of keys, about `bound` of them and the same ones each time, by a hash of doc_id."""
    total = keys.count()
    if total <= bound:
        return keys
    part = 1 << 30
    return keys.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(part)) < int(part * bound / total))


def select_features(rows, labels, size):
    """feature -> number: the `size` features whose presence differs most between the classes of
    any label, by the z score of the two shares. rows: text and the 0/1 columns in labels."""
    def run(batches):
        from collections import Counter

        import pyarrow as pa

        read = feature_reader()
        for batch in batches:
            flags = [batch.column(x).to_pylist() for x in labels]
            seen, ones = Counter(), [Counter() for _ in labels]
            for n, text in enumerate(batch.column("text").to_pylist()):
                found = read(text or "")
                seen.update(found)
                for flag, one in zip(flags, ones, strict=True):
                    if flag[n]:
                        one.update(found)
            names = list(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([seen[f] for f in names], pa.int64())]
                + [pa.array([one[f] for f in names], pa.int64()) for one in ones], ["feature", "n", *labels])

    counts = rows.select("text", *labels).mapInArrow(
        run, "feature string, n long, " + ", ".join(f"{x} long" for x in labels))
    total = rows.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in labels]).first()
    grouped = counts.groupBy("feature").agg(F.sum("n").alias("n"), *[F.sum(x).alias(x) for x in labels])
    score = F.lit(0.0)
    for x in labels:
        one, zero = total[x], total["n"] - total[x]
        if one and zero:
            share = F.col("n") / F.lit(total["n"])
            spread = F.sqrt(share * (1 - share) * (1 / one + 1 / zero)) + 1e-9
            score = F.greatest(score, F.abs(F.col(x) / one - (F.col("n") - F.col(x)) / zero) / spread)
    best = grouped.where("n > 2").orderBy(score.desc(), "feature").limit(size).select("feature").collect()
    return {r["feature"]: n for n, r in enumerate(best)}


def with_features(rows, number, text_col="text"):
    """rows with `x`, the sorted numbers of the known features of the whole text, without the text."""
    shared = rows.sparkSession.sparkContext.broadcast(number)
    rest = [c for c in rows.columns if c not in (text_col, "x")]

    def run(batches):
        import pyarrow as pa

        read = feature_reader(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                x = [sorted(read(t or "")) for t in batch.column(len(rest)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(x, pa.list_(pa.int32()))], [*rest, "x"])

    return rows.select(*rest, text_col).mapInArrow(
        run, rows.select(*rest).schema.add("x", T.ArrayType(T.IntegerType())))


class Matrix:
    """Rows of binary features and of further dense columns."""

    def __init__(self, lists, width, dense=None):
        import numpy as np

        self.width = width
        self.lengths = np.array([len(x) for x in lists], dtype=np.int64)
        self.flat = np.concatenate([np.asarray(x, dtype=np.int64) for x in lists]) if len(lists) else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(len(lists)), self.lengths)
        self.dense = np.zeros((len(lists), 0)) if dense is None else np.asarray(dense, dtype=float)

    def take(self, rows):
        import numpy as np

        ends = np.cumsum(self.lengths)
        return Matrix([self.flat[ends[r] - self.lengths[r]:ends[r]] for r in rows], self.width, self.dense[rows])

    def plus(self, columns):
        import numpy as np

        other = Matrix([], self.width)
        other.lengths, other.flat, other.row = self.lengths, self.flat, self.row
        other.dense = np.column_stack([self.dense, columns])
        return other

    def times(self, model):
        import numpy as np

        sparse = np.bincount(self.row, weights=model["w"][self.flat], minlength=len(self.lengths))
        return sparse + self.dense @ model["d"] + model["b"]


def sigmoid(z):
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(matrix, y, steps=200, rate=0.1, penalty=1e-4):
    """Logistic regression by full-batch Adam. One class only: a constant model of that class."""
    import numpy as np

    y = np.asarray(y, dtype=float)
    rows, width, dense = len(y), matrix.width, matrix.dense.shape[1]
    share = (y.sum() + 0.5) / (rows + 1.0)
    theta = np.zeros(width + dense + 1)
    theta[-1] = np.log(share / (1 - share))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1 if rows and 0 < y.sum() < rows else 1):
        model = {"w": theta[:width], "d": theta[width:-1], "b": theta[-1]}
        miss = (sigmoid(matrix.times(model)) - y) / rows
        grad = np.concatenate([
            np.bincount(matrix.flat, weights=miss[matrix.row], minlength=width), matrix.dense.T @ miss, [miss.sum()]])
        grad[:-1] += penalty * theta[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        theta = theta - rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return {"w": theta[:width], "d": theta[width:-1], "b": float(theta[-1])}


def folds_of(ids, count):
    """Fold of each id, the same each time."""
    import numpy as np
    from xxhash import xxh64_intdigest

    return np.array([xxh64_intdigest(str(i), 7) % count for i in ids], dtype=np.int64)


def out_of_fold(matrix, y, fold, count):
    """Scores (before the sigmoid) of each row by a model that has not seen the row's fold."""
    import numpy as np

    scores = np.zeros(len(y))
    for k in range(count):
        inside = np.flatnonzero(fold == k)
        if len(inside):
            outside = np.flatnonzero(fold != k)
            scores[inside] = matrix.take(inside).times(fit(matrix.take(outside), y[outside]))
    return scores


def best_threshold(p, y):
    """Probability that gives the best F1, halfway to the next lower one; 0.5 without both classes."""
    import numpy as np

    if not 0 < y.sum() < len(y):
        return 0.5
    order = np.argsort(-p)
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][p[order][:-1] == p[order][1:]] = 0
    at = int(np.argmax(f1))
    below = p[order][at + 1] if at + 1 < len(y) else 0.0
    return float((p[order][at] + below) / 2)
