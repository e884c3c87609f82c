"""Vector measures on array columns."""

from pyspark.sql import functions as F


def dot(a, b):
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(a):
    return F.sqrt(dot(a, a))


def cosine(a, b):
    """Cosine of two vectors, NULL where one has no length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def argmax_index(scores):
    """Position (from 0) of the largest score; the first of equal ones."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def label_of(index, labels):
    """Label at a position (from 0)."""
    return F.element_at(F.array(*map(F.lit, labels)), index + 1)


def argmax_label(scores, labels):
    return label_of(argmax_index(scores), labels)
