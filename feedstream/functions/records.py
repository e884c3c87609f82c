"""JSON records and display values."""

from pyspark.sql import functions as F


def to_json_record(*columns):
    """The columns as one JSON text; NULL fields are left out."""
    return F.to_json(F.struct(*(columns or ("*",))))


def percent(part, whole):
    """part / whole in percent, 0 where there is nothing to divide by."""
    return F.when(whole > 0, part * F.lit(100.0) / whole).otherwise(F.lit(0.0))
