"""Raw records -> typed columns."""

from pyspark.sql import functions as F, types as T

from feedstream.schemas import ARTICLE_SCHEMA, RESULT_SCHEMA

CORRUPT = "_corrupt_record"


def decode(df, value="value", keep=()):
    """Binary message body -> JSON text."""
    return df.select(*keep, F.col(value).cast("string").alias("json"))


def parse_json(df, schema, json="json", keep=()):
    """One column per schema field; a bad or missing record gives NULL in all of them.

    The struct is unpacked by ``inline`` and not by ``data.*``: a later filter on a field then
    stays above the parser, and no record is parsed twice.
    """
    return df.select(*keep, F.inline(F.array(F.from_json(json, schema))))


def parse_articles(df, json="json", keep=()):
    return parse_json(df, ARTICLE_SCHEMA, json, keep)


def parse_results(df, json="json", keep=()):
    return parse_json(df, RESULT_SCHEMA, json, keep)


def flag_corrupt(df, schema=ARTICLE_SCHEMA, json="json", keep=()):
    """As parse_json, plus ``is_corrupt`` and the raw text of records that do not parse."""
    flagged = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = df.select(
        *keep,
        F.inline(F.array(F.from_json(json, flagged, {"columnNameOfCorruptRecord": CORRUPT}))),
    )
    return parsed.withColumns({
        "is_corrupt": F.col(CORRUPT).isNotNull(),
        "raw": F.col(CORRUPT),
    }).drop(CORRUPT)
