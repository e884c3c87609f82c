"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing column names."""

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row string, ids string, fp string, "
    "n_removed string, scores string, rk string, node string, text_ string"
)
LONG = "one line of words that goes on\n" * 3000


def documents(spark, texts=(), source="s"):
    rows = [(1, None), (2, ""), (3, "  \n\t"), (4, LONG), (5, "née Ünï 日本語 😀 word"), (6, "same text here"),
            (6, "same text here"), (7, "same text here"), (None, "no id at all"), (None, None)]
    rows += [(100 + i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        [(i, t, None if i == 3 else "en", None if i == 5 else f"{source}{i or 0}", None if i == 4 else len(t or ""),
          "a", "b", "c", "d", "e", "f", "g", "h") for i, t in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
