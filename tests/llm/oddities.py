"""Frames with everything a table may hold: nulls, empty and very long texts, ties, repeated rows, clashing names."""

LONG = "lorem ipsum dolor sit amet " * 40_000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [
    (1, "the cat sat on the mat and looked at the dog", "en", "a", 44),
    (2, "the cat sat on the mat and looked at the dog", "en", "a", 44),
    (2, "the cat sat on the mat and looked at the dog", "en", "a", 44),
    (3, "", "en", "b", 0),
    (4, "", None, None, 0),
    (5, None, "en", "a", None),
    (5, None, "en", "a", None),
    (None, "a document that has no id at all but some words", None, "b", 3),
    (None, None, None, None, None),
    (6, LONG, "la", "a", len(LONG)),
    (7, "!!! ??? ###", "xx", "", 11),
    (8, "word", "en", "b", 4),
]


def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(spark):
    """Extra columns called like the operators' own, one of them like text but for its case."""
    extra = ["TEXT", "c0", "c1", "key", "rank", "digest", "bucket", "copies", "copy", "rule_number", "node", "rows", "a.b"]
    df = spark.createDataFrame([(*r, *[f"{n}{i}" for n in extra]) for i, r in enumerate(ROWS)], SCHEMA + ", " + ", ".join(f"`{n}` string" for n in extra))
    return df, extra


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)
