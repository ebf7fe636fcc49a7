"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

LONG = "alpha beta gamma delta. " * 5_000
DOCS = [
    (1, "The quick brown fox jumps over the lazy dog.", "en", "a", 44),
    (1, "The quick brown fox jumps over the lazy dog.", "en", "a", 44),
    (2, None, "en", "a", None),
    (3, "", None, "b", 0),
    (4, " \n\t ", "fr", None, 4),
    (None, "a row without an id", "en", "b", 19),
    (5, LONG, "en", "hot", len(LONG)),
    (6, LONG, "en", "hot", len(LONG)),
    (7, "çà et là — ☃ 漢字 𝒳   ß İ", "fr", "b", 20),
    (8, "12345 67890 !!! ???", None, None, 19),
]
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("fp", "id", "component_id", "_row", "kept", "n_words", "size", "shard", "slot", "rate", "copy", "score", "value", "part", "held_out", "x",
            "first", "sums", "bytes", "weight", "n", "value_sha256", "_draw", "_copy", "_id", "_text", "component", "root", "lang_pred", "html", "key")


def docs(spark):
    return spark.createDataFrame(DOCS, DOC_SCHEMA)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def clashing(spark):
    """The same rows with further columns whose names operators use themselves."""
    return docs(spark).selectExpr("*", *[f"cast(7 as int) as {c}" for c in CLASHING])
