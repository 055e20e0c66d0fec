"""Small tables with every awkward row: nulls, empty and long texts, ties,
repeats, and columns whose names operators use themselves."""

from __future__ import annotations

LONG = "so it goes on and on without an end " * 3000
DOC_DDL = "doc_id long, text string, lang string, source string, n_chars long, score double, copy int, n int, r string, host string"

ROWS = [
    (1, "one two three four five six seven", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, "b"),
    (4, "   \n\t ", "de", None),
    (5, LONG, "de", "a"),
    (6, "one two three four five six seven", "en", "a"),
    (6, "one two three four five six seven", "en", "a"),
    (7, "word", None, None),
    (None, "a row without an id", "fr", "b"),
    (None, None, None, None),
    (8, "Ünïcode ẞ 漢字   x\u0085y é 😀 <|endoftext|> Σ", "fr", "b"),
]


def docs(spark, rows=ROWS):
    full = [(i, t, lang, src, None if t is None else len(t), 0.5, 3, 1, "r", "h") for i, t, lang, src in rows]
    return spark.createDataFrame(full, DOC_DDL)


def empty(spark):
    return spark.createDataFrame([], DOC_DDL)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
