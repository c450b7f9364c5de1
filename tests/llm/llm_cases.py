"""Rows that every operator has to bear: nulls, empty and very long texts,
ties, repeated rows, and columns with clashing names."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (None, None, None, None, None),
    (None, "x y", "en", None, 3),
    (9001, "", "en", "s1", 0),
    (9002, " \n\t ", "en", "s1", 4),
    (9003, "one", None, "s2", 3),
    (9004, "tie tie tie tie", "en", "s2", 15),
    (9004, "tie tie tie tie", "en", "s2", 15),
    (9005, "long " * 30000, "en", "s1", 150000),
]
CLASHES = ["row", "chunk", "_chunk", "node", "doc", "copies", "copy", "h", "w", "t", "n", "seg", "ids", "score", "part", "size"]


def with_clashes(df):
    for c in CLASHES:
        if c not in df.columns:
            df = df.withColumn(c, F.lit("clash"))
    return df


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
