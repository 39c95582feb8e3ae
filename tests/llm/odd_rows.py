"""Rows that every operator has to take."""

from __future__ import annotations

SF_DIR = "/root/testdata/sf0.001"

# Null and repeated ids and rows, null, empty and blank texts, ties, a very long text, and columns that the operators
# use as names of their own.
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
ODD = [
    (1, "Same text of some six words", "x"), (2, "SAME text of some six words", None), (2, "SAME text of some six words", None),
    (None, "same text of some six words", "y"), (None, None, None), (3, None, "z"), (4, "", ""), (5, " \t\n", "a"), (6, LONG, "b"),
    (7, LONG, "b"), (7, "other text of an id that repeats", "c"), (8, "one", "d"), (9, "ONE", "d"), (-5, "é È ß 漢字 🙂 words", "e"),
]
SCHEMA = "doc_id long, text string, source string"
CLASH = ["row", "node", "head", "print", "start", "key", "word", "n", "bin", "item", "label", "cell", "__row", "__id", "lang", "digest", "template"]


def extra(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash") for c in CLASH})
