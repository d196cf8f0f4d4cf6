"""Small frames with the cases every operator must take."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns of operators' own making, which documents may bring along too.
CLASHING = ("key", "node", "row", "line", "score", "emptied", "marked", "piece", "class_id", "label", "similarity",
            "term", "spans", "block", "place", "listed", "_held", "_copy", "_text", "_body", "_doc", "n_lines")


def sentence(seed: int, count: int, stem: str = "w") -> str:
    rng = random.Random(seed)
    return " ".join(f"{stem}{rng.randrange(10_000)}" for _ in range(count))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, repeated ids and rows."""
    same = sentence(1, 60)
    return [
        (1, same, "en", "a", 5), (2, same, None, None, None), (3, None, "en", "a", 0), (4, "", "de", "b", 0),
        (None, same, "en", "a", 1), (None, None, None, None, None), (7, sentence(2, 30_000), "en", "c", 9),
        (8, " \n\t\n ", "fr", "a", 5), (9, "…!!! ???", "fr", "a", 5), (4, "", "de", "b", 0), (4, "other text", "de", "b", 0),
        (10, "漢字 😀 é ñ", "xx", "a", 4), (11, "x" * 50_000, "en", "a", 50_000),
    ]


def documents(spark, rows, clashing: bool = False):
    frame = spark.createDataFrame(rows, DOCS)
    if clashing:
        from pyspark.sql import functions as F
        frame = frame.withColumns({name: F.lit(f"own {name}") for name in CLASHING})
    return frame


def texts(spark, *values):
    return documents(spark, [(n, value, "en", f"s{n}", 0) for n, value in enumerate(values)])
