"""Small tables with every awkward case, and the catalogue's test tables."""

from __future__ import annotations

import pandas as pd

SF = "/root/testdata/sf0.001"

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, recipe string, fp string, h string, "
    "node string, score string, size string, found string, kept string, part string, `__id` string, `__sha` string"
)
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()

TEXTS = [
    (0, "the quick brown fox jumps over the lazy dog"), (1, None), (2, ""), (3, " \t\n "), (4, "same text here"),
    (4, "same text here"), (5, "same  text\there"), (6, " ".join(WORDS[i * i % 10] for i in range(30_000))),
    (None, "a row without an id"), (None, "same text here"), (7, "1234"), (8, "é ü ß 日本語 😀"), (9, "x"),
    (10, "the quick brown fox jumps over the lazy dog"), (11, "\x0b\x0c odd \x1f space \xa0"), (12, "same text here"),
    (13, None), (13, None),
]


def edge_documents(spark):
    rows = [(i, t, None if k % 3 else "en", None if k % 2 else f"s{k % 4}", None, *["clash"] * 11) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df) -> list[tuple]:
    """Collected rows in an order of their own."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def documents(spark, sf: str = SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


def frame(spark, sf: str = SF) -> pd.DataFrame:
    return documents(spark, sf).toPandas()
