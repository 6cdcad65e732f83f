"""Small inputs that every operator has to bear."""

from __future__ import annotations

import duckdb

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use themselves; they must neither clash nor get lost
CLASHING = (
    "size", "score", "value", "slot", "before", "label", "row", "part", "word", "n", "key", "node", "cell", "block",
    "start", "kind", "__id", "__key", "__x", "__text", "__n", "target", "epochs", "times", "rank", "component_id",
)


def documents(spark, rows, clashing: bool = False):
    """``rows``: (doc_id, text, lang, source)."""
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA)
    if clashing:
        df = df.selectExpr("*", *[f"'x{i}' AS {c}" for i, c in enumerate(CLASHING)])
    return df


ODD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, "   \n\t ", "en", "a"),
    (4, "One short text.", "en", None),
    (5, "word " * 60_000, "en", "a"),
    (6, "Ünïcödé 日本語 text with é and 　 blanks \x1c here", "de", "b"),
    (7, "The same text twice, or so it seems to all of them.", "en", "b"),
    (7, "The same text twice, or so it seems to all of them.", "en", "b"),
    (8, "The same text twice, or so it seems to all of them.", "en", "b"),
    (None, "A text without an id is a text like any other one.", "fr", "c"),
    (9, "123 456 !!! ???", None, "c"),
]


def read(table: str):
    return duckdb.connect().sql(f"SELECT * FROM '{SF}/{table}.parquet'").fetchdf()
