"""Small inputs with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

import duckdb

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, h1 string, spans string, lang_pred string, size string"


def docs(spark, rows):
    """documents with extra columns whose names the operators use themselves."""
    full = [(i, t, lang, src, None if t is None else len(t), "k", None, "s", "x", "y") for i, t, lang, src in rows]
    return spark.createDataFrame(full, DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


AWKWARD = [
    (1, "One line of text here\nShared line\n\nlast", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, "  \t\n ", "de", "b"),
    (5, "12345 !!", "de", "b"),
    (6, "x" * 5000, "fr", "c"),
    (7, "One line of text here\nShared line\n\nlast", "en", "a"),
    (7, "One line of text here\nShared line\n\nlast", "en", "a"),
    (None, "One line of text here\nShared line\n\nlast", None, None),
    (8, "Ünïcode \u2581 mark\u00a0and 漢字 🙂\r\nShared line ", "de", "c"),
    (9, "word " * 3000, "es", "b"),
]


def table(name: str, sf: str = SF):
    return duckdb.sql(f"SELECT * FROM '{sf}/{name}.parquet'").df()


def oracle(sql: str, sf: str = SF, **frames):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        if t in frames:
            con.register(t, frames[t])
        else:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con.execute(sql).df()


def sorted_rows(df):
    return sorted((tuple(r) for r in df.itertuples(index=False, name=None)), key=repr)
