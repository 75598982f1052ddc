"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import duckdb

SF = "/root/testdata/sf0.001"
# Extra columns that clash with names operators use.
DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, fp long, digest string, shard int, key string, "
    "n long, score double, size long, rank int, rest long, trusted boolean, x binary, first long, holder long"
)


def docs(spark, rows, extra=True):
    """A documents table of (doc_id, text) rows."""
    filled = [(i, t, None, None, len(t) if t is not None else None) + (None,) * 13 for i, t in rows]
    df = spark.createDataFrame(filled, DOCS)
    return df if extra else df.select("doc_id", "text")


def awkward():
    """Null and empty cells, repeated rows and ids, long and odd texts."""
    long = " ".join(f"word{i % 977} of{i % 31}" for i in range(20_000))
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two"), (6, "A B c"), (7, "a  b\tC"), (None, "no id here at all"),
        (None, None), (8, long), (9, long), (10, "same row twice over"), (10, "same row twice over"), (11, "same row twice over"),
        (12, "naïve Ünïcode ſ K 文字 列   x y <|endoftext|> z<|endoftext|>"), (13, "x" * 50_000), (14, "don't  stop \n\n now "),
    ]


def real(name="documents", columns="doc_id, text"):
    return duckdb.connect().execute(f"SELECT {columns} FROM '{SF}/{name}.parquet'").fetchall()
