"""Awkward rows that every operator must take."""
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use themselves.
    *[T.StructField(n, T.StringType()) for n in (
        "id", "kept", "digest", "keep_id", "fp", "bucket", "component_id", "topic", "tokens", "row", "factor", "spans",
        "key", "size", "shard", "slot", "tie", "unit", "seq", "file", "h", "score", "token_ids", "n")],
])
PAGES = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
    *[T.StructField(n, T.StringType()) for n in ("id", "host", "paths", "page", "text", "path", "payload", "refers_to", "content")],
])


def docs(spark, rows):
    extra = ("x",) * (len(DOCS) - 5)
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *extra) for r in rows], DOCS)


def pages(spark, rows):
    return spark.createDataFrame([(*r, *("x",) * (len(PAGES) - 3)) for r in rows], PAGES)


LONG = "alpha beta gamma delta epsilon zeta eta theta " * 6000
AWKWARD = [
    (1, None, None, None), (2, "", "en", "a"), (3, "   \t\n", "en", None), (4, LONG, "en", "a"), (5, LONG, None, "a"),
    (6, "the same words here", "en", "b"), (6, "the same words here", "en", "b"), (7, "the same words here", "de", "b"),
    (None, "a row without id", "en", "a"), (None, None, None, None), (8, "漢字 и кириллица 🙂 é", "xx", "c"),
    (9, "12345 !!! 67890", "en", "c"), (10, "'; DROP TABLE \\ \" \0 x", "en", "c"), (11, "one", "en", "b"),
]


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
