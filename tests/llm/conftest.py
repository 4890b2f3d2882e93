import os

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
CLASHES = ["score", "id", "key", "h", "row", "m", "failed", "_gone", "_bad_id", "margin", "block", "text_", "shard",
           "words", "places", "hits", "rep", "comp", "set", "small", "page", "run", "file", "train", "host", "zones", "streams",
           "start", "length", "ids", "offset", "a", "b", "pair", "times", "pos", "runs", "best", "collapsed", "groups"]


def write_tables(spark, path, docs, pages=(), items=(), labels=(), clash=True):
    """The tables the operators read, with extra columns whose names operators use inside."""
    for name, rows, ddl in (("documents", docs, DOCS),
                            ("pages", pages, "page_id bigint, url string, html string"),
                            ("benchmark", items, "item_id bigint, text string"),
                            ("labels", labels, "doc_id bigint, quality int, toxic int")):
        df = spark.createDataFrame([tuple(r) for r in rows], ddl)
        if clash and name != "labels":
            df = df.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASHES if c not in df.columns])
        df.coalesce(1).write.parquet(os.path.join(path, f"{name}.parquet"))
    return str(path)


def doc(i, text):
    return (i, text, "en", "src0", None if text is None else len(text))


@pytest.fixture(scope="session")
def odd_dir(spark, tmp_path_factory):
    """Nulls, empty and very long texts, ties, repeated rows, rows without an id."""
    words = " ".join(f"word{i % 37}x{i}" for i in range(60))
    long_ = " ".join(f"w{i * 7919 % 1009}" for i in range(60_000)) + "z" * 5000
    item = " ".join(f"item{i}" for i in range(30))
    docs = [doc(0, None), doc(1, ""), doc(2, "  \t\n "), doc(3, words), doc(3, words), doc(4, words + " end"),
            doc(5, long_), doc(None, words), doc(None, None), doc(6, f"start {item} stop"), doc(7, "a b"), doc(8, "a b"),
            doc(9, "Released under the MIT License. MIT license, gnu  general public\tlicense v3"),
            doc(10, "é漢字 \x00 😀 Ünïcode ÀÉ"), doc(11, words.upper()), doc(3, "another text of id three")]
    pages = [(1, "http://a.example/x", "<p>one</p>"), (2, "http://a.example/y", "<p>one</p>"), (2, "http://a.example/y", "<p>one</p>"),
             (3, None, None), (4, "", ""), (None, "https://www.b.example:443/q?x=1#f", "<article><p>two &amp; three"),
             (5, "http://c.example/", "<p>" + "long words " * 20_000)]
    labels = [(3, 1, 0), (4, 1, 1), (5, None, None), (3, 0, 1)]
    return write_tables(spark, tmp_path_factory.mktemp("odd"), docs, pages, [(1, item), (2, None), (3, ""), (4, "a b")], labels)


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    return write_tables(spark, tmp_path_factory.mktemp("empty"), [])
