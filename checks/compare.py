"""Runs a registered query in Spark and its oracle in DuckDB and compares the results."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import SparkSession

from .registry import ORACLES, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if hasattr(value, "as_tuple"):
        return float(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """None when equal, else what differs first."""
    df = QUERIES[name](spark, sf_dir)
    got_cols, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLES[name])
    want_cols, want = _rows([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows, oracle {len(want)}; {got[:1]} / {want[:1]}"
    for a, b in zip(got, want):
        if a != b or any(type(x) is not type(y) and not {type(x), type(y)} <= {int, float}
                         for x, y in zip(a, b)):
            diff = [(c, x, y) for c, x, y in zip(got_cols, a, b) if x != y or type(x) is not type(y)]
            return f"{diff[:4]} of {a}"
    return None if got else "no rows on either side"
