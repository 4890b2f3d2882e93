"""Collects check queries; one list of columns to round serves both engines."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None, rounds: Sequence[str] = (), digits: int = 9):
    """Registers a query. ``rounds``: floating columns, rounded alike on both sides."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            df = fn(spark, sf_dir)
            # + 0.0 turns a negative zero into zero
            return df.withColumns({c: F.round(c, digits) + 0.0 for c in rounds}) if rounds else df

        QUERIES[name] = run
        if sql is not None:
            body = sql
            if rounds:
                swaps = ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in rounds)
                body = f"SELECT * REPLACE ({swaps}) FROM ({sql})"
            ORACLES[name] = body
        return fn

    return register
