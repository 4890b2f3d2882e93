"""Writers of the block table and the alarm table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import PARTITIONS


def _balanced(df: DataFrame, partitions: list[str], sort_by: list[str]) -> DataFrame:
    """Evenly sized output files: adaptive execution splits large partitions and joins small
    ones; sorting by battery lets readers skip row groups."""
    return df.hint("rebalance", *[F.col(c) for c in partitions]).sortWithinPartitions(*partitions, *sort_by)


def write_blocks(df: DataFrame, path: str) -> None:
    """Writes block features; only the (date, source, brand) partitions in ``df`` are replaced."""
    parts = PARTITIONS["blocks"]
    (_balanced(df, parts, ["battery_id"]).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path))


def write_alarms(df: DataFrame, path: str) -> None:
    """Writes alarm rows; the (day, algorithm) partitions in ``df`` are replaced, so a run that is
    repeated does not double them."""
    daily = df.withColumn("date", F.date_format("at", "yyyy-MM-dd"))
    _balanced(daily, ["date", "algorithm"], ["battery_id"]).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("date", "algorithm").parquet(path)


def alarm_batch_writer(path: str):
    """``foreachBatch`` writer: a batch that is run again replaces what it wrote before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write
