"""Readers of the raw tables, the block table and case files; retention."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import DEFAULTS
from ..schemas import BLOCK_FEATURES_DDL, STATION_FRAME_DDL, VEHICLE_FRAME_DDL


def _hours(start: datetime, end: datetime) -> Column:
    """Partition filter: the (date, hour) partitions from ``start`` to ``end`` inclusive."""
    d, h = F.col("date"), F.col("hour")
    d0, h0 = start.strftime("%Y-%m-%d"), start.strftime("%H")
    d1, h1 = end.strftime("%Y-%m-%d"), end.strftime("%H")
    return (d.between(d0, d1) & ((d > d0) | (h >= h0)) & ((d < d1) | (h <= h1)))


def _scan(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    df = spark.read.schema(ddl).parquet(path)
    # Where a message lies in the table: tells copies apart, the same at every reading.
    return df.withColumn("row_no", F.xxhash64("_metadata.file_path", "_metadata.row_index"))


def read_vehicle(spark: SparkSession, path: str, start: datetime, end: datetime) -> DataFrame:
    """Vehicle messages of a time span; only its date and hour partitions are listed and read."""
    return _scan(spark, path, VEHICLE_FRAME_DDL).filter(_hours(start, end))


def read_station(spark: SparkSession, path: str, start: datetime, end: datetime) -> DataFrame:
    """Station messages of a time span, pruned alike."""
    return _scan(spark, path, STATION_FRAME_DDL).filter(_hours(start, end))


def stream_frames(spark: SparkSession, path: str, ddl: str, files_per_batch: int | None = None) -> DataFrame:
    """The same tables as a stream of newly written files."""
    reader = spark.readStream.schema(ddl)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def read_blocks(spark: SparkSession, path: str, dates: Sequence[str] | None = None,
                sources: Sequence[str] | None = None, brands: Sequence[str] | None = None) -> DataFrame:
    """The block table, pruned by any of its partition columns."""
    df = spark.read.schema(BLOCK_FEATURES_DDL).parquet(path)
    for name, wanted in (("date", dates), ("source", sources), ("brand", brands)):
        if wanted is not None:
            df = df.filter(F.col(name).isin(list(wanted)))
    return df


CORRUPT = "_corrupt"


def read_cases(spark: SparkSession, source, fmt: str, schema: str) -> DataFrame:
    """Case records from CSV, JSON lines or in-memory rows, with ``is_malformed``.

    Malformed records are kept with their text in ``_corrupt``, so that they can be shown
    to whoever sent them before anything is analysed.
    """
    if fmt == "rows":
        return spark.createDataFrame(source, schema).withColumns(
            {CORRUPT: F.lit(None).cast("string"), "is_malformed": F.lit(False)})
    if fmt not in ("csv", "json"):
        raise ValueError(f"case files are csv, json or rows, not {fmt}")
    reader = (spark.read.schema(f"{schema}, {CORRUPT} string").option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT))
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.format(fmt).load(source).withColumn("is_malformed", F.col(CORRUPT).isNotNull())


def expired_partitions(df: DataFrame, as_of: date, days: int = DEFAULTS.retention_days) -> DataFrame:
    """Each date partition, its age and whether it is past retention.

    Only the partition column is used; on a partitioned table that is answered from the
    listing, without opening files.
    """
    age = F.date_diff(F.lit(as_of), F.to_date("date"))
    return df.select("date").distinct().select("date", age.alias("age_days"), (age > days).alias("expired"))
