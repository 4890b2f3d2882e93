"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``.

    Only on one machine (a ``local`` master, as in tests) may the session name none; then a
    temporary folder is used and set as its checkpoint folder. Elsewhere executors would not
    see each other's files, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = spark.sparkContext.getCheckpointDir()
        if held is None:
            master = spark.sparkContext.master
            if not (master == "local" or master.startswith("local[")):
                raise ValueError(f"set spark.checkpoint.dir to a shared folder; the master is {master}")
            held = tempfile.mkdtemp(prefix="cellwatch-")
            spark.sparkContext.setCheckpointDir(held)
        base = held
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str, partition_by: tuple[str, ...] = ()):
    """Writes ``df`` once to the shared folder and reads it back: cuts lineage for good."""
    path = scratch_path(df.sparkSession, name)
    out = df.write.partitionBy(*partition_by).option("parquet.compression.codec.zstd.level", 9)
    out.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)
