"""State of ``foreachBatch`` streams in buckets of batteries.

A battery's state lies in one of a fixed number of buckets. Batch n reads the newest version of the
buckets its batteries lie in, writes new versions of those and no others, and last a small manifest that
says for each bucket which batch wrote its newest version. A batch that is run again reads the same
manifest, that of batch n - 1, and replaces what it wrote, so its rows and state are the same. Versions
that neither it nor the batch after it could still read are removed.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS, BUCKET, BATCH = 256, "_bucket", "_batch"
Keep = Callable[[DataFrame], DataFrame]
Step = Callable[[DataFrame, DataFrame | None, Keep], tuple[DataFrame, DataFrame]]


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _manifest(spark: SparkSession, path: str, batch_id: int) -> dict:
    """{"schema": of the state, "at": {bucket: batch}}; at most one entry per bucket."""
    if batch_id < 0:
        return {"schema": None, "at": {}}
    fs, at = _file(spark, f"{path}/manifest/{batch_id}")
    stream = fs.open(at)
    try:
        told = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return {"schema": told["schema"], "at": {int(b): n for b, n in told["at"].items()}}


def _put(spark: SparkSession, path: str, batch_id: int, told: dict) -> None:
    """Writes a manifest under another name first: a torn one is never read."""
    fs, at = _file(spark, f"{path}/manifest/{batch_id}")
    _, part = _file(spark, f"{path}/manifest/_{batch_id}")
    stream = fs.create(part, True)
    stream.write(json.dumps(told).encode())
    stream.close()
    fs.delete(at, True)
    if not fs.rename(part, at):
        raise OSError(f"cannot write {at}")


def read_state(spark: SparkSession, path: str, manifest: dict, buckets: list[int] | None = None) -> DataFrame | None:
    """The newest state of some buckets, or of all; None where there is none yet."""
    of: dict[int, list[int]] = {}
    for bucket, batch in manifest["at"].items():
        if buckets is None or bucket in buckets:
            of.setdefault(batch, []).append(bucket)
    if not of:
        return None
    schema = T.StructType.fromJson(manifest["schema"]).add(BATCH, T.IntegerType()).add(BUCKET, T.IntegerType())
    newest = F.lit(False)
    for batch, some in of.items():
        newest = newest | ((F.col(BATCH) == batch) & F.col(BUCKET).isin(some))
    rows = spark.read.option("basePath", path).schema(schema).parquet(*[f"{path}/{BATCH}={n}" for n in sorted(of)])
    return rows.where(newest).drop(BATCH, BUCKET)


def latest_state(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """All state as batch ``batch_id`` left it."""
    return read_state(spark, path, _manifest(spark, path, batch_id))


def _file(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _remove(spark: SparkSession, path: str) -> None:
    fs, at = _file(spark, path)
    fs.delete(at, True)


def writer(thin: Callable[[DataFrame], DataFrame], step: Step, out_path: str, carry_path: str, key: str = "battery_id",
           buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function around ``step(frames, state, keep) -> (rows, new state)``.

    ``thin`` makes of a batch the frames that are needed; they are worked out once. ``state`` holds the rows of all
    batteries that share a bucket with one of the batch; ``new state`` must hold what is left of the same
    batteries. ``keep`` holds a frame both are made from until they are written. Rows go to a directory of the batch.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _manifest(spark, carry_path, batch_id - 1)
        held: list[DataFrame] = []

        def keep(df: DataFrame) -> DataFrame:
            held.append(df.persist())
            return held[-1]

        try:
            came = keep(thin(batch))
            touched = sorted(r[0] for r in came.select(_bucket(key, buckets)).distinct().collect())
            rows, left = step(came, read_state(spark, carry_path, before, touched), keep)
            (left.withColumn(BUCKET, _bucket(key, buckets)).repartition(BUCKET)
             .write.mode("overwrite").partitionBy(BUCKET).parquet(f"{carry_path}/{BATCH}={batch_id}"))
            rows.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
            told = {"schema": left.schema.jsonValue(), "at": {**before["at"], **dict.fromkeys(touched, batch_id)}}
            _put(spark, carry_path, batch_id, told)
        finally:
            for df in held:
                df.unpersist()
        if batch_id > 1:
            # what batch n - 1 replaced: a repeat of batch n reads the manifest of n - 1 only
            older = _manifest(spark, carry_path, batch_id - 2)["at"]
            for bucket, batch in older.items():
                if before["at"][bucket] != batch:
                    _remove(spark, f"{carry_path}/{BATCH}={batch}/{BUCKET}={bucket}")
        if batch_id > 2:
            _remove(spark, f"{carry_path}/manifest/{batch_id - 3}")

    return run
