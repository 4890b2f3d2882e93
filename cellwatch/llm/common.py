"""Small helpers the operators share: columns, shared scratch tables, words of a batch."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch.sources.scratch import scratch_path

WHITE = [9, 10, 11, 12, 13, 32]
#: Java and DuckDB read this alike: everything but space and the five controls from tab on.
WORD = r"[^\x20\x09-\x0D]+"
#: Letters and digits of ASCII and everything beyond ASCII, after lower-casing.
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it: needed on one machine
    when the package is not installed; a cluster gets it with the job's Python files."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])


class Scratch:
    """Intermediate tables of one job in the shared folder, removed when another takes their place.

    What is read later must have been written itself by then: a removed table cannot be computed again.
    """

    def __init__(self, spark: SparkSession):
        self._spark, self._paths = spark, {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Writes ``df`` and reads it back; an earlier table of the name is removed after that."""
        path = scratch_path(self._spark, name)
        df.write.parquet(path)
        self.drop(name)
        self._paths[name] = path
        return self._spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        path = self._paths.pop(name, None)
        if path is not None:
            at = self._spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(at, True)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def crc_rest(key: Column, modulus: int) -> Column:
    """crc32 of the key's text, modulo: fixed folds that do not depend on the engine."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts behind one another and where each begins (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``limit`` bytes together, so that work arrays stay small."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finalizer (two multiplications), vectorized."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2**64
_BYTE = mix(np.arange(256, dtype=np.uint64), 17)
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_SEP = np.zeros(256, bool)
_SEP[WHITE] = True


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOW[data]


def word_hashes(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray = _SEP):
    """Words of lower-cased texts: a 64-bit hash of each and the text it belongs to.

    A word's hash is its polynomial over bytes, cut from running sums.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = ~sep[data]
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    with np.errstate(over="ignore"):
        step = np.full(n + 1, np.uint64(_BASE))
        step[0] = 1
        power = np.cumprod(step)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * power[:n], out=sums[1:])
        inverse = np.uint64(pow(_BASE, -1, 2**64))
        step[1:] = inverse
        back = np.cumprod(step)
        h = mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    return h, np.searchsorted(offsets, starts, "right") - 1


def long_array(values: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values as signed ones, which Spark has."""
    return pa.array(values.view(np.int64))
