"""Packing of documents into windows of equal length by non-negative least squares.

Each task packs shares of its documents, of some millions of tokens:

1. A document's whole windows are sequences of their own; what is left of it is its tail.
2. Tails are counted by length, in units of ``UNIT`` tokens rounded up. Every combination of at most
   ``DEPTH`` lengths that fills a window exactly is a column; repeat counts that come closest to the
   histogram are a non-negative least-squares problem, solved by an active set.
3. Repeat counts are rounded and held to the tails there are, the most frequent combination first.
   If what stays over could not fill the room that rounding up leaves in windows, the last
   combinations are dissolved.
4. The tails that stay over are packed greedily: they fill that room, then windows, and are cut
   where room ends. The last window is cut into powers of two, which need no padding.

So no sequence has padding, only tails that stay over are cut, nothing is shuffled, and a task
that is run again gives the same sequences. A sequence never crosses shares; its id joins the
number of the task's partition with a count.

Defined results: null and empty texts are the end id alone; each row is a document of its own, so
rows that repeat or have no id are packed each; a very long text makes a share larger than others, by itself;
other columns are dropped; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vocab

WINDOW, UNIT, DEPTH = 2048, 32, 5
#: Tokens of a share.
SHARE = 1 << 22
COLUMNS = ["row", "start", "length", "sequence", "offset"]


@lru_cache(maxsize=4)
def combinations(units: int, depth: int) -> np.ndarray:
    """(lengths, combinations): how often each length of 1 to ``units`` stands in each combination of at
    most ``depth`` lengths whose sum is ``units``."""
    found: list[list[int]] = []

    def extend(parts: list[int], left: int, largest: int) -> None:
        if not left:
            found.append(parts)
        elif len(parts) < depth:
            # the parts to come are no larger, so this one must hold its share of what is left
            for part in range(-(-left // (depth - len(parts))), min(left, largest) + 1):
                extend([*parts, part], left - part, part)

    extend([], units, units)
    out = np.zeros((units, len(found)))
    for column, parts in enumerate(found):
        np.add.at(out, (np.array(parts) - 1, column), 1)
    return out


def nnls(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """x >= 0 with the least squares of a x - b, by an active set: a variable with the steepest descent
    joins the free ones, and those that would turn negative leave them."""
    x = np.zeros(a.shape[1])
    free, out = np.zeros(a.shape[1], bool), np.zeros(a.shape[1], bool)
    scale = tolerance * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(3 * a.shape[1]):
        descent = a.T @ (b - a @ x)
        descent[free | out] = -np.inf
        join = int(descent.argmax()) if len(descent) else 0
        if not len(descent) or descent[join] <= scale:
            break
        free[join] = True
        while free.any():
            at = np.flatnonzero(free)
            best = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (best > scale).all():
                x[:] = 0
                x[at] = best
                out[:] = False
                break
            low = best <= scale
            step = np.min(x[at][low] / np.maximum(x[at][low] - best[low], 1e-300))
            x[at] += min(step, 1.0) * (best - x[at])
            gone = at[low & (x[at] <= scale)]
            if not len(gone):
                gone = at[low][:1]
            x[gone], free[gone] = 0, False
            out[join] = join in gone  # not tried again before another one has joined
    return x


def repeats(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[np.ndarray, int]]:
    """(combination, times): how often each is used; together they use no length more often than there is."""
    columns = combinations(len(histogram), depth)
    x, left, out = nnls(columns, histogram.astype(float)), histogram.copy(), []
    for column in np.argsort(-x, kind="stable")[:int((x > 0).sum())]:
        parts = columns[:, column].astype(np.int64)
        need = parts > 0
        times = min(int(round(x[column])), int((left[need] // parts[need]).min()))
        if times:
            left -= times * parts
            out.append((parts, times))
    return out


def pack_tails(lengths: np.ndarray, window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH) -> dict[str, np.ndarray]:
    """Pieces of tails shorter than a window: row, start (in the tail), length, sequence, offset."""
    units = -(-lengths // unit)
    of = np.argsort(units, kind="stable")
    first = np.searchsorted(units[of], np.arange(window // unit + 2))
    next_, home, used = first[:-1].copy(), np.full(len(lengths), -1), 0
    for parts, times in repeats(np.diff(first)[1:], depth):
        for u in np.flatnonzero(parts) + 1:
            n = times * parts[u - 1]
            home[of[next_[u]:next_[u] + n]] = used + np.tile(np.arange(times), parts[u - 1])
            next_[u] += n
        used += times
    whole = home >= 0
    filled = np.bincount(home[whole], lengths[whole], used).astype(np.int64)
    # the fewest last sequences that, dissolved, leave enough to fill the others
    room, held = np.concatenate([[0], np.cumsum(window - filled)]), np.concatenate([[0], np.cumsum(filled)])
    enough = lengths[~whole].sum() + held[-1] - held >= room
    used = int(np.flatnonzero(enough)[-1])
    home[home >= used] = -1
    whole, filled = home >= 0, filled[:used]
    at = np.flatnonzero(whole)
    at = at[np.argsort(home[at], kind="stable")]
    before = np.cumsum(lengths[at]) - lengths[at]
    out = {"row": [at], "start": [np.zeros(len(at), np.int64)], "length": [lengths[at]], "sequence": [home[at]],
           "offset": [before - (np.cumsum(filled) - filled)[home[at]]]}
    rest = np.flatnonzero(~whole)
    total = int(lengths[rest].sum())
    left = total - int((window - filled).sum())
    powers = [1 << k for k in range(window.bit_length() - 1, -1, -1) if left % window >> k & 1]
    rooms = np.concatenate([window - filled, np.full(left // window, window), powers]).astype(np.int64)
    ends, closes = np.cumsum(lengths[rest]), np.cumsum(rooms)
    cuts = np.unique(np.concatenate([[0], ends, closes]))
    begin, n = cuts[:-1], np.diff(cuts)
    row, sequence = np.searchsorted(ends, begin, "right"), np.searchsorted(closes, begin, "right")
    base = np.concatenate([filled, np.zeros(len(rooms) - used, np.int64)])
    for name, values in zip(COLUMNS, (rest[row], begin - (ends - lengths[rest])[row], n, sequence,
                                      base[sequence] + begin - (closes - rooms)[sequence])):
        out[name].append(values)
    return {k: np.concatenate(v).astype(np.int64) for k, v in out.items()}


def pack_share(tokens: np.ndarray, window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH) -> dict[str, np.ndarray]:
    """Pieces of documents of so many tokens: row, start, length, sequence, offset."""
    full, tail = tokens // window, tokens % window
    short = np.flatnonzero(tail)
    out = pack_tails(tail[short], window, unit, depth)
    out["row"] = short[out["row"]]
    out["start"] += (full * window)[out["row"]]
    used = int(out["sequence"].max(initial=-1)) + 1
    row = np.repeat(np.arange(len(tokens)), full)
    number = np.arange(len(row)) - np.repeat(np.cumsum(full) - full, full)
    for name, values in zip(COLUMNS, (row, number * window, np.full(len(row), window), used + np.arange(len(row)),
                                      np.zeros(len(row)))):
        out[name] = np.concatenate([out[name], values]).astype(np.int64)
    return out


def pack(docs: DataFrame, vocabulary: str, pattern: str, end: int = 1, window: int = WINDOW, unit: int = UNIT,
         depth: int = DEPTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start, length, ids, doc_tokens, sequence_id, offset) of each piece; ``ids`` are its token ids
    as little-endian unsigned 32-bit numbers."""
    kind = docs.schema[key].dataType.simpleString()
    blob = vocab.shared(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, task, used = vocab.byte_level(blob.value, pattern), TaskContext.get().partitionId() << 33, 0
        keys, ids, tokens, held = [], [], [], 0

        def done() -> Iterator[pa.RecordBatch]:
            nonlocal used
            n, flat = np.concatenate(tokens), np.concatenate(ids).astype("<u4")
            found, own = pack_share(n, window, unit, depth), pa.chunked_array(keys).combine_chunks()
            order = np.lexsort((found["start"], found["row"]))
            found = {k: v[order] for k, v in found.items()}
            at = (np.cumsum(n) - n)[found["row"]] + found["start"]
            for a in range(0, len(at), 4096):
                part = {k: v[a:a + 4096] for k, v in found.items()}
                cut = [flat[i:i + k].tobytes() for i, k in zip(at[a:a + 4096].tolist(), part["length"].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [own.take(pa.array(part["row"])), pa.array(part["start"]), pa.array(part["length"]), pa.array(cut, pa.binary()),
                     pa.array(n[part["row"]]), pa.array(task + used + part["sequence"]), pa.array(part["offset"])],
                    ["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            used += int(found["sequence"].max(initial=-1)) + 1

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                flat, n = table.encode([t or "" for t in some.column(1).to_pylist()])
                flat = np.insert(flat, np.cumsum(n), end)
                keys.append(some.column(0))
                ids.append(flat)
                tokens.append(n + 1)
                held += len(flat)
                if held >= SHARE:
                    yield from done()
                    keys, ids, tokens, held = [], [], [], 0
        if keys:
            yield from done()

    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"key {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    ).withColumnRenamed("key", key)


def digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """The digest of the contract."""
    return pack(docs, vocabulary, pattern).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
