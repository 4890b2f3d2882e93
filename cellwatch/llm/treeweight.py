"""Context-tree weighting over bytes, learnt and applied as Spark jobs.

Each byte is eight binary decisions along its prefix. For each decision there is a tree of
contexts, the up to ``DEPTH`` bytes before it; every context keeps how often either bit followed
and its Krichevsky-Trofimov estimate. A context's weight is half its own block probability and
half the product of its longer contexts', which fixes how all depths mix when a text is scored.
The trees are learnt from the training texts and then frozen; a context never seen in training
passes on the mix of the shorter ones. A text is its lower-cased UTF-8 bytes and one end symbol.

1. Runs of ``DEPTH`` + 1 bytes are counted inside tasks, per block of texts, and summed by Spark.
2. Counts are dealt by the three bytes next to the symbol. In a share the trees are folded from
   the longest context down to these three (at most 2**24 runs can share them); the last three
   levels are grouped sums over what is left.
3. The mix is passed back up the same way, which gives each run's log probability.
4. Blocks ask for the probabilities of their distinct runs by one join. Sorted by block, answers
   before texts, they pass a task as a stream: it holds the answers to ``BLOCK_BYTES`` of text, or
   to a single longer text, and never a block's texts.

The word counts of the base score travel by the same join, under the hash of the word. What is
shuffled grows with the input: blocks, their distinct runs and words, and the texts once.

Defined results: null and empty texts have one token, the end; rows repeat as they come; a null id
falls in the fold of the empty string; other columns are dropped; without training texts every bit
has probability one half; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.sources.scratch import materialize

from .common import crc_rest, long_array, lowered, slices, utf8, word_hashes

DEPTH, SPLIT = 5, 3
FOLDS, HELD = 7, 2
BLOCK_BYTES, SLICE, SHARE_RUNS, PACK = 64 << 20, 1 << 19, 300_000, 500_000
END, BEFORE = 0xFF, 0xFE  # bytes that UTF-8 never has
WORD_KEY = np.uint64(1 << 63)


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The run that ends at each byte and at the end of each text, and where each text's begin."""
    n = np.diff(offsets)
    starts = offsets[:-1] + np.arange(len(n)) * (DEPTH + 1)
    padded = np.full(int(offsets[-1]) + len(n) * (DEPTH + 1), BEFORE, np.uint64)
    padded[np.repeat(starts + DEPTH - offsets[:-1], n) + np.arange(len(data))] = data
    padded[starts + DEPTH + n] = END
    out = np.zeros(len(padded) - DEPTH, np.uint64)
    for i in range(DEPTH + 1):
        out = (out << np.uint64(8)) | padded[i:len(padded) - DEPTH + i]
    firsts = offsets[:-1] + np.arange(len(n))
    keep = np.repeat(starts - firsts, n + 1) + np.arange(int(offsets[-1]) + len(n))
    return out[keep], firsts


def word_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h, d = word_hashes(data, offsets)
    return h | WORD_KEY, d


class _Tally:
    """Distinct keys of a block with their training counts, folded when they pile up."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, keys: np.ndarray, trains: np.ndarray) -> None:
        order = np.argsort(keys)
        self.fold([(keys[order], trains[order])])
        if self.size > 3_000_000:
            self.whole()

    def fold(self, new: list) -> None:
        for keys, n in new:
            if len(keys):
                first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                self.parts.append((keys[first], np.add.reduceat(n, first)))
                self.size += len(first)

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) > 1:
            keys, n = (np.concatenate(x) for x in zip(*self.parts))
            order = np.argsort(keys, kind="stable")
            self.parts, self.size = [], 0
            self.fold([(keys[order], n[order])])
        return self.parts[0] if self.parts else (np.empty(0, np.uint64), np.empty(0, np.int64))


def asked(texts: DataFrame) -> DataFrame:
    """(block, key, n) of (block, train, text): each block's distinct runs and words, with how
    often they stand in its training texts. A block may be told in several parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[int, _Tally] = {}
        for batch in batches:
            blocks = batch.column(0).to_numpy(zero_copy_only=False)
            trains = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for block in np.unique(blocks):
                rows = np.flatnonzero(blocks == block)
                data, offsets = utf8(batch.column(2).take(pa.array(rows)))
                of = tallies.setdefault(int(block), _Tally())
                for a, b in slices(offsets, SLICE):
                    part, at = lowered(data[offsets[a]:offsets[b]]), offsets[a:b + 1] - offsets[a]
                    keys, _ = runs(part, at)
                    of.add(keys, np.repeat(trains[rows[a:b]], np.diff(at) + 1))
                    words, d = word_keys(part, at)
                    of.add(words, trains[rows[a:b]][d])
        for block, tally in tallies.items():
            keys, n = tally.whole()
            for a in range(0, len(keys), 200_000):
                k = keys[a:a + 200_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), block)), long_array(k),
                                                  pa.array(n[a:a + 200_000])], ["block", "key", "n"])

    return texts.select("block", "train", "text").mapInArrow(run, "block bigint, key bigint, n bigint")


# The trees. A node's key is its context, the latest byte lowest, then the eight bits of the
# decision (a one and the bits before it), so dropping the oldest byte is a mask.

def _lgamma(x: np.ndarray) -> np.ndarray:
    shift = np.log(x * (x + 1) * (x + 2) * (x + 3))
    x = x + 4
    return (x - 0.5) * np.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - shift


def block_log(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return _lgamma(n0 + 0.5) + _lgamma(n1 + 0.5) - _lgamma(n0 + n1 + 1) - np.log(np.pi)


def _decisions(keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    context, symbol = keys >> np.uint64(8) << np.uint64(8), keys & np.uint64(255)
    for b in range(8):
        yield (context | np.uint64(1 << b) | (symbol >> np.uint64(8 - b)),
               (symbol >> np.uint64(7 - b)) & np.uint64(1) == 1)


def fold_levels(keys: np.ndarray, n: np.ndarray) -> dict[int, tuple]:
    """Of each depth from DEPTH to SPLIT: node keys, zeros, ones, weighted log probability, and the
    log of its own against its longer contexts' probability."""
    nodes, bits = (np.concatenate(x) for x in zip(*_decisions(keys)))
    counts = np.tile(n, 8).astype(float)
    key, at = np.unique(nodes, return_inverse=True)
    n1 = np.bincount(at, counts * bits, len(key))
    n0 = np.bincount(at, counts, len(key)) - n1
    weighted = block_log(n0, n1)
    levels = {DEPTH: (key, n0, n1, weighted, np.zeros(len(key)))}
    for depth in range(DEPTH - 1, SPLIT - 1, -1):
        key, at = np.unique(key & np.uint64((1 << 8 * (depth + 1)) - 1), return_inverse=True)
        n0, n1, longer = (np.bincount(at, x, len(key)) for x in (n0, n1, weighted))
        own = block_log(n0, n1)
        weighted = np.logaddexp(own, longer) - np.log(2)
        levels[depth] = (key, n0, n1, weighted, own - longer)
    return levels


NODE_DDL = "key bigint, n0 double, n1 double, weighted double, ratio double"


def _lower_levels(counted: DataFrame) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        key, n0, n1, weighted, ratio = fold_levels(
            table.column("key").to_numpy().view(np.uint64), table.column("n").to_numpy())[SPLIT]
        return pa.table([long_array(key), *map(pa.array, (n0, n1, weighted, ratio))],
                        ["key", "n0", "n1", "weighted", "ratio"])

    return counted.groupBy("share").applyInArrow(run, NODE_DDL)


def _sql_lgamma(x: Column) -> Column:
    y = x + 4
    return ((y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y)
            + 1 / (1260 * y * y * y * y * y) - F.log(x * (x + 1) * (x + 2) * (x + 3)))


def _folded(nodes: DataFrame, depth: int) -> DataFrame:
    """The level above: the same sums as in ``fold_levels``."""
    mask = F.lit((1 << 8 * (depth + 1)) - 1).cast("long")
    n0, n1 = F.col("n0"), F.col("n1")
    own = _sql_lgamma(n0 + 0.5) + _sql_lgamma(n1 + 0.5) - _sql_lgamma(n0 + n1 + 1) - float(np.log(np.pi))
    ratio = F.col("own") - F.col("longer")
    most, least = F.greatest("own", "longer"), F.least("own", "longer")
    return nodes.groupBy(F.col("key").bitwiseAND(mask).alias("key")).agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("weighted").alias("longer")).withColumn(
            "own", own).select("key", "n0", "n1", (most + F.log1p(F.exp(least - most)) - float(np.log(2))).alias("weighted"),
                               ratio.alias("ratio"))


def _mixed(nodes: DataFrame, above: DataFrame | None, depth: int) -> DataFrame:
    """(key, p, done, rest): probability of a one if the context ends here, the part of the mix
    already settled, and what share is left to longer contexts."""
    if above is None:
        joined = nodes.selectExpr("*", "0.5D AS p0", "0D AS done0", "1D AS rest0")
    else:
        mask = F.lit((1 << 8 * depth) - 1).cast("long")
        joined = nodes.withColumn("up", F.col("key").bitwiseAND(mask)).join(
            above.select(F.col("key").alias("up"), F.col("p").alias("p0"), F.col("done").alias("done0"),
                         F.col("rest").alias("rest0")), "up")
    kt = (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1)
    own = 1 / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.col("ratio")))))
    return joined.select(
        "key", F.when(F.col("n0") + F.col("n1") > 0, F.col("done0") + F.col("rest0") * kt).otherwise(F.col("p0")).alias("p"),
        (F.col("done0") + F.col("rest0") * own * kt).alias("done"), (F.col("rest0") * (1 - own)).alias("rest"))


def _log_probabilities(counted: DataFrame, mixes: DataFrame) -> DataFrame:
    """(key, value) of each run: the log probability of its last symbol after the others."""
    def run(table: pa.Table, above: pa.Table) -> pa.Table:
        keys = table.column("key").to_numpy().view(np.uint64)
        if not len(keys):
            return pa.table([long_array(keys), pa.array(np.empty(0))], ["key", "value"])
        levels = fold_levels(keys, table.column("n").to_numpy())
        held, p, done, rest = (above.column(c).to_numpy() for c in ("key", "p", "done", "rest"))
        order = np.argsort(held)
        at = order[np.searchsorted(held[order], levels[SPLIT][0].view(np.int64))]
        p, done, rest = p[at], done[at], rest[at]
        for depth in range(SPLIT + 1, DEPTH + 1):
            key, n0, n1, _, ratio = levels[depth]
            up = np.searchsorted(levels[depth - 1][0], key & np.uint64((1 << 8 * depth) - 1))
            kt, own = (n1 + 0.5) / (n0 + n1 + 1), 1 / (1 + np.exp(-np.clip(ratio, -700, 700)))
            p = np.where(n0 + n1 > 0, done[up] + rest[up] * kt, p[up])
            done, rest = done[up] + rest[up] * own * kt, rest[up] * (1 - own)
        value = np.zeros(len(keys))
        for nodes, bit in _decisions(keys):
            one = p[np.searchsorted(levels[DEPTH][0], nodes)]
            value += np.log(np.where(bit, one, 1 - one))
        return pa.table([long_array(keys), pa.array(value)], ["key", "value"])

    return counted.groupBy("share").cogroup(mixes.groupBy("share")).applyInArrow(run, "key bigint, value double")


def learn(counted: DataFrame) -> DataFrame:
    """(key, value) for all runs of (key, n): the frozen mix of the trees."""
    shares = max(16, -(-counted.count() // SHARE_RUNS))

    def share(key: Column, bits: int) -> Column:
        return F.pmod(F.xxhash64(F.call_function("shiftright", key, F.lit(8)).bitwiseAND(
            F.lit((1 << bits) - 1).cast("long"))), F.lit(shares))

    dealt = counted.withColumn("share", share(F.col("key"), 8 * SPLIT))
    levels = {SPLIT: materialize(_lower_levels(dealt), "nodes")}
    for depth in range(SPLIT - 1, -1, -1):
        levels[depth] = _folded(levels[depth + 1], depth)
    mixes = None
    for depth in range(SPLIT + 1):
        mixes = _mixed(levels[depth], mixes, depth)
    return _log_probabilities(dealt, mixes.withColumn("share", share(F.col("key"), 8 * SPLIT)))


def found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of ``wanted`` among sorted ``keys``. Asked in order, which spares most of the cache misses."""
    order = np.argsort(wanted)
    out = np.empty(len(wanted))
    out[order] = values[np.searchsorted(keys, wanted[order])]
    return out


def packed(answers: DataFrame) -> DataFrame:
    """(block, keys, values) of (block, key, value): about ``PACK`` answers of a task in a row per block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def done() -> pa.RecordBatch:
            block, key, value = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(block, kind="stable")
            block = block[order]
            first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            ends = pa.array([*first, len(block)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(block[first]), *(pa.ListArray.from_arrays(ends, pa.array(x[order])) for x in (key, value))],
                ["block", "keys", "values"])

        for batch in batches:
            if batch.num_rows:
                held.append(tuple(c.to_numpy() for c in batch.columns))
                size += batch.num_rows
            if size >= PACK:
                yield done()
                held, size = [], 0
        if held:
            yield done()

    return answers.select("block", "key", "value").mapInArrow(run, "block bigint, keys array<bigint>, values array<double>")


def _answered(texts: DataFrame, answers: DataFrame, totals: tuple[int, int, int], kind: str) -> DataFrame:
    """Texts scored by the answers of their block. A block's answers come first, so a task holds those of one
    block, 16 bytes each, and the rows of one Arrow batch."""
    n_train, n_words, n_texts = totals
    floor = float(np.log10(n_train + n_words + 1))

    def scored(rows: pa.RecordBatch, keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        data, offsets = utf8(rows.column("text"))
        tokens, seen, base, score = (np.zeros(rows.num_rows, t) for t in (np.int64, np.int64, float, float))
        for a, b in slices(offsets, SLICE):
            part, at = lowered(data[offsets[a]:offsets[b]]), offsets[a:b + 1] - offsets[a]
            mine, first = runs(part, at)
            score[a:b] = np.add.reduceat(found(keys, values, mine), first) / np.log(10)
            words, d = word_keys(part, at)
            count = found(keys, values, words)
            tokens[a:b] = np.bincount(d, minlength=b - a) + 1
            seen[a:b] = np.bincount(d, count > 0, b - a).astype(np.int64) + (n_texts > 0)
            base[a:b] = np.bincount(d, np.log10(count + 1), b - a) + np.log10(n_texts + 1) - tokens[a:b] * floor
        return pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("train"), pa.array(tokens), pa.array(seen),
             pa.array(np.full(rows.num_rows, n_train)), pa.array(base), pa.array(score),
             pa.array(-score * np.log2(10) / (np.diff(offsets) + 1))],
            ["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, keys, values = None, [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks = batch.column("block").to_numpy()
            told = batch.column("text").is_null().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((blocks[1:] != blocks[:-1]) | (told[1:] != told[:-1])) + 1
            for a, b in zip([0, *edges], [*edges, len(blocks)]):
                rows = batch.slice(a, b - a)
                if blocks[a] != block:
                    block, parts, keys, values = blocks[a], [], None, None
                if told[a]:
                    # copies: a view would keep the batch
                    parts.append(tuple(rows.column(c).flatten().to_numpy().copy() for c in ("keys", "values")))
                    continue
                if keys is None:
                    keys, values = (np.concatenate(x) for x in zip(*parts))
                    parts, keys = [], keys.view(np.uint64)
                    order = np.argsort(keys)
                    keys, values = keys[order], values[order]
                    del order
                yield scored(rows, keys, values)

    both = packed(answers).unionByName(texts.select("block", "doc_id", "train", "text"), allowMissingColumns=True)
    ddl = (f"doc_id {kind}, train boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
           "score double, bits_per_byte double")
    return both.repartition("block").sortWithinPartitions("block", F.col("text").isNotNull()).mapInArrow(run, ddl)


def score(docs: DataFrame) -> DataFrame:
    """The digest of the contract, and bits per byte (the end symbol included)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(
        "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        (crc_rest(F.col("doc_id"), FOLDS) != HELD).alias("train"), F.input_file_name().alias("file"))
    most = rows.groupBy("file").agg(F.sum(F.octet_length("text")).alias("n")).agg(F.max("n")).first()[0] or 0
    # a block stays inside a file, so a task that counts meets few blocks
    parts = max(1, -(-most // BLOCK_BYTES))
    texts = rows.withColumn("block", F.xxhash64("file", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)))).drop("file")
    wanted = materialize(asked(texts), "asked")
    counted = materialize(wanted.groupBy("key").agg(F.sum("n").alias("n")), "counted")
    words = counted.where("key < 0")
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0))).first()
    n_texts = rows.where("train").count()
    totals = (n + n_texts, v + (n_texts > 0), n_texts)
    model = learn(counted.where("key >= 0")).union(words.select("key", F.col("n").cast("double").alias("value")))
    answers = wanted.select("block", "key").join(model, "key")
    done = _answered(texts, answers, totals, kind)
    return done.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                       "base_score", "score", "bits_per_byte")
