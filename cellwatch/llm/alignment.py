"""Tokens of two tokenizers aligned by their bytes, with corpus-wide counts of the pairs that overlap.

A task works on blocks of whole texts, in Arrow:

* token ids of a block are lists; flattened, each token has the index of its text (its parent), and
  the running sum of token lengths, taken within the text, gives the byte where it ends. With the place
  of the text in the block that end is a key which no other text has;
* a full outer hash join of the ends of A and B on that key has one row for each byte where a token
  ends. Rows with both are the ends of groups. Sorted by key and filled backward, each row holds
  the token of A and the token of B that overlap there: the rows are the links;
* a group-by of the links leaves each text's distinct id pairs and how often each occurs, and a second
  one the block's pairs with the number of texts that hold them.

So a block sends each of its pairs once, with a partial count. Spark adds the counts up, finds the best
of each A id, and returns to a block the counts of its pairs only; a cogroup with the block's
texts, which is as large as a block and no larger, sums them per text. Nothing is
broadcast but the vocabularies.

Defined results: null and empty texts, and texts that one of the tokenizers does not give back byte for
byte, have no tokens; each row is a text of its own, so repeated rows count each, and rows need no id; a
very long text is a block of its own; ties for the best count are all best; other columns are dropped; an
empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch.sources.scratch import materialize

from . import vocab
from .common import slices, utf8

#: Bytes of text whose links are joined at a time, and of a block, which asks for counts once.
SLICE, BLOCK = 1 << 20, 8 << 20


def _given_back(table: vocab.Table, ids: np.ndarray, n: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts whose tokens join to their bytes."""
    edges = np.concatenate([[0], np.cumsum(n)])
    ends = np.concatenate([[0], np.cumsum(table.lengths[ids])])[edges]
    same = np.diff(ends) == np.diff(offsets)
    if same.all():
        differ = np.concatenate([[0], np.cumsum(table.join(ids) != data)])
        return differ[offsets[1:]] == differ[offsets[:-1]]
    for i in np.flatnonzero(same):
        same[i] = np.array_equal(table.join(ids[edges[i]:edges[i + 1]]), data[offsets[i]:offsets[i + 1]])
    return same


def _ends(lists: pa.LargeListArray, lengths: pa.Array, base: pa.Array, name: str) -> pa.Table:
    """(end, name, id_name): the block-wide byte where each token ends, its place, and its id."""
    flat, parent = lists.flatten(), pc.list_parent_indices(lists)
    running = pc.cumulative_sum(lengths.take(flat))
    # a text's running sum starts behind that of the text before it
    first = pc.subtract(pc.take(pa.concat_arrays([pa.array([0], pa.int64()), running]), lists.offsets[:-1]), base)
    return pa.table({"end": pc.subtract(running, first.take(parent)), name: pa.array(np.arange(len(flat))), f"id_{name}": flat})


def _written(ids: pa.Array, names: pa.Array, last: np.ndarray) -> pa.Array:
    """The ids of each group, joined by commas; ``last`` are the places of the groups' last tokens."""
    edges = pa.array(np.concatenate([[0], last + 1]), pa.int64())
    return pc.binary_join(pa.LargeListArray.from_arrays(edges, names.take(ids)), pa.scalar(",", pa.large_string()))


def align(a: vocab.Table, b: vocab.Table, ids_a: np.ndarray, n_a: np.ndarray, ids_b: np.ndarray, n_b: np.ndarray,
          size: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Table]:
    """Of texts of ``size`` bytes that both tokenizers give back: the groups and links of each, its groups
    written out, and the table (text, id_a, id_b, times) of its distinct links."""
    base = pa.array(np.cumsum(size) - size)
    lists = [pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)])), pa.array(ids, pa.int32()))
             for ids, n in ((ids_a, n_a), (ids_b, n_b))]
    one, two = (_ends(x, pa.array(t.lengths), base, name) for x, t, name in zip(lists, (a, b), "ab"))
    met = one.join(two, keys="end", join_type="full outer", use_threads=False).sort_by("end").combine_chunks()
    common = met.filter(pc.and_(pc.is_valid(met["a"]), pc.is_valid(met["b"])))
    closes = np.cumsum(size)
    def of(ends):
        return np.searchsorted(closes, np.asarray(ends), "left")
    groups = np.bincount(of(common["end"]), minlength=len(size))
    text = of(met["end"])
    links = pa.table({"text": text, "id_a": pc.fill_null_backward(met["id_a"]), "id_b": pc.fill_null_backward(met["id_b"])})
    both = pc.binary_join_element_wise(_written(one["id_a"].combine_chunks(), a.names, np.asarray(common["a"])),
                                       _written(two["id_b"].combine_chunks(), b.names, np.asarray(common["b"])),
                                       pa.scalar("|", pa.large_string()))
    edges = pa.array(np.concatenate([[0], np.cumsum(groups)]), pa.int64())
    written = pc.binary_join(pa.LargeListArray.from_arrays(edges, both), pa.scalar(";", pa.large_string()))
    times = links.group_by(["text", "id_a", "id_b"], use_threads=False).aggregate([([], "count_all")])
    return groups, np.bincount(text, minlength=len(size)), written, times.rename_columns(["text", "id_a", "id_b", "times"])


def blocks(docs: DataFrame, byte_level: str, pattern: str, pieces: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts and pairs by block. A text's row: key, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2``,
    null without tokens), pair and times (places among the block's pairs, and how often). A block's
    own row: a, b and texts, its distinct pairs and how many of its texts hold each."""
    kind = docs.schema[key].dataType.simpleString()
    blob_a, blob_b = (vocab.shared(docs.sparkSession, path) for path in (byte_level, pieces))
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = vocab.byte_level(blob_a.value, pattern), vocab.pieces(blob_b.value)
        block, rows, links, seen, held = TaskContext.get().partitionId() << 33, [], [], 0, 0

        def add(keys: pa.Array, texts: pa.Array) -> int:
            nonlocal seen
            said = ["" if t is None else t for t in texts.to_pylist()]
            spaced = pa.array([f" {t}" if t else "" for t in said], pa.large_string())
            data, offsets = utf8(spaced)
            (ids_a, n_a), (ids_b, n_b) = a.encode(spaced.to_pylist()), b.encode(said)
            ok = (np.diff(offsets) > 0) & _given_back(a, ids_a, n_a, data, offsets) & _given_back(b, ids_b, n_b, data, offsets)
            ids_a, ids_b = ids_a[np.repeat(ok, n_a)], ids_b[np.repeat(ok, n_b)]
            n_a, n_b, at = np.where(ok, n_a, 0), np.where(ok, n_b, 0), np.flatnonzero(ok)
            groups, found, written = np.zeros(len(ok), np.int64), np.zeros(len(ok), np.int64), pa.nulls(len(ok), pa.large_string())
            if len(at):
                groups[at], found[at], of, own = align(a, b, ids_a, n_a[at], ids_b, n_b[at], np.diff(offsets)[at])
                place = np.zeros(len(ok), np.int64)
                place[at] = np.arange(len(at))
                written = of.take(pa.array(place, mask=~ok))
                links.append(own.set_column(0, "text", pa.array(seen + at[np.asarray(own["text"])])))
            rows.append([keys, pa.array(n_a), pa.array(n_b), pa.array(groups), pa.array(found), written])
            seen += len(ok)
            return len(data)

        def done() -> Iterator[pa.RecordBatch]:
            """The texts of a block, then its pairs."""
            nonlocal block, rows, links, seen, held
            texts, pairs = np.empty(0, np.int64), np.empty(0, np.int64)
            times, held_by = np.empty(0, np.int64), pa.table({"id": pa.array([], pa.int64()), "count": pa.array([], pa.int64())})
            if links:
                whole = pa.concat_tables(links)
                joined = (np.asarray(whole["id_a"], np.int64) << 32) | np.asarray(whole["id_b"], np.int64)
                # a text has a pair once, so rows count texts
                held_by = pa.table({"id": joined}).group_by("id", use_threads=False).aggregate([([], "count_all")])
                held_by = held_by.rename_columns(["id", "count"]).sort_by("id")
                order = np.argsort(np.asarray(whole["text"]), kind="stable")
                texts, times = np.asarray(whole["text"])[order], np.asarray(whole["times"])[order]
                pairs = np.searchsorted(np.asarray(held_by["id"]), joined[order])
            edges, at = np.searchsorted(texts, np.arange(seen + 1)), 0
            for keys, *values in rows:
                n = len(keys)
                cut = edges[at:at + n + 1]
                ends = pa.array((cut - cut[0]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x[cut[0]:cut[-1]].astype(np.int32))) for x in (pairs, times)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, block)), keys, *values[:-1], values[-1].cast(pa.string()), *lists,
                     pa.nulls(n, ints), pa.nulls(n, ints), pa.nulls(n, longs)], names)
                at += n
            ids = np.asarray(held_by["id"], np.int64)
            none = [pa.nulls(1, keys.type), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()), pa.nulls(1, ints), pa.nulls(1, ints)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), *none, pa.array([(ids >> 32).astype(np.int32)], ints),
                 pa.array([(ids & 0xFFFFFFFF).astype(np.int32)], ints), pa.array([np.asarray(held_by["count"], np.int64)], longs)], names)
            block, rows, links, seen, held = block + 1, [], [], 0, 0

        for batch in batches:
            _, offsets = utf8(batch.column(1))
            for at, to in slices(offsets, SLICE):
                held += add(batch.column(0).slice(at, to - at), batch.column(1).slice(at, to - at))
                if held >= BLOCK:
                    yield from done()
        if rows:
            yield from done()

    names = ["block", "key", "n_a", "n_b", "n_groups", "n_links", "groups", "pair", "times", "a", "b", "texts"]
    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"block bigint, key {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
             "pair array<int>, times array<int>, a array<int>, b array<int>, texts array<bigint>")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(a, b, texts, best): in how many texts the ids are linked, and whether no other b is with more."""
    pairs = rows.where("a IS NOT NULL").select(F.inline(F.arrays_zip("a", "b", "texts")))
    counts = pairs.groupBy("a", "b").agg(F.sum("texts").alias("texts"))
    most = counts.groupBy("a").agg(F.max("texts").alias("most"))
    return counts.join(most, "a").select("a", "b", "texts", (F.col("texts") == F.col("most")).alias("best"))


def weighed(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """The text rows of ``blocks`` with n_best and count_sum in place of their links."""
    kind = rows.schema["key"].dataType.simpleString()
    texts = rows.where("a IS NULL").drop("a", "b", "texts")
    asked = rows.where("a IS NOT NULL").select(F.col("block").alias("of"), F.posexplode(F.arrays_zip("a", "b")).alias("pos", "p")).select(
        "of", "pos", F.col("p.a").alias("a"), F.col("p.b").alias("b"))
    told = asked.join(counts, ["a", "b"]).select("of", "pos", "texts", "best")
    others = [c for c in texts.columns if c not in ("block", "pair", "times")]

    def run(mine: pa.Table, answers: pa.Table) -> pa.Table:
        count, best = np.zeros((2, len(answers)), np.int64)
        at = np.asarray(answers["pos"])
        count[at], best[at] = np.asarray(answers["texts"]), np.asarray(answers["best"])
        pair, times = (mine[c].combine_chunks() for c in ("pair", "times"))
        edges = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(pair), np.int64))])
        pair, times = np.asarray(pair.flatten()), np.asarray(times.flatten(), np.int64)
        sums = [np.diff(np.concatenate([[0], np.cumsum(x[pair] * times)])[edges]) for x in (best, count)]
        return pa.table([*(mine[c] for c in others), *map(pa.array, sums)], [*others, "n_best", "count_sum"])

    fields = ", ".join(f"{c} {kind if c == 'key' else rows.schema[c].dataType.simpleString()}" for c in others)
    return texts.groupBy("block").cogroup(told.groupBy("of")).applyInArrow(
        run, f"{fields}, n_best bigint, count_sum bigint")


def digests(docs: DataFrame, byte_level: str, pattern: str, pieces: str) -> DataFrame:
    """The digest of the contract."""
    found = blocks(docs, byte_level, pattern, pieces)
    rows = materialize(found.withColumn("groups", F.when(F.col("groups").isNull(), "").otherwise(F.sha2("groups", 256))), "aligned")
    out = weighed(rows, materialize(pair_counts(rows), "pair-counts"))
    return out.select(F.col("key").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                      F.col("groups").alias("groups_sha256"))
