"""Near duplicates by MinHash with tensored banding, candidates verified on full sets.

A document's set are its distinct word shingles, as 64-bit hashes. Two collections of 12 small
hashes (three minima each) are computed; a table key joins one hash of the first collection with
one of the second, so 24 small hashes, 72 minima, stand for 144 tables of six minima, which would
take 864. Two documents meet in a table if they agree in both parts.

* Documents with equal sets are one vertex, named by its smallest id. So a group of copies of any
  size is one row for all that follows.
* A small hash that only one vertex has is dropped before keys are combined, so keys are made
  only for vertices that have company in both collections. Keys are made once, and those of one vertex go.
* Within a key a vertex is compared with a few centres, never with all others, and each pair is
  verified on the full sets. Rounds with other centres follow over the keys that still hold several
  components, in which only vertices of different components are compared, as long as a round halves
  the vertices concerned. The vertices that still share a key across components are settled by
  an exact prefix join, so every pair that shares a key is decided.
* Components come from smallest labels passed along links, with labels followed to their labels.

At a threshold of 0.85 a pair misses all tables with probability 3e-5, at 0.8 with 4e-4.

Defined results: null and empty texts have an empty set and link with nothing; rows of one id are
one document; rows without an id link with nothing and are kept; a very long text has a large set and
is worked on alone; pairs exactly at the threshold are links; ``classes`` drops other columns, ``keep`` keeps
them; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, long_array, lowered, mix, slices, utf8, word_hashes

HASHES, ROWS, SIDES = 12, 3, 2
#: Words of a shingle and similarity in percent, and centres of a key in a round.
WORDS, PERCENT, CENTRES = 3, 85, 3
#: Bytes of text whose work arrays a task holds at a time.
SLICE = 1 << 21


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of runs of ``words`` words, ascending within each text, and the text each belongs to. A text
    of fewer words is one run."""
    h, doc = word_hashes(lowered(data), offsets)

    def runs(at: np.ndarray, n: int, seed: int) -> np.ndarray:
        out = np.full(len(at), np.uint64(seed))
        for k in range(n - 1, -1, -1):
            out = mix(h[at + k] + out, k + 1)
        return out

    with np.errstate(over="ignore"):
        whole = np.flatnonzero(doc[words - 1:] == doc[:len(doc) - words + 1]) if len(doc) >= words else np.empty(0, np.int64)
        n = np.bincount(doc, minlength=len(offsets) - 1)
        first = np.cumsum(n) - n
        short = [np.flatnonzero(n == k) for k in range(1, words)]
        sh = np.concatenate([runs(whole, words, 0), *(runs(first[d], k + 1, k + 1) for k, d in enumerate(short))])
    d = np.concatenate([doc[whole], *short])
    order = np.lexsort((sh, d))
    sh, d = sh[order], d[order]
    new = np.ones(len(sh), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (d[1:] != d[:-1])
    return sh[new], d[new]


def _sums(sh: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums that name a set."""
    with np.errstate(over="ignore"):
        return [np.add.reduceat(mix(sh, seed), starts) for seed in (101, 202)]


def small_hashes(sh: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(sets, 24): each joins the minima of three orders of the shingles."""
    out = np.empty((len(starts), SIDES * HASHES), np.uint64)
    seeds = mix(np.arange(SIDES * HASHES * ROWS * 2, dtype=np.uint64), 7)
    with np.errstate(over="ignore"):
        for i in range(SIDES * HASHES):
            key = np.full(len(starts), np.uint64(i))
            for j in range(i * ROWS, (i + 1) * ROWS):
                order = (sh ^ seeds[2 * j]) * (seeds[2 * j + 1] | np.uint64(1))
                key = mix(key + np.minimum.reduceat(order, starts))
            out[:, i] = key
    return out


def _filled(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, values.dtype)
    out[rows] = values
    return out


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(id, n_shingles, s1, s2, small): size and name of the set, and its small hashes."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets, SLICE):
                sh, d = shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], words)
                n = np.bincount(d, minlength=b - a)
                rows = np.flatnonzero(n)
                starts = (np.cumsum(n) - n)[rows]
                s1, s2 = _sums(sh, starts) if len(rows) else [np.empty(0, np.uint64)] * 2
                small = small_hashes(sh, starts) if len(rows) else np.empty((0, SIDES * HASHES), np.uint64)
                width = np.zeros(b - a + 1, np.int32)
                width[rows + 1] = SIDES * HASHES
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(width, dtype=np.int32)), long_array(small.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n.astype(np.int64)),
                     long_array(_filled(s1, rows, b - a)), long_array(_filled(s2, rows, b - a)), lists],
                    ["id", "n_shingles", "s1", "s2", "small"])

    return docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, n_shingles bigint, s1 bigint, s2 bigint, small array<bigint>")


def full_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(id, s1, set) of (id, text) rows."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets, SLICE):
                sh, d = shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], words)
                n = np.bincount(d, minlength=b - a)
                rows = np.flatnonzero(n)
                s1 = _sums(sh, (np.cumsum(n) - n)[rows])[0] if len(rows) else np.empty(0, np.uint64)
                ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), long_array(_filled(s1, rows, b - a)),
                     pa.ListArray.from_arrays(pa.array(ends), long_array(sh))], ["id", "s1", "set"])

    return docs.mapInArrow(run, f"id {kind}, s1 bigint, set array<bigint>")


def components(links: DataFrame, tables: Scratch | None = None, name: str = "labels") -> DataFrame:
    """(node, label) of linked nodes; the label is the smallest node that links reach."""
    tables = tables or Scratch(links.sparkSession)
    both = tables.put(links.select("a", "b").union(links.select("b", "a")).toDF("a", "b").distinct(), "both-ways")
    labels = tables.put(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("a"), F.min("b")).alias("label")), name)
    while True:
        passed = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(
            F.col("a").alias("node")).agg(F.min("label").alias("near"))
        least = labels.join(passed, "node").select("node", F.col("label").alias("old"),
                                                   F.least("label", "near").alias("label"))
        # a label is a node with a label of its own
        known = least.select(F.col("node").alias("label"), F.col("label").alias("next"))
        stepped = tables.put(least.join(known, "label").select(
            "node", F.least("label", "next").alias("label"), (F.least("label", "next") < F.col("old")).alias("moved")), name)
        labels = stepped.select("node", "label")
        if not stepped.where("moved").limit(1).count():
            tables.drop("both-ways")
            return labels


def _keys(members: DataFrame) -> DataFrame:
    """Table keys of each vertex: every small hash of one collection with every one of the other."""
    return members.select("rep", "n", F.explode("left").alias("l"), "right").select(
        "rep", "n", "l", F.explode("right").alias("r")).select("rep", "n", F.xxhash64("l", "r").alias("key"))


def _alike(n: str, m: str, percent: int):
    """Sets whose sizes differ more than this cannot reach the similarity."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    sides = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    return sides.select("a", "b", both.alias("both"), (F.size("sa") + F.size("sb")).alias("sum")).where(
        100 * F.col("both") >= percent * (F.col("sum") - F.col("both"))).select("a", "b")


def settled(vertices: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Every pair (a, b) of different components of ``vertices`` (rep, n, comp) that is similar enough.

    A prefix join. Shingles have one order for all sets: those of a single component first, then
    the rarest. The first common shingle of such a pair is within the first 8 % of the shorter set
    and the first 15 % of the longer one (at 85 %), and so many shingles follow it in both. Those
    of a single component take their places in the order and are not joined. A frequent shingle is
    joined within bands of set sizes: the sizes of a pair lie in one band or in two neighbouring ones.
    """
    each = vertices.join(sets.withColumnRenamed("id", "rep"), "rep").select("rep", "n", "comp", F.explode("set").alias("sh"))
    mixed = each.groupBy("sh").agg(F.count("*").alias("c"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where(
        "lo <> hi").select("sh", "c")
    longest = F.expr(f"n - ({percent} * n + 99) div 100 + 1")
    shortest = F.expr(f"n - ({2 * percent} * n + {99 + percent}) div {100 + percent} + 1")
    ordered = each.join(mixed, "sh").groupBy("rep", "n", "comp").agg(
        F.sort_array(F.collect_list(F.struct("c", "sh"))).alias("shared"))  # at most the set itself
    own = F.col("n") - F.size("shared")
    # sizes in one band differ by less than the similarity allows, so a pair's bands differ by one at most
    band = F.floor(F.log("n") / math.log(100 / percent)).cast("int")
    heads = ordered.withColumn("own", own).withColumn("least", shortest).select(
        "rep", "n", "comp", "own", "least", band.alias("band"),
        F.posexplode(F.slice("shared", F.lit(1), F.greatest(longest - own, F.lit(0)).cast("int"))).alias("pos", "s")).select(
            "rep", "n", "comp", "least", "band", (F.col("own") + F.col("pos") + 1).alias("at"), F.col("s.sh").alias("sh"))
    short = heads.where("at <= least").select("sh", "band", *[F.col(c).alias(f"{c}1") for c in ("rep", "n", "comp", "at")])
    # the longer set of a pair is in the shorter one's band or the next
    long_ = heads.drop("least").withColumn("band", F.explode(F.array(F.col("band"), F.col("band") - 1)))
    pairs = short.join(long_, ["sh", "band"]).where(
        (F.col("comp1") != F.col("comp")) & ((F.col("n1") < F.col("n")) | (F.col("n1") == F.col("n")) & (F.col("rep1") < F.col("rep")))
        & _alike("n1", "n", percent)
        & ((100 + percent) * (F.least(F.col("n1") - F.col("at1"), F.col("n") - F.col("at")) + 1)
           >= percent * (F.col("n1") + F.col("n"))))
    return _verified(pairs.select(F.col("rep1").alias("a"), F.col("rep").alias("b")).distinct(), sets, percent)


def links(docs: DataFrame, reps: DataFrame, percent: int, words: int = WORDS, tables: Scratch | None = None) -> DataFrame | None:
    """Verified (a, b) between vertices, enough of them to join all components; None if none.

    First each vertex is compared with one vertex only, the first in a random order among the
    centres of its keys: a group of near copies mostly agrees on it. Later rounds look at the keys
    that still hold more than one component, and only at those: once a key is of one
    component it stays so. They compare every vertex with a few centres of its keys that are of
    another component. When a round does not halve the vertices in such keys, a prefix join of these
    vertices settles what is left.
    """
    tables = tables or Scratch(docs.sparkSession)
    small = reps.select("rep", F.posexplode("small").alias("pos", "h"))
    shared = small.groupBy("pos", "h").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    side = F.when(F.col("pos") < HASHES, F.col("h"))
    other = F.when(F.col("pos") >= HASHES, F.col("h"))
    # at most 12 of each: collect_list leaves out nulls
    met = small.join(shared, ["pos", "h"]).groupBy("rep").agg(
        F.collect_list(side).alias("left"), F.collect_list(other).alias("right")).where(
            (F.size("left") > 0) & (F.size("right") > 0))
    members = tables.put(met.join(reps.select("rep", "s1", F.col("n_shingles").alias("n")), "rep"), "members")
    every = _keys(members)
    centre = every.groupBy("key").agg(F.min(F.struct(F.xxhash64("rep").alias("turn"), "rep", "n")).alias("c"),
                                      F.count("*").alias("size")).where("size > 1").select("key", "c")
    keys = tables.put(every.join(centre, "key").select(
        "key", "rep", "n", F.col("c.rep").alias("c_rep"), F.col("c.n").alias("c_n")), "keys")
    if not keys.limit(1).count():
        return None
    # sets are made only for vertices that share a key
    company = keys.select("rep").distinct().join(members.select("rep", "s1"), "rep").select(F.col("rep").alias("id"), "s1")
    texts = docs.join(company.select("id"), "id", "left_semi")
    sets = tables.put(full_sets(texts, words).join(company, ["id", "s1"]).dropDuplicates(["id"]).select("id", "set"), "sets")
    tables.drop("members")
    first = keys.where((F.col("rep") != F.col("c_rep")) & _alike("n", "c_n", percent)).groupBy(
        F.col("rep").alias("a")).agg(F.min(F.struct(F.xxhash64("c_rep").alias("turn"), "c_rep")).alias("c")).select(
            "a", F.col("c.c_rep").alias("b"))
    found, turn, before = tables.put(_verified(first, sets, percent), "links-0"), 0, None
    keys = keys.select("key", "rep", "n")
    while True:
        turn += 1
        comp = components(found, tables).withColumnRenamed("node", "rep")
        now = keys.join(comp, "rep", "left").withColumn("comp", F.coalesce("label", "rep")).drop("label")
        centres = [F.min(F.struct(F.xxhash64(F.lit(turn * CENTRES + i), "rep").alias("turn"), "rep", "n", "comp")).alias(f"c{i}")
                   for i in range(CENTRES)]
        several = now.groupBy("key").agg(*centres, F.min("comp").alias("lo"), F.max("comp").alias("hi")).where(
            "lo <> hi").select("key", F.array_distinct(F.array(*[f"c{i}" for i in range(CENTRES)])).alias("centres"))
        mixed = tables.put(now.join(several, "key"), "keys")
        left = mixed.select("rep", "n", "comp").distinct()
        count = left.count()
        if not count:
            tables.drop("keys")
            tables.drop("sets")
            return found
        if before is not None and 2 * count > before:
            new = tables.put(settled(left, sets, percent), f"links-{turn}")
            tables.drop("keys")
            tables.drop("sets")
            return found.union(new)
        pairs = mixed.select("rep", "n", "comp", F.explode("centres").alias("c")).where(
            (F.col("comp") != F.col("c.comp")) & _alike("n", "c.n", percent)).select(
                F.least("rep", "c.rep").alias("a"), F.greatest("rep", "c.rep").alias("b")).distinct()
        found = found.union(tables.put(_verified(pairs, sets, percent), f"links-{turn}"))
        keys, before = mixed.select("key", "rep", "n"), count


def classes(docs: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """The digest of the contract: key, n_shingles, component_id, kept."""
    tables = Scratch(docs.sparkSession)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    sig = tables.put(signatures(rows, "id", "text", words), "signatures")
    named = sig.where("id IS NOT NULL AND n_shingles > 0")
    reps = tables.put(named.groupBy("s1", "s2", "n_shingles").agg(
        F.min(F.struct("id", "small")).alias("m")).select(
            "s1", "s2", "n_shingles", F.col("m.id").alias("rep"), F.col("m.small").alias("small")), "vertices")
    sig = tables.put(sig.drop("small"), "signatures")
    named = sig.where("id IS NOT NULL AND n_shingles > 0")
    # rows of one id are one document: they share a vertex through their id
    many = named.join(reps.drop("small"), ["s1", "s2", "n_shingles"]).select(
        F.col("id").alias("a"), F.col("rep").alias("b"))
    found = links(rows, reps, percent, words, tables)
    twice = tables.put(many.distinct().groupBy("a").agg(F.min("b").alias("lo"), F.max("b").alias("hi")).where(
        "lo <> hi").select(F.col("lo").alias("a"), F.col("hi").alias("b")), "shared-ids")
    if twice.limit(1).count():
        found = twice if found is None else found.union(twice)
    thin = reps.drop("small")
    if found is not None:
        thin = thin.join(components(found, tables).withColumnRenamed("node", "rep"), "rep", "left").withColumn(
            "rep", F.coalesce("label", "rep")).drop("label")
    joined = sig.join(thin, ["s1", "s2", "n_shingles"], "left")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("rep", "id")).otherwise(F.col("id"))
    own = F.when(F.col("id").isNotNull(), own)
    return joined.select(F.col("id").alias(key), "n_shingles", own.alias("component_id"),
                         F.coalesce(F.col("id") == own, F.lit(True)).alias("kept"))


def keep(docs: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """One document of each group, with the columns it came with."""
    gone = classes(docs, percent, key, text, words).where("NOT kept").select(F.col(key).alias("_gone")).distinct()
    return docs.join(gone, docs[key] == gone["_gone"], "left_anti")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id),
l AS (
  SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * shared >= 85 * (p.n + q.n - shared)),
r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.reached = l.a),
c AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""
