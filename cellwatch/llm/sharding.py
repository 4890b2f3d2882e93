"""Histogram sort into shards of near equal bytes.

Rows are ordered by (hash of the text, id), so equal texts lie next to one another and no key
is hot: a group of copies of any size is cut between two ids. The splitters are found by
counting, over all rows, the bytes below candidate boundaries: each round cuts the buckets
that hold a splitter into 256 parts and counts again, until a splitter's bucket is
within tolerance. Only then the rows move, once, to the range they belong to, and are
numbered inside it; a range's first number is the sum of the counts before it.

What a round brings to the driver is bounded by splitters x 256 counts.

Defined results: null texts have size 1 and hash as the empty text; a null id sorts before all
others; rows equal in id and text are ties, stay together and are numbered in any order; other
columns are dropped; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellwatch.sources.scratch import materialize

FIRST_BITS, STEP_BITS = 12, 8
LEAST_PARTS, RANGE_ROWS = 16, 1_000_000


def _prefix(key: Column, bits: int, of: int) -> Column:
    return F.shiftrightunsigned(key, of - bits) if bits < of else key


def _order(key: int) -> int:
    """The 64-bit key as Spark's signed long, in an order that signed comparison keeps."""
    return key - 2**63


class _Cut:
    """A splitter on its way: bytes wanted below it, bytes below its bucket, the bucket."""

    def __init__(self, want: int):
        self.want, self.below, self.at = want, 0, None


def _spread(cuts: list[_Cut], counts: dict, tolerance: float, tail: int):
    """Moves each cut into the part of its bucket that holds it; the cuts still too coarse."""
    parts: dict = {}
    for (bucket, part), held in counts.items():
        parts.setdefault(bucket, []).append((part, held))
    for some in parts.values():
        some.sort()
    for cut in cuts:
        for part, (size, lo, hi) in parts[cut.at]:
            cut.part, cut.size, cut.lo, cut.hi = part, size, lo, hi
            if cut.below + size >= cut.want:
                break
            cut.below += size
    return [c for c in cuts if c.size > tolerance and tail]


def splitters(thin: DataFrame, ranges: int, tolerance: float) -> list[tuple[int, int]]:
    """Boundaries (text key, id key), as signed longs: ranges - 1 of them, ascending."""
    total = thin.agg(F.sum("size"), F.min("k2"), F.max("k2")).first()
    if not total[0]:
        return []
    low2, bits2 = total[1], max(1, int(total[2] - total[1]).bit_length())
    slack = tolerance * total[0] / ranges
    cuts = [_Cut(total[0] * i // ranges) for i in range(1, ranges)]
    unsigned = F.col("k1").bitwiseXOR(F.lit(-2**63).cast("long"))
    found, second, open_, bits, held = {}, [], cuts, 0, 0
    for cut in cuts:
        cut.at = 0
    while open_:
        held, bits = bits, min(64, bits + (STEP_BITS if bits else FIRST_BITS))
        rows = thin
        if held:
            rows = rows.where(_prefix(unsigned, held, 64).isin(sorted({c.at for c in open_})))
        bucket = _prefix(unsigned, held, 64) if held else F.lit(0).cast("long")
        counts = {(r[0], r[1] % 2**64): (r[2], r[3], r[4]) for r in rows.groupBy(
            bucket.alias("b"), _prefix(unsigned, bits, 64).alias("p")).agg(
                F.sum("size"), F.min("k1"), F.max("k1")).collect()}
        coarse = _spread(open_, counts, slack, 1)
        nxt = []
        for cut in open_:
            cut.at = cut.part if cut.part < 2**63 else cut.part - 2**64
            if cut not in coarse:
                after = cut.want - cut.below > cut.size / 2
                start = (cut.part + after) << (64 - bits)
                found[id(cut)] = (_order(min(start, 2**64 - 1)), -2**63)
            elif cut.lo == cut.hi:
                second.append(cut)
            else:
                nxt.append(cut)
        open_ = nxt
    # buckets that are one text: cut between ids
    id2, open_, bits = F.col("k2") - F.lit(low2), second, 0
    for cut in open_:
        cut.text, cut.at = cut.lo, (cut.lo, 0)
    while open_:
        held, bits = bits, min(bits2, bits + STEP_BITS)
        pairs = {c.at for c in open_}
        rows = thin.where(F.col("k1").isin(sorted({a for a, _ in pairs})))
        before = _prefix(id2, held, bits2) if held else F.lit(0).cast("long")
        counts = {((r[0], r[1]), r[2]): (r[3], r[4], r[5]) for r in rows.groupBy(
            "k1", before.alias("b"), _prefix(id2, bits, bits2).alias("p")).agg(
                F.sum("size"), F.min("k2"), F.max("k2")).where(
                    F.struct("k1", "b").isin([F.struct(F.lit(a).cast("long"), F.lit(b).cast("long"))
                                              for a, b in sorted(pairs)])).collect()}
        coarse = _spread(open_, counts, slack, 1)
        nxt = []
        for cut in open_:
            if cut in coarse and cut.lo != cut.hi and bits < bits2:
                cut.at = (cut.text, cut.part)
                nxt.append(cut)
            else:
                after = cut.want - cut.below > cut.size / 2
                found[id(cut)] = (cut.text, low2 + ((cut.part + after) << (bits2 - bits)))
        open_ = nxt
    return sorted(found[id(c)] for c in cuts)


def range_of(bounds: list[tuple[int, int]]) -> Column:
    """How many boundaries a row's key has reached, by binary search over a literal array."""
    if not bounds:
        return F.lit(0)
    a, b = (F.split(F.lit(",".join(str(x[i]) for x in bounds)), ",").cast("array<bigint>") for i in (0, 1))

    def step(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        reached = (F.get(a, mid) < F.col("k1")) | ((F.get(a, mid) == F.col("k1")) & (F.get(b, mid) <= F.col("k2")))
        open_ = s["lo"] < s["hi"]
        return F.struct(F.when(open_ & reached, mid + 1).otherwise(s["lo"]).alias("lo"),
                        F.when(open_ & ~reached, mid).otherwise(s["hi"]).alias("hi"))

    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi")), step,
                       lambda s: s["lo"])


def shards(docs: DataFrame, n_shards: int = 8, parts: int | None = None, tolerance: float = 0.01,
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size, text_crc32, shard and slot (gapless from 0 in a shard) of every row.

    ``parts`` ranges make up a shard; each is one task's share. Unless given, they are as many as
    keep a range at about ``RANGE_ROWS`` thin rows, and at least ``LEAST_PARTS``.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    whole = docs.schema[key].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint")
    k2 = F.col(key).cast("long") if whole else F.xxhash64(F.col(key))
    thin = materialize(docs.select(
        F.col(key).alias("key"), (F.octet_length(t) + 1).cast("long").alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"), F.xxhash64(t).alias("k1"),
        F.coalesce(k2, F.lit(-2**62).cast("long")).alias("k2")), "shards")
    if parts is None:
        parts = max(LEAST_PARTS, -(-thin.count() // (n_shards * RANGE_ROWS)))
    bounds = splitters(thin, n_shards * parts, tolerance)
    placed = thin.withColumn("range", range_of(bounds))
    counts = {r[0]: r[1] for r in placed.groupBy("range").count().collect()}
    first, seen = [], 0
    for i in range(n_shards * parts):
        seen = 0 if i % parts == 0 else seen
        first.append(seen)
        seen += counts.get(i, 0)
    firsts = F.split(F.lit(",".join(map(str, first))), ",").cast("array<bigint>")
    order = Window.partitionBy("range").orderBy("k1", "k2")
    return placed.select(
        F.col("key").alias(key), "size", "text_crc32",
        F.floor(F.col("range") / parts).cast("int").alias("shard"),
        (F.get(firsts, F.col("range")) + F.row_number().over(order) - 1).cast("long").alias("slot"))


def placement(docs: DataFrame) -> DataFrame:
    """The digest of the contract: law ``bytes``."""
    df = shards(docs.select("doc_id", "text"))
    return df.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                     F.lit(None).cast("int").alias("grown_shard"))
