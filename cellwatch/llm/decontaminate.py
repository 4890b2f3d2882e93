"""Benchmark decontamination by winnowing.

Every run of 7 words is hashed, and of every 7 runs in a row the least hash, with its place, is a
fingerprint: two texts that share 13 words in a row share one there, always, at the same distance from the span's
start. Equal fingerprints of neighbouring windows are one. The fingerprints of the benchmark are a table
(hash, item, place) and a bit set; a document's windows are looked up in the bit set inside their row, and only
fingerprints whose bit is set leave it. They are joined with the table by hash. A match says that a document and an
item may agree along a diagonal, and there it is extended: word by word over the item's whole length, which gives
all common spans of 13 words or more and drops what only a hash had in common. The union of
the spans is hit.

Items of fewer than 13 words are one window each; a document's places for them are those whose
first word opens such an item, joined by the window's words. No side is broadcast by hint: Spark broadcasts the
benchmark while it measures it small, and splits skewed joins beyond that.

Defined results: null and empty texts have no words and no hits, a null id is a row like others; items without words
never occur; items of equal words occur together; repeated rows repeat; a very long text is one row; ``report``
drops other columns, ``clean`` keeps them; empty tables give zeros or no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.sources.scratch import materialize

from .common import lower_ascii
from .quality import let

WINDOW, GRAM = 13, 7
#: Bits per fingerprint of the benchmark, and how many words of 64 bits the set has at most, which
#: bounds what every task carries; a fuller set lets more fingerprints through to the join and changes no result.
BITS_EACH, MOST_LONGS = 256, 1 << 16
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DROP_SHARE = 20


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), NOT_WORD), "")


def grams(words: Column) -> Column:
    """The hash of each run of 7 words, by its start: words are hashed once, runs from the words' hashes."""
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.transform(
        F.sequence(F.lit(1), F.size(h) - (GRAM - 1)), lambda i: F.xxhash64(F.slice(h, i, GRAM))))


def fingerprints(words: Column, wanted: Callable[[Column], Column] | None = None) -> Column:
    """(h, at) of all windows of at least 13 words, each fingerprint once: the least hash of a window's runs and the first
    place (from 1) it has there. ``wanted`` keeps hashes before places are looked for."""

    def least(g: Column, i: Column) -> Column:
        return F.array_min(F.slice(g, i, WINDOW - GRAM + 1))

    def found(g: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(g) - (WINDOW - GRAM))
        some = F.transform(starts, lambda i: F.struct(i.alias("i"), least(g, i).alias("h")))
        if wanted is not None:
            some = F.filter(some, lambda x: wanted(x["h"]))
        return F.array_distinct(F.transform(some, lambda x: F.struct(
            x["h"].alias("h"), (x["i"] - 1 + F.array_position(F.slice(g, x["i"], WINDOW - GRAM + 1), x["h"])).cast("int").alias("at"))))

    none = F.array().cast("array<struct<h:bigint,at:int>>")
    return F.when(F.size(words) >= WINDOW, let(grams(words), found)).otherwise(none)


class Bits:
    """A set of hashes as a literal array of longs; its size depends on the benchmark only."""

    def __init__(self, hashes: DataFrame):
        n = hashes.count()
        self.longs = 64
        while self.longs * 64 < n * BITS_EACH and self.longs < MOST_LONGS:
            self.longs *= 2
        at, bit = self._place(F.col("h"))
        rows = hashes.groupBy(at.alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("set"))
        held = [0] * self.longs
        for r in rows.collect():
            held[r[0]] = r[1]
        self.empty = not n
        self.array = F.split(F.lit(",".join(map(str, held))), ",").cast("array<bigint>")

    def _place(self, h: Column) -> tuple[Column, Column]:
        return (F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(self.longs - 1).cast("long")).cast("int"),
                h.bitwiseAND(F.lit(63).cast("long")).cast("int"))

    def has(self, h: Column) -> Column:
        at, bit = self._place(h)
        return F.call_function("shiftright", F.get(self.array, at), bit).bitwiseAND(F.lit(1).cast("long")) == 1


class Benchmark:
    """The items by their words: fingerprints of the long ones, the short ones as windows, who holds each."""

    def __init__(self, items: DataFrame, key: str = "item_id", text: str = "text"):
        split = items.select(F.col(key).cast("string").alias("item"), words_of(F.col(text)).alias("iw")).where(
            F.size("iw") > 0)
        #: Items of equal words are one text, known by its hash and compared by its words.
        self.texts = split.groupBy("iw").agg(F.array_sort(F.collect_set("item")).alias("items")).withColumn(
            "text_id", F.xxhash64(F.array_join("iw", " ")))
        long_ = self.texts.where(F.size("iw") >= WINDOW)
        self.prints = long_.select("text_id", F.inline(fingerprints(F.col("iw"))).alias("h", "q"))
        self.windows = self.texts.where(F.size("iw") < WINDOW).select(
            F.size("iw").alias("n"), F.array_join("iw", " ").alias("gram"), "items", F.xxhash64(F.get("iw", 0)).alias("h"))
        self.bits = Bits(self.prints.select("h").distinct())
        self.lengths = sorted(r[0] for r in self.windows.select("n").distinct().collect())  # fewer than 13
        self.openers = Bits(self.windows.select("h").distinct()) if self.lengths else None

    def long_places(self, words: Column) -> Column:
        """(h, at) of a row's fingerprints that the benchmark may have."""
        none = F.array().cast("array<struct<h:bigint,at:int>>")
        return none if self.bits.empty else fingerprints(words, self.bits.has)

    def short_windows(self, words: Column) -> Column:
        """(start, length, words) of a row's windows that may be a short item."""
        if not self.lengths:
            return F.array().cast("array<struct<s:int,n:int,gram:string>>")
        lengths = F.array(*[F.lit(n) for n in self.lengths])
        return let(words, lambda w: F.flatten(F.transform(F.filter(
            F.transform(w, lambda x, i: F.when(self.openers.has(F.xxhash64(x)), (i + 1).cast("int"))),
            lambda i: i.isNotNull()), lambda i: F.transform(
                F.filter(lengths, lambda n: i + n - 1 <= F.size(w)),
                lambda n: F.struct(i.alias("s"), n.alias("n"), F.array_join(F.slice(w, i, n), " ").alias("gram"))))))


def spans(words: Column, item: Column, shift: Column) -> Column:
    """(start, length) of the common spans of 13 words or more of a document and an item whose first word
    lies ``shift`` words behind the document's first."""
    lo = F.greatest(shift, F.lit(0))
    n = F.least(F.size(words), F.size(item) + shift) - lo

    def closed(acc: Column) -> Column:
        return F.when(acc["n"] >= WINDOW, F.array_append(acc["out"], F.struct(
            acc["s"].alias("s"), acc["n"].alias("n")))).otherwise(acc["out"])

    def add(acc: Column, same: Column) -> Column:
        return F.struct((acc["at"] + 1).alias("at"), F.when(same & (acc["n"] > 0), acc["s"]).otherwise(acc["at"]).alias("s"),
                        F.when(same, acc["n"] + 1).otherwise(0).alias("n"),
                        F.when(same, acc["out"]).otherwise(closed(acc)).alias("out"))

    same = F.zip_with(F.slice(words, lo + 1, n), F.slice(item, lo - shift + 1, n), lambda a, b: a == b)
    zero = F.struct((lo + 1).cast("int").alias("at"), F.lit(0).alias("s"), F.lit(0).alias("n"),
                    F.array().cast("array<struct<s:int,n:int>>").alias("out"))
    return F.aggregate(same, zero, add, closed)


def hits(docs: DataFrame, benchmark: Benchmark, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, h, n_words, places): each row's words, and the sorted (start, length, items) of its
    exact matches; null where it has none. ``h`` tells rows of one id with other texts apart."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = docs.select(F.col(key).alias("id"), F.xxhash64(t).alias("h"), words_of(t).alias("w"))
    # one pass over the texts; words are kept only of rows that hold a fingerprint the benchmark may have
    rows = materialize(base.select("id", "h", "w", benchmark.long_places(F.col("w")).alias("l"),
                                   benchmark.short_windows(F.col("w")).alias("c")).select(
        "id", "h", F.size("w").cast("long").alias("n_words"), F.when(F.size("l") > 0, F.col("w")).alias("w"), "l", "c"), "places")
    found = rows.where("w IS NOT NULL").dropDuplicates(["id", "h"])
    # fingerprints meet by hash; a document and an item text are compared once on each diagonal
    met = found.select("id", "h", F.explode("l").alias("p")).join(
        benchmark.prints.select(F.col("h").alias("fp"), "text_id", "q"), F.col("p.h") == F.col("fp")).select(
            F.col("id").alias("id1"), F.col("h").alias("h1"), "text_id", (F.col("p.at") - F.col("q")).alias("shift")).distinct()
    extended = met.join(benchmark.texts.select("text_id", "iw", "items"), "text_id").join(
        found.select("id", "h", "w"), F.col("id1").eqNullSafe(F.col("id")) & (F.col("h1") == F.col("h"))).select(
            "id", "h", spans(F.col("w"), F.col("iw"), F.col("shift")).alias("spans"), "items").where(F.size("spans") > 0)
    whole = rows.select("id", "h", F.inline("c")).join(benchmark.windows.select("gram", "n", "items"), ["gram", "n"]).select(
        "id", "h", F.array(F.struct("s", "n")).alias("spans"), "items")
    matched = extended.unionByName(whole).groupBy(F.col("id").alias("id2"), F.col("h").alias("h2")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("places"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    thin = rows.select("id", "h", "n_words")
    return thin.join(matched, thin["id"].eqNullSafe(matched["id2"]) & (thin["h"] == matched["h2"]), "left").drop(
        "id2", "h2")


def covered(places: Column) -> Column:
    """Words in the union of the (start, length) intervals, sorted by start."""
    return F.aggregate(
        places, F.struct(F.lit(0).alias("n"), F.lit(1).alias("to")),
        lambda a, p: F.struct(
            (a["n"] + F.greatest(F.lit(0), p["s"] + p["n"] - F.greatest(p["s"], a["to"]))).alias("n"),
            F.greatest(a["to"], p["s"] + p["n"]).alias("to")),
        lambda a: a["n"])


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The digest of the contract."""
    df = hits(docs.select("doc_id", "text"), Benchmark(items))
    n = F.coalesce(covered(F.col("places")), F.lit(0)).cast("long")
    df = df.select(F.col("id").alias("doc_id"), "n_words", n.alias("n_hit"),
                   F.coalesce(F.col("items"), F.array().cast("array<string>")).alias("items"))
    return df.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (DROP_SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that are not contaminated, with the columns they came with."""
    df = hits(docs, Benchmark(items), key, text).where(
        F.col("places").isNotNull() & (DROP_SHARE * covered(F.col("places")) >= F.col("n_words"))).select(
            F.col("id").alias("_bad_id"), F.col("h").alias("_bad_h")).distinct()
    # both names are new to the rows: they exist on one side only and are gone after an anti join
    same = docs[key].eqNullSafe(df["_bad_id"]) & (
        F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit(""))) == df["_bad_h"])
    return docs.join(df, same, "left_anti")


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
i AS (
  SELECT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, s, s + 12), ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 11, 2))) AS s FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM i),
x AS (
  SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, ns WHERE len(w) >= n)),
m AS (SELECT DISTINCT doc_id, s, x.n, item_id FROM x JOIN i ON x.n = i.n AND x.g = i.g),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM m) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
