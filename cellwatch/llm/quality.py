"""Rule bitmask ledger: every rule is evaluated once, policies are masks over its bits.

``ledger`` keeps the measurements and one bit per failed rule. A policy is a named, versioned
set of rules; applying it, comparing versions and ablating single rules need only the bits.

Defined results: null and empty texts measure 0 everywhere (and fail ``few_words``); repeated
rows repeat; other columns are dropped; an empty table gives an empty ledger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8

#: name, failing condition over the measurements; the position is the bit. Only append.
RULES = [
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbol_share", "2 * n_symbols > n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("shouting", "2 * n_bangs > n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 40 * n_words"),
    ("many_short_lines", "n_lines > 20 AND n_words < 2 * n_lines"),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}

#: Versions never change once used; a new policy is a new version.
POLICIES = {
    ("base", 1): ["few_words", "repeated_windows"],
    ("clean", 1): ["few_words", "repeated_windows", "symbol_share", "repeated_lines", "shouting"],
    ("strict", 1): [name for name, _ in RULES],
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bangs"]


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also where the body is a nested lambda."""
    return F.transform(F.array(value), body)[0]


def count_of(text: Column, chars: str) -> Column:
    """How often the given ASCII characters occur, without rebuilding the text."""
    return sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in chars),
               F.lit(0)).cast("long")


def words_of(text: Column) -> Column:
    """Words between space and the controls from tab to carriage return."""
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def repeated(words: Column) -> Column:
    """Words inside windows of eight that occur twice or more in the text, first included.

    Windows are compared by 64-bit hashes within one text. Only texts in which a hash repeats
    sort them; the rest of a text's windows never leave the row.
    """
    hashes = F.when(F.size(words) >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice(words, i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))

    def covered(hs: Column) -> Column:
        ordered = F.array_sort(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(ordered, lambda o: F.array_sort(F.transform(
            F.filter(o, lambda s, i: F.coalesce(F.get(o, i - 1)["h"] == s["h"], F.lit(False))
                     | F.coalesce(F.get(o, i + 1)["h"] == s["h"], F.lit(False))), lambda s: s["i"])))
        return F.aggregate(
            twice, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("at")),
            lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["at"])).alias("n"), p.alias("at")),
            lambda a: a["n"])

    return let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) < F.size(hs), covered(hs)).otherwise(0))


def measured(df: DataFrame, text: str = "text", into: str = "measured") -> DataFrame:
    """Adds one struct of all measurements."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    # one value, bound once: a struct of its own would be taken apart and computed per field
    return df.withColumn(into, let(words_of(t), lambda w: let(lines, lambda x: F.struct(
        F.size(w).cast("long").alias("n_words"),
        (F.length(t) - count_of(t, " \t\n\x0b\x0c\r")).cast("long").alias("word_chars"),
        count_of(t, "#*$%&|<>").alias("n_symbols"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated(w).cast("long").alias("n_repeat_words"),
        F.size(x).cast("long").alias("n_lines"), count_of(t, "!").alias("n_bangs")))))


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, the measurements, and ``failed``: one bit for each rule that fails."""
    df = measured(docs.select(F.col(key), F.col(text).alias("_text")), "_text", "_m").select(key, "_m.*")
    bits = " | ".join(f"if({condition}, {1 << i}, 0)" for i, (_, condition) in enumerate(RULES))
    return df.withColumn("failed", F.expr(f"cast({bits} AS bigint)"))


def mask(policy: tuple[str, int]) -> int:
    return sum(BIT[name] for name in POLICIES[policy])


def passes(policy: tuple[str, int], failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablation(entries: DataFrame, policy: tuple[str, int]) -> DataFrame:
    """One row per rule of a policy: rows that fail it, that fail nothing else of the policy,
    and that would be kept without it. One pass counts each pattern of bits (their number is
    bounded by the rules); the rest is bit arithmetic over the patterns."""
    whole = mask(policy)
    patterns = entries.groupBy(F.col("failed").bitwiseAND(F.lit(whole).cast("long")).alias("bits")).agg(
        F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit"))
                                for r in POLICIES[policy]]))
    bit, bits = F.col("r.bit"), F.col("bits")
    return patterns.select("bits", "n", rules.alias("r")).groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(bits.bitwiseAND(bit) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(bits == bit, F.col("n")).otherwise(0)).alias("n_only_this"),
        F.sum(F.when(bits.bitwiseAND(F.lit(whole).cast("long").bitwiseXOR(bit)) == 0, F.col("n")).otherwise(0))
        .alias("n_kept_without"))


def verdicts(docs: DataFrame, policy: tuple[str, int] = ("clean", 1)) -> DataFrame:
    """The digest of the contract."""
    return ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes(("base", 1))).alias("base_failed"), (passes(("base", 1)) & passes(policy)).alias("kept"))


def keep(docs: DataFrame, policy: tuple[str, int] = ("clean", 1), text: str = "text") -> DataFrame:
    """The rows that pass, with the columns they came with."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    df = docs.select(F.struct(*columns).alias("row"), F.col(text).alias("text"))
    bits = " | ".join(f"if({condition}, {1 << i}, 0)" for i, (_, condition) in enumerate(RULES))
    df = measured(df, "text", "m").select("row", "m.*").withColumn("failed", F.expr(f"cast({bits} AS bigint)"))
    return df.where(passes(("base", 1)) & passes(policy)).select("row.*")


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
r AS (
  SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
c AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM r) GROUP BY doc_id),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         len(ls) AS n_lines, length(t) - length(replace(t, '!', '')) AS n_bangs
  FROM w LEFT JOIN c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 2 * n_symbols > n_words
            OR 2 * n_dup_lines > n_lines OR 2 * n_bangs > n_words) AS kept
FROM m
"""
