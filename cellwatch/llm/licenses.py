"""Ordered licence signatures: keyword prefilter, regexes with priorities, suppression.

A text is lower-cased and cut into words; rules are matched against its words joined by single
spaces, so a match is an interval of words. A rule is tried only on texts that contain its
keyword. A match is suppressed if another one covers its interval and has a stronger priority,
or the same priority and a longer interval (or the same interval and an earlier rule).

Suppression sorts the matches of a text by start and compares each with the furthest end seen
so far per priority: linear after the sort, however many matches a text has.

Defined results: null and empty texts have no words and no labels; repeated rows repeat; other
columns are dropped; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import lower_ascii
from .quality import let

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases of the base count, as words, with their labels (fixed values).
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

#: label, keyword that a text must contain, regex of the name, regex of its versions.
#: Names are written as words: no punctuation, single spaces.
FAMILIES = [
    ("gpl", "general public", r"(?:the )?gnu general public licen[sc]e", r"[123](?: 0)?"),
    ("gpl", "gpl", r"gnu gpl|gpl", r"v?[123](?: 0)?(?: only| or later)?"),
    ("lgpl", "lesser general", r"(?:the )?gnu lesser general public licen[sc]e", r"[23](?: [01])?"),
    ("lgpl", "lgpl", r"gnu lgpl|lgpl", r"v?[23](?: [01])?(?: only| or later)?"),
    ("lgpl", "library general", r"(?:the )?gnu library general public licen[sc]e", r"2(?: 0)?"),
    ("agpl", "affero", r"(?:the )?gnu affero general public licen[sc]e", r"[13](?: 0)?"),
    ("agpl", "agpl", r"gnu agpl|agpl", r"v?[13](?: 0)?(?: only| or later)?"),
    ("gfdl", "free documentation", r"(?:the )?gnu free documentation licen[sc]e", r"1 [123]"),
    ("gfdl", "gfdl", r"gfdl", r"v?1 [123]"),
    ("apache", "apache", r"(?:the )?apache(?: software)? licen[sc]e", r"[12](?: [01])?"),
    ("apache", "asl", r"asl", r"2 0"),
    ("mit", "mit", r"(?:the )?mit licen[sc]e", r"0"),
    ("mit", "expat", r"(?:the )?expat licen[sc]e", r"1"),
    ("mit", "x11", r"(?:the )?x11 licen[sc]e", r"1"),
    ("bsd-2", "bsd", r"(?:the )?(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?", r"patent"),
    ("bsd-3", "bsd", r"(?:the )?(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?", r"clear"),
    ("bsd-4", "bsd", r"(?:the )?(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[sc]e)?", r"uc"),
    ("bsd", "bsd", r"(?:the )?bsd(?: style)? licen[sc]e", r"0"),
    ("0bsd", "0bsd", r"0bsd|zero clause bsd", r"1"),
    ("isc", "isc", r"(?:the )?isc licen[sc]e", r"1"),
    ("mpl", "mozilla public", r"(?:the )?mozilla public licen[sc]e", r"[12](?: [01])?"),
    ("mpl", "mpl", r"mpl", r"v?[12] [01]"),
    ("epl", "eclipse public", r"(?:the )?eclipse public licen[sc]e", r"[12](?: 0)?"),
    ("epl", "epl", r"epl", r"v?[12] 0"),
    ("edl", "eclipse distribution", r"(?:the )?eclipse distribution licen[sc]e", r"1(?: 0)?"),
    ("cddl", "development and distribution", r"(?:the )?common development and distribution licen[sc]e", r"1 [01]"),
    ("cddl", "cddl", r"cddl", r"v?1 [01]"),
    ("cpl", "common public", r"(?:the )?common public licen[sc]e", r"1 0"),
    ("eupl", "european union public", r"(?:the )?european union public licen[sc]e", r"1 [012]"),
    ("eupl", "eupl", r"eupl", r"v?1 [012]"),
    ("artistic", "artistic", r"(?:the )?artistic licen[sc]e", r"[12](?: 0)?"),
    ("bsl", "boost software", r"(?:the )?boost software licen[sc]e", r"1(?: 0)?"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", r"1"),
    ("wtfpl", "wtfpl", r"wtfpl", r"2"),
    ("zlib", "zlib", r"(?:the )?zlib(?: libpng)? licen[sc]e", r"1"),
    ("ofl", "open font", r"(?:the )?(?:sil )?open font licen[sc]e", r"1 [01]"),
    ("python", "python", r"(?:the )?(?:python software foundation|psf|python) licen[sc]e", r"[23](?: \d+)?"),
    ("php", "php", r"(?:the )?php licen[sc]e", r"3 0\d?"),
    ("postgresql", "postgresql", r"(?:the )?postgresql licen[sc]e", r"1"),
    ("ncsa", "ncsa", r"(?:the )?(?:university of illinois )?ncsa(?: open source)? licen[sc]e", r"1"),
    ("openssl", "openssl", r"(?:the )?openssl licen[sc]e", r"1"),
    ("sspl", "server side public", r"(?:the )?server side public licen[sc]e", r"1"),
    ("busl", "business source", r"(?:the )?business source licen[sc]e", r"1 [01]"),
    ("elastic", "elastic", r"(?:the )?elastic licen[sc]e", r"v?[12](?: 0)?"),
    ("odbl", "open database", r"(?:the )?(?:odc )?open database licen[sc]e", r"1 0"),
    ("odc-by", "data commons attribution", r"(?:the )?open data commons attribution licen[sc]e", r"1 0"),
    ("cc0", "cc0", r"cc0", r"1 0"),
    ("cc0", "cc zero", r"cc zero", r"1 0"),
    ("cc-by-nc-nd", "cc by", r"cc by nc nd", r"[1234] [05]"),
    ("cc-by-nc-sa", "cc by", r"cc by nc sa", r"[1234] [05]"),
    ("cc-by-nc", "cc by", r"cc by nc", r"[1234] [05]"),
    ("cc-by-nd", "cc by", r"cc by nd", r"[1234] [05]"),
    ("cc-by-sa", "cc by", r"cc by sa", r"[1234] [05]"),
    ("cc-by", "cc by", r"cc by", r"[1234] [05]"),
    ("cc-by-sa", "share", r"creative commons attribution share ?alike(?: licen[sc]e)?", r"[1234] [05]"),
    ("cc-by-nc", "noncommercial", r"creative commons attribution noncommercial(?: licen[sc]e)?", r"[1234] [05]"),
    ("cc-by", "creative commons", r"creative commons attribution(?: licen[sc]e)?", r"[1234] [05]"),
    ("public-domain", "public domain", r"(?:in|into|to) the public domain", r"1"),
    ("proprietary", "all rights reserved", r"all rights reserved", r"1"),
]

#: form, priority (1 strongest), weight of evidence, regex around {name} and {version}.
FORMS = [
    ("tag", 1, 0.99, r"spdx licen[sc]e identifier (?:{name})(?: {version})?"),
    ("grant", 2, 0.95, r"(?:licensed|released|distributed|published|available|provided|redistributable) under"
                       r"(?: the terms of)?(?: the)?(?: terms of)?(?: the)? (?:{name})(?:(?: version| v)? {version})?"),
    ("conditions", 2, 0.9, r"(?:subject to|governed by|covered by|pursuant to)(?: the terms of)?(?: the)? (?:{name})"
                           r"(?:(?: version| v)? {version})?"),
    ("choice", 2, 0.85, r"(?:under (?:either )?the|choose (?:either )?the|dual licensed under) (?:{name})"
                        r"(?:(?: version| v)? {version})?"),
    ("versioned", 3, 0.8, r"(?:{name})(?: version| v)? {version}"),
    ("named", 4, 0.6, r"(?:{name})"),
]
PRIORITIES = sorted({p for _, p, _, _ in FORMS})


def rules() -> list[tuple[int, str, int, float, str, str]]:
    """(order, label, priority, weight, keyword, regex): every form of every family."""
    made = [(label, priority, weight, keyword, form.format(name=name, version=rf"(?:{version})"))
            for _, priority, weight, form in FORMS for label, keyword, name, version in FAMILIES]
    return [(i, label, priority, weight, keyword, rf"(?<![^ ]){pattern}(?![^ ])")
            for i, (label, priority, weight, keyword, pattern) in enumerate(made)]


KEYWORDS = sorted({f[1] for f in FAMILIES})


def _needed(keyword: str, name: str) -> str:
    """What a text must hold for a name to match: ``licen`` if no form goes without, or a word of its keyword."""
    always = re.sub(r"\(\?:[^()]*\)\?", "", name)
    return "licen" if all("licen[sc]e" in part for part in always.split("|")) else max(keyword.split(" "), key=len)


#: A text that holds none of these has no match.
GATE = sorted({_needed(keyword, name) for _, keyword, name, _ in FAMILIES})
GATE += [phrase.split(" ")[0] for phrase, _ in BASE if not any(w in phrase for w in GATE)]


def _places(words: Column, text: Column) -> Column:
    """Starts of all base phrases, with their labels; only where a phrase's text occurs."""
    out = []
    for phrase, label in BASE:
        parts = phrase.split(" ")

        def here(w: Column, i: Column, parts=parts) -> Column:
            test = w == parts[0]
            for k, part in enumerate(parts[1:], 1):
                test = test & (F.coalesce(F.get(words, i + k), F.lit("")) == part)
            return test

        starts = F.filter(F.transform(words, lambda w, i: F.when(here(w, i), i)), lambda i: i.isNotNull())
        out.append(F.when(F.contains(text, F.lit(phrase)), F.transform(
            starts, lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))).otherwise(
                F.array().cast("array<struct<at:bigint,label:string>>")))
    return F.flatten(F.array(*out))


def detections(texts: DataFrame) -> DataFrame:
    """(id, label, priority, weight, start, end) of what is left after suppression.

    ``texts`` has id, words_text (words joined by spaces) and keywords (those it contains).
    """
    spark = texts.sparkSession
    table = spark.createDataFrame(rules(), "ord int, label string, priority int, weight double, keyword string, regex string")
    # bounded: the rules are a constant of this file
    tried = texts.select("id", "words_text", F.explode("keywords").alias("keyword")).join(
        F.broadcast(table), "keyword")
    hits = F.regexp_extract_all("words_text", "regex", F.lit(0))
    found = tried.withColumn("hits", hits).where(F.size("hits") > 0).select(
        "id", "ord", "label", "priority", "weight",
        F.posexplode(F.arrays_zip(F.split("words_text", F.col("regex"), -1).alias("gap"), F.col("hits").alias("hit"))))
    # a match starts after all gaps and matches before it; both are counted in words
    upto = Window.partitionBy("id", "ord").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    length = _spaces(F.coalesce(F.col("col.hit"), F.lit("")))
    rows = found.withColumn("end", F.sum(_spaces(F.col("col.gap")) + length).over(upto) + 1).where(
        F.col("col.hit").isNotNull()).select(
            "id", "ord", "label", "priority", "weight", (F.col("end") - length - 1).alias("start"), "end").distinct()
    order = Window.partitionBy("id").orderBy("start", F.desc("end"), "priority", "ord").rowsBetween(
        Window.unboundedPreceding, -1)
    ends = {p: F.max(F.when(F.col("priority") == p, F.col("end"))).over(order) for p in PRIORITIES}
    rows = rows.withColumns({f"end_{p}": e for p, e in ends.items()})
    covered = F.lit(False)
    for p in PRIORITIES:
        covered = covered | ((F.col("priority") >= p) & F.coalesce(F.col(f"end_{p}") >= F.col("end"), F.lit(False)))
    return rows.where(~covered).select("id", "label", "priority", "weight", "start", "end")


def _spaces(s: Column) -> Column:
    return F.octet_length(s) - F.octet_length(F.replace(s, F.lit(" "), F.lit("")))


def scan(docs: DataFrame) -> DataFrame:
    """The digest of the contract. ``score`` is the strongest evidence's weight, 0 without any."""
    low = lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit("")))
    base = docs.select("doc_id", low.alias("low")).select(
        "doc_id", F.array_remove(F.split("low", NOT_WORD), "").alias("words"),
        # a phrase's words may stand apart in the text, so the gate is one word of each
        reduce(or_, [F.contains("low", F.lit(w)) for w in GATE]).alias("gate"))
    joined = base.select(
        "doc_id", "words", F.size("words").cast("long").alias("n_words"),
        F.when(F.col("gate"), F.array_join("words", " ")).otherwise("").alias("words_text"))
    keywords = let(F.col("words_text"), lambda x: F.filter(
        F.array(*[F.lit(k) for k in KEYWORDS]), lambda k: F.contains(x, k)))
    scanned = joined.select(
        "doc_id", "n_words", "words_text", F.xxhash64("words_text", "n_words").alias("h"),
        let(F.col("words"), lambda w: _places(w, F.col("words_text"))).alias("places"),
        F.when(F.col("words_text") != "", keywords).otherwise(F.array().cast("array<string>")).alias("keywords"))
    # rows alike in id and words have the same matches, so a copy of a row needs none of its own
    texts = scanned.where(F.size("keywords") > 0).select(
        F.struct("doc_id", "h").alias("id"), "words_text", "keywords")
    found = detections(texts).groupBy("id").agg(
        F.collect_set("label").alias("more"), F.max("weight").alias("weight"), F.count("*").alias("n_kept"))
    thin = scanned.select(
        "doc_id", "n_words", "h", F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["at"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["at"])).alias("last_word"),
        F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"]))).alias("base"))
    joinable = found.select(F.col("id.doc_id").alias("d"), F.col("id.h").alias("h2"), "more", "weight", "n_kept")
    both = thin.join(joinable, thin["doc_id"].eqNullSafe(joinable["d"]) & (thin["h"] == joinable["h2"]), "left")
    more = F.coalesce(F.col("more"), F.array().cast("array<string>"))
    return both.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.concat_ws(",", "base").alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union(F.col("base"), more))).alias("labels"),
        F.greatest(F.coalesce(F.col("weight"), F.lit(0.0)),
                   F.when(F.col("n_base") > 0, 0.6).otherwise(0.0)).alias("score"),
        F.coalesce(F.col("n_kept"), F.lit(0)).cast("long").alias("n_kept"))
