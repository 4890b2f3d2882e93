"""Winnowing against brute force over all windows, and the extension along a diagonal."""

import re

import numpy as np
from pyspark.sql import functions as F

from cellwatch.llm import decontaminate


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(doc, items):
    """(hit words, items) by comparing every window of every item with every place."""
    w, hit, found = words(doc), set(), set()
    for item, text in items:
        iw = words(text)
        n = min(len(iw), 13)
        windows = {tuple(iw[k:k + n]) for k in range(len(iw) - n + 1)} if iw else set()
        for s in range(len(w) - n + 1):
            if n and tuple(w[s:s + n]) in windows:
                hit |= set(range(s, s + n))
                found.add(str(item))
    return len(w), len(hit), ",".join(sorted(found))


def test_against_all_windows(spark):
    rng = np.random.default_rng(11)
    items = []
    for i in range(40):
        kind = i % 5
        n = int(rng.integers(1, 13)) if kind == 0 else int(rng.integers(13, 60))
        alphabet = 2 if kind == 1 else 5 if kind == 2 else 400
        items.append((i, " ".join(f"b{k}" for k in rng.integers(0, alphabet, n))))
    items += [(100, items[7][1].upper()), (101, None), (102, ""), (103, "..."), (104, items[8][1] + " tail")]
    docs = []
    for i in range(120):
        parts = []
        for _ in range(int(rng.integers(0, 5))):
            w = words(items[int(rng.integers(0, 40))][1])
            a, b = sorted(rng.integers(0, len(w) + 1, 2))
            parts += [[f"x{k}" for k in rng.integers(0, 50, int(rng.integers(0, 9)))], w[a:b] if rng.random() < 0.6 else w]
        docs.append((i, " ".join(t for p in parts for t in p)))
    docs += [(500, None), (501, ""), (None, items[12][1]), (None, "other words"), (7, items[13][1]), (8, docs[8][1]),
             (502, "b0 b1 " * 400), (503, " - ".join(words(items[14][1])))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("w", F.lit("x")).withColumn("places", F.lit(1))
    table = spark.createDataFrame(items, "item_id bigint, text string").withColumn("iw", F.lit("y"))
    rows = decontaminate.hits(df, decontaminate.Benchmark(table)).select(
        "id", "n_words", F.coalesce(decontaminate.covered(F.col("places")), F.lit(0)).alias("n_hit"),
        F.coalesce(F.array_join("items", ","), F.lit("")).alias("items")).collect()
    want = [(i, *plain(t, items)) for i, t in docs]
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    assert sum(w[2] > 0 for w in want) > 60
    # a fuller bit set lets more through to the join and changes nothing
    few = decontaminate.MOST_LONGS
    try:
        decontaminate.MOST_LONGS = 1
        again = decontaminate.hits(df, decontaminate.Benchmark(table))
        assert sorted((r.id, len(r.places or [])) for r in again.collect() if r.id is not None) == sorted(
            (r.id, len(r.places or [])) for r in decontaminate.hits(df, decontaminate.Benchmark(table)).collect() if r.id is not None)
    finally:
        decontaminate.MOST_LONGS = few


def test_spans_on_a_diagonal(spark):
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(60):
        d = rng.integers(0, 2, int(rng.integers(13, 70)))
        i = rng.integers(0, 2, int(rng.integers(13, 40)))
        shift = int(rng.integers(-len(i) + 1, len(d)))
        lo, hi = max(shift, 0), min(len(d), len(i) + shift)
        for a, b in [sorted(rng.integers(lo, hi + 1, 2))]:
            d[a:b] = i[a - shift:b - shift]
        rows.append(([str(x) for x in d], [str(x) for x in i], shift))
    got = spark.createDataFrame(rows, "d array<string>, i array<string>, shift int").select(
        decontaminate.spans(F.col("d"), F.col("i"), F.col("shift")).alias("s")).collect()
    seen = 0
    for (d, i, shift), row in zip(rows, got):
        lo, hi = max(shift, 0), min(len(d), len(i) + shift)
        same = "".join("1" if d[k] == i[k - shift] else "0" for k in range(lo, hi))
        want = [(lo + m.start() + 1, len(m[0])) for m in re.finditer("1+", same) if len(m[0]) >= 13]
        assert [tuple(x) for x in row.s] == want
        seen += len(want)
    assert seen > 5
