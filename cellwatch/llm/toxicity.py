"""Toxicity with a subsequence string kernel, Nyström landmarks and a support vector machine.

Two words are alike in as far as they share subsequences of three characters, each weighted by
``DECAY`` to the power of the length it spans (at most ``SPAN``, word ends included). So an insult
with inserted or left-out characters still resembles itself. Texts are cut into words of letters
and digits; three or more single characters in a row are read as one spaced-out word.

Fitting (on labelled rows of the training folds only):

1. A bounded sample, at most ``MOST_TOXIC`` toxic and ``MOST_CLEAN`` clean rows by the hash of the id.
2. Words are counted per class over groups of near copies, so a copied text counts once; words
   that tell the classes apart beyond chance, given how many words are tried, are the examples,
   each also with an inserted and a doubled character. Other words are examples of the other class.
3. Landmarks are drawn from both; each word maps to its kernel values with them, whitened, and a
   linear machine with squared hinge loss is fitted. Words of clean texts that come nearest to
   the wrong side are added and it is fitted again, twice.
4. A logistic curve turns the largest margin of a text's words into a score.

Scoring needs no landmarks: the machine is a weight per subsequence, held in a sorted array.

Defined results: null and empty texts score as texts without any word of weight; rows repeat as
they come; labels other than 0 and 1, and ids with both, are not used; without words that tell
the classes apart every text has the score of the toxic share, below one half; other columns are
dropped; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch.sources.scratch import materialize

from .common import ALNUM, LOWER, UPPER, crc_rest, slices, utf8
from .neardup import shingle_sets

DECAY, SPAN, LANDMARKS = 0.7, 7, 768
MOST_TOXIC, MOST_CLEAN, MOST_SEEDS, MOST_OTHERS, HARD = 8_000, 16_000, 256, 2_000, 500
FOLDS, HELD = 5, 0
REMEMBER = 500_000

_LOWER = str.maketrans(UPPER, LOWER)
_WORDS = re.compile(ALNUM)


def words_of(text: str | None) -> list[str]:
    """Words of a text, spaced-out words put together."""
    words = _WORDS.findall((text or "").translate(_LOWER))
    out, run = [], []
    for w in words:
        if len(w) == 1:
            run.append(w)
            continue
        if run:
            out += ["".join(run)] if len(run) > 2 else run
            run = []
        out.append(w)
    return out + (["".join(run)] if len(run) > 2 else run)


#: Offsets of the second and third character from the first, for all spans.
SHAPES = [(j, k) for k in range(2, SPAN) for j in range(1, k)]
CELLS = 1 << 21


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, subsequences, weights): words of equal length together, a matrix of all subsequences
    of each, equal ones not yet put together, and the weight of each column."""
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    for n in np.unique(lengths):
        shapes = [x for x in SHAPES if x[1] < n]
        columns = sum(n - k for _, k in shapes)
        if not columns:
            continue
        rows = np.flatnonzero(lengths == n)
        for of in np.array_split(rows, -(-len(rows) * columns // CELLS)):
            text = "".join(f"\2{words[i]}\3" for i in of)
            chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(of), n).astype(np.uint64)
            first, second = chars << np.uint64(42), chars << np.uint64(21)
            codes = np.concatenate([first[:, :n - k] | second[:, j:n - k + j] | chars[:, k:] for j, k in shapes], 1)
            yield of, codes, np.concatenate([np.full(n - k, DECAY ** (k + 1)) for _, k in shapes])


def _distinct(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, subsequence, weight), equal subsequences of a row added up."""
    order = np.argsort(codes, 1)
    codes, weights = np.take_along_axis(codes, order, 1), weights[order]
    new = np.ones(codes.shape, bool)
    new[:, 1:] = codes[:, 1:] != codes[:, :-1]
    first = np.flatnonzero(new.ravel())
    return first // codes.shape[1], codes.ravel()[first], np.add.reduceat(weights.ravel(), first)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, subsequence, weight) of each word's distinct subsequences; rows have length one."""
    parts = [(np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0))]
    for of, codes, weights in _by_length(words):
        row, code, weight = _distinct(codes, weights)
        parts.append((of[row], code, weight / np.sqrt(np.bincount(row, weight * weight))[row]))
    row, code, weight = (np.concatenate(x) for x in zip(*parts))
    return row, code, weight


def kernel(words: list[str], others: list[str]) -> np.ndarray:
    """Values of the normalized kernel: (words, others)."""
    row, code, weight = features(words)
    orow, ocode, oweight = features(others)
    order = np.argsort(ocode, kind="stable")
    orow, ocode, oweight = orow[order], ocode[order], oweight[order]
    out = np.zeros(len(words) * len(others))
    for a in range(0, len(code), 1 << 18):
        part = code[a:a + (1 << 18)]
        lo, hi = np.searchsorted(ocode, part, "left"), np.searchsorted(ocode, part, "right")
        n = hi - lo
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        cell = np.repeat(row[a:a + (1 << 18)], n) * len(others) + orow[at]
        out += np.bincount(cell, np.repeat(weight[a:a + (1 << 18)], n) * oweight[at], len(out))
    return out.reshape(len(words), len(others))


def _slot(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64)


class Machine:
    """Weight per subsequence, an offset, and the logistic curve over a text's largest margin."""

    def __init__(self, codes: np.ndarray, weights: np.ndarray, offset: float):
        self.codes, self.weights, self.offset = codes, weights, offset
        self.slope, self.shift = 1.0, 0.0

    def margins(self, words: list[str]) -> np.ndarray:
        """Weights are found through a table by hash that holds one subsequence a slot; the few
        that share a slot with another are searched for. Only words in which a subsequence
        repeats need their subsequences put together for their length."""
        out = np.full(len(words), self.offset)
        if not len(self.codes):
            return out
        table = np.zeros(1 << 20, np.int32)
        table[_slot(self.codes)] = np.arange(len(self.codes)) + 1
        held = np.concatenate([np.zeros(1, np.uint64), self.codes])
        value = np.concatenate([np.zeros(1), self.weights])
        for of, codes, weights in _by_length(words):
            at = table[_slot(codes)]
            found = value[at]
            row, column = np.nonzero((at > 0) & (held[at] != codes))
            other = codes[row, column]
            near = np.minimum(np.searchsorted(self.codes, other), len(self.codes) - 1)
            found[row, column] = np.where(self.codes[near] == other, self.weights[near], 0)
            norm = np.full(len(of), np.sqrt((weights * weights).sum()))
            ordered = np.sort(codes, 1)
            twice = np.flatnonzero((ordered[:, 1:] == ordered[:, :-1]).any(1))
            if len(twice):
                again, _, weight = _distinct(codes[twice], weights)
                norm[twice] = np.sqrt(np.bincount(again, weight * weight))
            out[of] += found @ weights / norm
        return out

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -60, 60)))


def fit_words(seeds: list[str], others: list[str]) -> Machine:
    """The machine between two lists of words."""
    more = [v for w in seeds if len(w) > 3 for v in (w[:2] + "x" + w[2:], w[:-2] + w[-2] + w[-2:], w[:1] + "0" + w[2:])]
    words = seeds + more + others
    y = np.array([1.0] * (len(seeds) + len(more)) + [-1.0] * len(others))
    step = max(1, -(-len(others) // max(1, LANDMARKS - min(len(seeds), LANDMARKS * 2 // 3))))
    marks = list(dict.fromkeys(seeds[:LANDMARKS * 2 // 3] + others[::step]))[:LANDMARKS]
    value, vector = np.linalg.eigh(kernel(marks, marks))
    white = vector / np.sqrt(np.maximum(value, 1e-6))
    x = np.hstack([kernel(words, marks) @ white, np.ones((len(words), 1))])
    cost = np.where(y > 0, 1.0, max(1.0, (y > 0).sum() / max(1, (y < 0).sum())))
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1]) * 0.1
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        on = y * (x @ w) < 1
        xs = x[on] * cost[on, None]
        new = np.linalg.solve(ridge + xs.T @ x[on], xs.T @ y[on])
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    row, code, weight = features(marks)
    codes, at = np.unique(code, return_inverse=True)
    return Machine(codes, np.bincount(at, weight * (white @ w[:-1])[row]), float(w[-1]))


def largest_margins(texts: DataFrame, machine: Machine, rest: str) -> DataFrame:
    """``texts`` has text and what ``rest`` (a DDL of the other columns, in order) names; text is
    replaced by margin, the largest over its words, null without words."""
    names = [f.split()[0] for f in rest.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                words = [set(words_of(t)) for t in part.column(0).to_pylist()]
                if len(known) > REMEMBER:
                    known = {}
                new = list(set().union(*words).difference(known))
                known.update(zip(new, machine.margins(new).tolist()))
                most = [max(map(known.__getitem__, w)) if w else None for w in words]
                yield pa.RecordBatch.from_arrays([pa.array(most, pa.float64()), *part.columns[1:]], ["margin", *names])

    return texts.select("text", *names).mapInArrow(run, f"margin double, {rest}")


def _sampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of the bounded sample of training rows."""
    rows = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("toxic").alias("toxic"), F.max("toxic").alias("hi")).where("toxic = hi").select("doc_id", "toxic")
    rows = rows.where(crc_rest(F.col("doc_id"), FOLDS) != HELD)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = rows.where("toxic = 1").orderBy(*order).limit(MOST_TOXIC).union(
        rows.where("toxic = 0").orderBy(*order).limit(MOST_CLEAN))
    # bounded by the two limits
    return docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("text", "toxic")


def _word_counts(sample: DataFrame) -> DataFrame:
    """(word, a, c): groups of near copies, toxic and clean, that have the word. A group is named
    by the least hash of its 3-word runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            texts, toxic = batch.column(0).to_pylist(), batch.column(1)
            for a, b in slices(offsets, 1 << 20):
                sh, d = shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                least = np.zeros(b - a, np.uint64)
                if len(sh):
                    first = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
                    least[d[first]] = sh[first]
                words = [sorted(set(words_of(t))) for t in texts[a:b]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(least.view(np.int64)), toxic.slice(a, b - a), pa.array(words, pa.list_(pa.string()))],
                    ["g", "toxic", "words"])

    rows = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        run, "g bigint, toxic int, words array<string>")
    once = rows.select("g", "toxic", F.explode("words").alias("word")).groupBy("word", "g").agg(F.max("toxic").alias("t"))
    return once.groupBy("word").agg(F.sum("t").alias("a"), F.sum(1 - F.col("t")).alias("c"))


def fit(docs: DataFrame, labels: DataFrame) -> Machine:
    """The machine for (doc_id, text) and (doc_id, toxic); what reaches the driver is bounded."""
    sample = materialize(_sampled(docs, labels), "toxicity-sample")
    totals = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    none = Machine(np.empty(0, np.uint64), np.empty(0), 0.0)
    none.slope, none.shift = 0.0, float(np.log(max(toxic, 1e-9) / max(clean, toxic * 2, 1)))
    if not toxic or not clean:
        return none
    counts = materialize(_word_counts(sample), "toxicity-words")
    a, c = F.col("a") / toxic, F.col("c") / clean
    pooled = (F.col("a") + F.col("c")) / (toxic + clean)

    def part(n: str, of: int):
        return F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / (of * pooled))).otherwise(0.0)

    tried = counts.where("a + c >= 3").count()
    strong = counts.where((a > 6 * c) & (2 * (part("a", toxic) + part("c", clean)) > 2 * np.log(max(tried, 2)) + 2))
    seeds = [r[0] for r in strong.orderBy(F.desc("a"), "word").limit(MOST_SEEDS).collect()]
    if not seeds:
        return none
    rest = counts.where((F.col("c") > 0) & (a <= 2 * c))
    others = [r[0] for r in rest.orderBy(F.desc("c"), "word").limit(MOST_OTHERS // 4).collect()]
    others += [r[0] for r in rest.orderBy(F.xxhash64("word"), "word").limit(MOST_OTHERS).collect()]
    machine = fit_words(seeds, list(dict.fromkeys(others)))
    for _ in range(2):
        near = largest_margins(rest.select(F.col("word").alias("text"), "word"), machine, "word string")
        others += [r[0] for r in near.orderBy(F.desc("margin"), "word").limit(HARD).select("word").collect()]
        machine = fit_words(seeds, list(dict.fromkeys(others)))
    rows = largest_margins(sample.select("text", F.col("toxic").cast("int").alias("toxic")), machine, "toxic int").select(
        F.coalesce("margin", F.lit(machine.offset)), "toxic").collect()
    _curve(machine, np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float))
    return machine


def _curve(machine: Machine, margin: np.ndarray, toxic: np.ndarray) -> None:
    """The logistic curve by Newton steps, a little ridge on the slope. Toxic rows, the fewer, count
    by the root of the ratio: between the curve of the sample and that of even classes."""
    x, w = np.stack([margin, np.ones(len(margin))], 1), np.array([1.0, 0.0])
    cost = np.where(toxic > 0, np.sqrt(max(1.0, (toxic == 0).sum() / max(1, (toxic > 0).sum()))), 1.0)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (cost * p * (1 - p))[:, None]).T @ x + np.diag([1e-2, 1e-6]),
                               x.T @ (cost * (toxic - p)) - np.array([1e-2, 1e-6]) * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    if w[0] > 0:
        machine.slope, machine.shift = float(w[0]), float(w[1])


def scored(docs: DataFrame, machine: Machine, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of each row."""
    kind = docs.schema[key].dataType.simpleString()
    rows = largest_margins(docs.select(F.col(text).cast("string").alias("text"), F.col(key).alias("key")), machine,
                           f"key {kind}")
    return rows.select(F.col("key").alias(key), _score(machine).alias("score"))


def _score(machine: Machine):
    margin = F.coalesce("margin", F.lit(machine.offset))
    return 1 / (1 + F.exp(-F.greatest(F.lit(-60.0), F.least(F.lit(60.0), machine.slope * margin + machine.shift))))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest of the contract."""
    df = scored(docs, fit(docs, labels))
    return df.select("doc_id", (crc_rest(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "score",
                     (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep(docs: DataFrame, labels: DataFrame, limit: float = 0.5, text: str = "text") -> DataFrame:
    """The rows that score below the limit, with the columns they came with."""
    machine, at = fit(docs, labels), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                words = [set(words_of(t)) for t in part.column(at).to_pylist()]
                if len(known) > REMEMBER:
                    known = {}
                new = list(set().union(*words).difference(known))
                known.update(zip(new, machine.margins(new).tolist()))
                most = np.array([max(map(known.__getitem__, w)) if w else machine.offset for w in words])
                yield part.filter(pa.array(machine.score(most) < limit))

    return docs.mapInArrow(run, docs.schema)
