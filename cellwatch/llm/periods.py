"""Periodic runs of words by recompression.

The words of some texts are one sequence of numbers, with an end of its own after each text. A grammar
is built over it in levels, which alternate:

* block compression: a stretch of one symbol becomes one symbol, named by the symbol and its count;
* pair compression: symbols are dealt to a left and a right side by a hash; a left symbol that a
  right one follows is joined with it, named by the two.

Both depend on nearby symbols only, so equal stretches become equal symbols but for their edges, and a
level has about three quarters of the symbols of the one below. How far two places agree, forward or
back (LCE), is asked of the grammar: the places climb while they agree, by a step per level, skip equal
symbols whole, and go down again to the word where they part. Names are exact, so are the answers.

A run of period q and length of at least max(6, 4 q) agrees with itself q words on over at least max(6, 4 q) - q
words, so one of every so many places, a harmonic grid, lies inside. For each q such places are the candidates;
those whose word stands q words on are extended exactly both ways. Of the periods found for one stretch the
smallest is its smallest period: a shorter one would divide it and be found too.

Defined results: null and empty texts have no words; rows without an id are taken by the checksum of an
empty id; each row is a text of its own; a very long text is worked on alone; of runs with equal exponents the
first, then that of the smallest period, is named; other columns are dropped; an empty table gives an
empty one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, mix, slices, utf8

#: Bytes of text that share a grammar, and candidates that are looked at together.
SLICE, CANDIDATES = 1 << 20, 1 << 20
LEAST, TIMES = 6, 4
_SEP = np.zeros(256, bool)
_SEP[WHITE] = True


@dataclass
class Level:
    """Symbols of a level, the symbol above each, and the first symbol below each (none at level 0)."""

    symbols: np.ndarray
    parent: np.ndarray
    first: np.ndarray
    blocks: bool  # whether the level above joins blocks, not pairs


def _joined(symbols: np.ndarray, opens: np.ndarray, fresh: int, second: np.ndarray) -> tuple[Level, np.ndarray, int]:
    """The next level: groups of symbols begin where ``opens``; groups of several are named by their
    first symbol and ``second``. Returns the new symbols, their first children and parents."""
    parent = np.cumsum(opens) - 1
    first = np.flatnonzero(opens)
    size = np.diff(np.concatenate([first, [len(symbols)]]))
    new, many = symbols[first].copy(), np.flatnonzero(size > 1)
    left, right = symbols[first[many]], second[many]
    _, name = np.unique((left << 32) | right, return_inverse=True)
    new[many] = fresh + name
    return new, first, parent, fresh + (int(name.max()) + 1 if len(name) else 0)


def grammar(symbols: np.ndarray, ends: np.ndarray) -> list[Level]:
    """Levels over ``symbols`` (numbers from 0, below 2**31). Symbols at ``ends`` are never joined."""
    levels, first, fresh, turn = [], np.empty(0, np.int64), int(symbols.max(initial=-1)) + 1, 0
    symbols = symbols.astype(np.int64)
    fixed = np.zeros(len(symbols), bool)
    fixed[ends] = True
    while True:
        n = len(symbols)
        blocks = turn % 2 == 0
        opens = np.ones(n, bool)
        if blocks:
            opens[1:] = symbols[1:] != symbols[:-1]  # ends differ from all others
        else:
            side = (mix(symbols.astype(np.uint64), turn) >> np.uint64(40)) & np.uint64(1)
            opens[1:] = ~((side[:-1] == 0) & (side[1:] == 1) & ~fixed[1:] & ~fixed[:-1])
        at = np.flatnonzero(opens)
        many = np.diff(np.concatenate([at, [n]])) > 1
        second = np.diff(np.concatenate([at, [n]]))[many] if blocks else symbols[at[many] + 1]
        full = np.zeros(len(at), np.int64)
        full[many] = second
        new, below, parent, fresh = _joined(symbols, opens, fresh, full)
        levels.append(Level(symbols, parent, first, blocks))
        symbols, first, fixed, turn = new, below, fixed[at], turn + 1
        # what is left is an end and a symbol or two for each text, or pairs that no longer meet
        if len(symbols) <= 2 * len(ends) or turn % 2 == 0 and turn > 12 and len(symbols) > 0.99 * len(levels[-2].symbols):
            levels.append(Level(symbols, np.empty(0, np.int64), first, True))
            return levels


def _same(symbols: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether both places are inside the level and hold one symbol."""
    size = len(symbols)
    ok = (a >= 0) & (b >= 0) & (a < size) & (b < size)
    return ok & (symbols[np.clip(a, 0, size - 1)] == symbols[np.clip(b, 0, size - 1)])


def extents(levels: list[Level], x: np.ndarray, y: np.ndarray, back: bool = False) -> np.ndarray:
    """How many symbols from places ``x`` and from ``y`` (other places of the same texts) on agree: forward from
    and with them, or backward. A place may lie one step outside the sequence; there it agrees with nothing."""
    n, step = len(levels[0].symbols), -1 if back else 1
    x, y, start = x.astype(np.int64).copy(), y.astype(np.int64).copy(), x.astype(np.int64)
    inside = (x >= 0) & (y >= 0) & (x < n) & (y < n)
    # queries by the level at which they parted; the others climb on
    parted: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    live = np.flatnonzero(inside)
    a, b = x[live], y[live]
    top = len(levels) - 1
    for height, level in enumerate(levels):
        s, size = level.symbols, len(level.symbols)
        if height == top:
            same = _same(s, a, b)
            while same.any():
                a, b = a + step * same, b + step * same
                same[same] = _same(s, a[same], b[same])
            parted.append((live, a, b))
            break
        above = levels[height + 1]
        last = np.concatenate([above.first[1:], [size]]) - 1

        def left_in_group(place):
            group = level.parent[place]
            return (place - above.first[group] if back else last[group] - place) + 1

        def inner(place):
            """Whether the place is not the one by which its group is entered."""
            group = level.parent[place]
            return place != (last[group] if back else above.first[group])

        # before climbing, both must stand where a group is entered
        need = inner(a) | inner(b)
        move = need & (s[a] == s[b])
        stop = need & ~move
        if level.blocks:
            # of unequal remainders of a block the shorter one is followed by another symbol
            run_a, run_b = left_in_group(a), left_in_group(b)
            stop |= need & (run_a != run_b)
            move = move * np.minimum(run_a, run_b)
        to_a, to_b = a + step * move, b + step * move
        ok = (to_a >= 0) & (to_b >= 0) & (to_a < size) & (to_b < size)
        stop |= ~ok
        parted.append((live[stop], to_a[stop], to_b[stop]))
        live, a, b = live[~stop], level.parent[to_a[~stop]], level.parent[to_b[~stop]]
    # down again: at each level the places that parted above are the first of their group
    live = a = b = np.empty(0, np.int64)
    for height in range(top, -1, -1):
        level = levels[height]
        s, size = level.symbols, len(level.symbols)
        ids, at_a, at_b = parted[height]
        live, a, b = (np.concatenate(z) for z in ((live, ids), (a, at_a), (b, at_b)))
        if height < top and len(live):
            above = levels[height + 1]
            last = np.concatenate([above.first[1:], [size]]) - 1
            same = _same(s, a, b)
            same[len(live) - len(ids):] = False  # these parted here
            if level.blocks:
                at = np.flatnonzero(same)
                ga, gb = level.parent[a[at]], level.parent[b[at]]
                run = np.minimum(*((p - above.first[g] if back else last[g] - p) + 1 for p, g in ((a[at], ga), (b[at], gb))))
                a[at], b[at] = a[at] + step * run, b[at] + step * run
            else:
                a, b = a + step * same, b + step * same
        if height:
            # enter the groups from the side the comparison comes from
            ends = np.concatenate([level.first[1:], [len(levels[height - 1].symbols)]]) - 1
            entry = ends if back else level.first
            a, b = (np.where((p >= 0) & (p < size), entry[np.clip(p, 0, max(size - 1, 0))],
                             np.where(p < 0, -1, len(levels[height - 1].symbols))) for p in (a, b))
    out = np.zeros(len(x), np.int64)
    out[live] = np.abs(a - start[live])
    return out


def _candidates(n: np.ndarray, starts: np.ndarray, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period): the places of each period's grid whose word stands a period later again."""
    text = np.repeat(np.arange(len(n)), n // TIMES)
    at = np.cumsum(n // TIMES) - n // TIMES
    period = np.arange(len(text)) - at[text] + 1
    step = np.maximum(LEAST, TIMES * period) - period
    fits = n[text] >= np.maximum(LEAST, TIMES * period)
    text, period, step = text[fits], period[fits], step[fits]
    count = -(-(n[text] - period) // step)
    before = np.concatenate([[0], np.cumsum(count)])
    cut = 0
    while cut < len(text):
        to = max(cut + 1, int(np.searchsorted(before, before[cut] + CANDIDATES, "right")) - 1)
        c = count[cut:to]
        of = np.repeat(np.arange(cut, to), c)
        place = starts[text[of]] + (np.arange(len(of)) - np.repeat(np.cumsum(c) - c, c)) * step[of]
        q = period[of]
        met = words[place] == words[place + q]
        yield place[met], q[met]
        cut = to


def runs(words: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs of texts of ``n`` words each, by text, start and period;
    ``words`` are numbers from 0, those of all texts behind one another."""
    texts = len(n)
    ends = np.cumsum(n + 1) - 1
    spread = np.zeros(len(words) + texts, np.int64)
    inside = np.ones(len(spread), bool)
    inside[ends] = False
    spread[inside] = words
    spread[ends] = int(words.max(initial=-1)) + 1 + np.arange(texts)
    starts = ends - n
    found = [np.empty((0, 3), np.int64)]
    levels = None
    for place, q in _candidates(n, starts, spread):
        if not len(place):
            continue
        levels = levels or grammar(spread, ends)
        ahead, behind = extents(levels, place, place + q), extents(levels, place - 1, place - 1 + q, back=True)
        length = behind + ahead + q
        long_ = length >= np.maximum(LEAST, TIMES * q)
        found.append(np.stack([(place - behind)[long_], length[long_], q[long_]], 1))
    every = np.unique(np.concatenate(found), axis=0)  # by start, length, period
    new = np.ones(len(every), bool)
    new[1:] = (every[1:, :2] != every[:-1, :2]).any(1)
    start, length, period = every[new].T
    text = np.searchsorted(ends, start)
    order = np.lexsort((period, start))
    return text[order], (start - starts[text])[order], length[order], period[order]


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of texts, behind one another, and how many each has."""
    inside = ~_SEP[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    opens = inside & np.concatenate([[True], ~inside[:-1]])[:len(data)] | inside & first[:len(data)]
    starts = np.flatnonzero(opens)
    # bytes of words before each word's first, and of all
    before = np.concatenate([np.cumsum(inside)[starts] - 1, [int(inside.sum())]])
    flat = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(before.astype(np.int64)),
                                                                  pa.py_buffer(np.ascontiguousarray(data[inside]))])
    return flat, np.diff(np.searchsorted(starts, offsets))


def planted(keys: list, n: np.ndarray) -> np.ndarray:
    """For each word of texts of ``n`` words, the place of the word that stands there: some texts, chosen by
    the checksum of their key, repeat a part of theirs to the end."""
    starts = np.cumsum(n) - n
    at = np.arange(int(n.sum()))
    for i, key in enumerate(keys):
        h = zlib.crc32(b"" if key is None else str(key).encode())
        if h % 10 == 0 and n[i]:
            g, words = h // 10, int(n[i])
            a = g % words
            p = 1 + (words - a) // (3 + g % 8)
            k = np.arange(a, words)
            at[starts[i] + k] = starts[i] + a + (k - a) % p
    return at


def periodic(docs: DataFrame, plant: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, runs array<struct<start, length, period>> by start and period, collapsed) of each text: its runs, and its
    words but those that a run repeats, joined by a space. ``plant`` changes texts first as ``planted`` tells."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for at, to in slices(offsets, SLICE):
                keys = batch.column(0).slice(at, to - at)
                flat, n = _words(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])
                if plant:
                    flat = flat.take(pa.array(planted(keys.to_pylist(), n)))
                coded = flat.dictionary_encode()
                of, start, length, period = runs(np.asarray(coded.indices, np.int64), n)
                # a run drops what follows its first period
                base = (np.cumsum(n) - n)[of]
                marks = np.zeros(len(flat) + 1, np.int64)
                np.add.at(marks, base + start + period, 1)
                np.add.at(marks, base + start + length, -1)
                kept = np.cumsum(marks[:-1]) == 0
                edges = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], np.cumsum(n)])]
                rest = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(edges, pa.int64()), flat.filter(pa.array(kept))),
                                      pa.scalar(" ", pa.large_string()))
                rows = pa.StructArray.from_arrays([pa.array(v) for v in (start, length, period)], ["start", "length", "period"])
                cuts = np.searchsorted(of, np.arange(to - at + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([keys, pa.array(n), pa.ListArray.from_arrays(pa.array(cuts), rows),
                                                  rest.cast(pa.string())], ["key", "n_words", "runs", "collapsed"])

    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"key {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    ).withColumnRenamed("key", key)


def digests(docs: DataFrame) -> DataFrame:
    """The digest of the contract."""
    best = F.reduce("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return periodic(docs, plant=True).withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
