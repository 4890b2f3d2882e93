"""Periodic runs against a plain search, grammar extensions against a word-by-word comparison."""

import hashlib
import zlib

import numpy as np

from cellwatch.llm import periods
from cellwatch.llm.queries import QUERIES

from .conftest import doc, write_tables
from .test_operators import spaced


def plain_runs(w):
    """(start, length, period) of all runs, by looking at every period."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def repetitive(rng):
    parts = []
    for _ in range(int(rng.integers(0, 6))):
        unit = rng.integers(0, int(rng.integers(1, 5)), int(rng.integers(1, 12))).tolist()
        parts += unit * int(rng.integers(1, 9)) + unit[:int(rng.integers(0, len(unit) + 1))]
    return parts


def test_runs_against_plain_search():
    rng, seen = np.random.default_rng(0), 0
    for _ in range(200):
        texts = [repetitive(rng) for _ in range(int(rng.integers(1, 6)))]
        of, *values = periods.runs(np.array(sum(texts, []), np.int64), np.array([len(t) for t in texts], np.int64))
        got = list(zip(of.tolist(), *(v.tolist() for v in values)))
        assert got == [(i, *r) for i, t in enumerate(texts) for r in plain_runs(t)]
        seen += len(got)
    assert seen > 500


def test_small_candidate_parts(monkeypatch):
    monkeypatch.setattr(periods, "CANDIDATES", 3)
    words = [0, 1, 2] * 9 + [5] * 7 + [0, 1] * 4
    of, *values = periods.runs(np.array(words), np.array([len(words)]))
    assert list(zip(*(v.tolist() for v in values))) == plain_runs(words)


def test_extensions_against_comparison():
    rng = np.random.default_rng(1)
    for alphabet in (1, 2, 3, 40):
        texts = [rng.integers(0, alphabet, int(rng.integers(1, 200))) for _ in range(5)] + [np.tile(rng.integers(0, alphabet, 7), 60)]
        symbols, ends = [], []
        for i, t in enumerate(texts):
            symbols += [*t.tolist(), 1000 + i]
            ends.append(len(symbols) - 1)
        levels = periods.grammar(np.array(symbols), np.array(ends))
        assert sum(len(x.symbols) for x in levels) < 12 * len(symbols)
        start = np.concatenate([[0], np.array(ends[:-1]) + 1])
        pairs = [(int(rng.integers(a, b)), int(rng.integers(a, b))) for a, b in zip(start, ends) if b - a > 1 for _ in range(200)]
        pairs = np.array([p for p in pairs if p[0] != p[1]])
        for back in (False, True):
            got = periods.extents(levels, pairs[:, 0], pairs[:, 1], back)
            for (x, y), n in zip(pairs.tolist(), got.tolist()):
                k, step = 0, -1 if back else 1
                while min(x, y) + k * step >= 0 and symbols[x + k * step] == symbols[y + k * step]:
                    k += 1
                assert n == k


def expected(i, text):
    words, h = spaced(text), zlib.crc32(b"" if i is None else str(i).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
    found = plain_runs(words)
    dropped = {k for s, n, q in found for k in range(s + q, s + n)}
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (i, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in dropped).encode()).hexdigest())


def test_query_on_odd_texts(spark, tmp_path):
    rng = np.random.default_rng(3)
    docs = [doc(i, " ".join(f"w{k}" for k in repetitive(rng) + rng.integers(0, 50, 20).tolist())) for i in range(150)]
    docs += [doc(None, "a " * 9), doc(900, None), doc(901, ""), doc(902, " \n "), doc(903, "a b\x0bc d é"), doc(904, "x y " * 3000)]
    docs += [doc(905, "same same same same same same other other other other other other"), doc(900, "a a a a a a")]
    path = write_tables(spark, tmp_path, docs)
    got = [tuple(r) for r in QUERIES["op13_recompression_runs"](spark, path).collect()]
    assert sorted(got, key=repr) == sorted((expected(*d[:2]) for d in docs), key=repr)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(150)) > 5
