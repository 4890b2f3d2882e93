"""Packing against the tokenizers library and the contract's law of pieces; least squares against its conditions."""

import json
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cellwatch.llm import packing, vocab
from cellwatch.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def lawful(pieces, tokens, window):
    """Pieces cover each document once, sequences have no gap, and only powers of two are shorter than a window."""
    of, at = defaultdict(list), defaultdict(list)
    for row, start, length, sequence, offset in zip(*(pieces[c].tolist() for c in packing.COLUMNS)):
        assert length > 0
        of[row].append((start, length))
        at[sequence].append((offset, length))
    for groups, ends in ((of, dict(enumerate(tokens))), (at, None)):
        for name, spans in groups.items():
            edge = 0
            for start, length in sorted(spans):
                assert start == edge
                edge += length
            assert edge == ends[name] if ends else edge == window or edge < window and edge & (edge - 1) == 0
    assert len(of) == len(tokens)


@pytest.mark.parametrize("seed", range(8))
def test_pieces_and_sequences(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 400))
    for tokens in (rng.integers(1, 6000, n), np.full(n, int(rng.integers(1, 2100))), np.maximum(1, rng.lognormal(3, 2, n)).astype(int)):
        lawful(packing.pack_share(tokens.astype(np.int64)), tokens, packing.WINDOW)
    tokens = rng.integers(1, 90, n)
    lawful(packing.pack_share(tokens, 64, 4, 3), tokens, 64)


def test_combinations_fill_a_window():
    for units, depth in ((1, 1), (8, 3), (12, 5)):
        found = packing.combinations(units, depth)
        want = set()

        def extend(parts):
            if sum(parts) == units:
                want.add(tuple(sorted(parts)))
            elif sum(parts) < units and len(parts) < depth:
                for p in range(1, units + 1):
                    extend([*parts, p])

        extend([])
        got = [tuple(np.repeat(np.arange(1, units + 1), c.astype(int))) for c in found.T]
        assert len(got) == len(set(got)) and set(got) == want


def test_least_squares_meet_their_conditions():
    rng = np.random.default_rng(2)
    for a, b in [(rng.normal(size=(8, 20)), rng.normal(size=8)) for _ in range(20)] + [
            (packing.combinations(16, 4), rng.integers(0, 500, 16).astype(float)) for _ in range(20)] + [
            (packing.combinations(64, 5), np.zeros(64))]:
        x = packing.nnls(a, b)
        slope, scale = a.T @ (b - a @ x), 1e-6 * max(1, np.abs(a.T @ b).max())
        assert (x >= 0).all() and (slope <= scale).all() and np.abs(slope[x > 0]).max(initial=0) <= scale


def test_rounded_repeats_use_no_more_than_there_is():
    histogram = np.random.default_rng(3).integers(0, 900, 64)
    used = sum(parts * times for parts, times in packing.repeats(histogram))
    assert (used <= histogram).all()
    # most of what shallow combinations can hold is packed by them, not left over
    assert (used * np.arange(1, 65)).sum() > 0.6 * (histogram * np.arange(1, 65)).sum()


def test_against_the_tokenizers_library(spark, odd_dir):
    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = True
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{odd_dir}/documents.parquet").collect()]
    rows = QUERIES["op11_nnls_packing"](spark, odd_dir).collect()
    want = defaultdict(list)
    for i, t in docs:
        want[i].append([*own.encode(t, add_special_tokens=False).ids, 1])
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append(r)
    assert set(got) == set(want)
    for i, some in got.items():
        assert sum(r.length for r in some) == sum(map(len, want[i]))
        assert {r.doc_tokens for r in some} == {len(w) for w in want[i]}
        for r in some:
            assert r.ids_crc32 in {zlib.crc32(np.array(w[r.start:r.start + r.length], "<u4").tobytes()) for w in want[i]}
    at = defaultdict(list)
    for r in rows:
        at[r.sequence_id].append((r.offset, r.length))
    for spans in at.values():
        edge = 0
        for offset, length in sorted(spans):
            assert offset == edge
            edge += length
        assert edge == 2048 or edge < 2048 and edge & (edge - 1) == 0


def test_special_names_are_plain_text_and_merges_must_follow_ids():
    with open(PATH, "rb") as file:
        blob = file.read()
    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = True
    table = vocab.byte_level(blob, public_tokenizers.PATTERN)
    texts = ["<|endoftext|> a", "", "  \n\n x\u0085y ᜀ 漢字 😀", "a" * 5000]
    ids, n = table.encode(texts)
    assert ids.tolist() == [i for t in texts for i in own.encode(t, add_special_tokens=False).ids] and len(n) == 4
    assert table.join(ids).tobytes() == "".join(texts).encode()
    told = json.loads(blob)
    told["model"]["merges"] = told["model"]["merges"][::-1]
    with pytest.raises(ValueError):
        vocab.ByteLevel(json.dumps(told).encode(), public_tokenizers.PATTERN)
