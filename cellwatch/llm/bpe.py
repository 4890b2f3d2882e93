"""Byte-level BPE encoding and decoding with length-bucketed matrices.

A text is split by the vocabulary's pattern; each distinct piece of a batch becomes one row of
a padded matrix of ids among pieces of like length. In each round every row merges its leftmost
pair of least rank; the ranks come from a hashed table of all pairs whose bytes join to a
token; rows shift left over the gap, and rows without a pair that merges leave the matrix.

Defined results: null and empty texts have no ids; repeated rows repeat; any other column is
dropped; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix
from .vocab import shared

NONE = np.iinfo(np.int32).max
#: Cells of a matrix at most; more rows take another matrix.
CELLS = 1 << 20
#: Rows longer than this merge all pairs of the least rank in one round.
LONG = 256
#: Pieces a task remembers at most, then it starts afresh (a matter of memory, not of results).
REMEMBER = 400_000
#: Code points that the ``regex`` module's Unicode tables hold for letters and numbers and those of the
#: compared library, which are older, do not. Neither space, letter nor number, they split as symbols.
NEWER = """
0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D
107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1
1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 16FF4-16FF6
187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2
1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF
1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF
2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""
_RANGES = ["-".join(chr(int(c, 16)) for c in r.split("-")) for r in NEWER.split()]
_NEWER = re.compile(f"[{''.join(_RANGES)}]")
#: What may be newer: one look at a table for each character, where ``_NEWER`` tries range after range.
_MAYBE = re.compile(f"[{''.join(r for r in _RANGES if r[0] <= chr(0xFFFF))}{chr(0x10000)}-{chr(0x10FFFF)}]")
#: A symbol in both tables.
SYMBOL = "\ue000"


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """Cuts a text into the pattern's matches, newer letters and numbers read as symbols."""
    match = regex.compile(pattern)

    def pieces(text: str) -> list[str]:
        if text.isascii() or not _MAYBE.search(text):
            return match.findall(text)
        return [text[m.start():m.end()] for m in match.finditer(_NEWER.sub(SYMBOL, text))]

    return pieces


class Ranks:
    """A vocabulary: bytes of each id, and the hashed table (left id, right id) -> joined id."""

    def __init__(self, file: bytes):
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in file.splitlines() if x.strip())}
        self.size = max(ranks.values()) + 1
        tokens = [b""] * self.size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
                 if t[:i] in ranks and t[i:] in ranks]
        left, right, joined = (np.array(x, np.uint64) for x in zip(*pairs)) if pairs else [np.empty(0, np.uint64)] * 3
        self._hash(left * np.uint64(self.size) + right, joined.astype(np.int32))

    def _hash(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Open addressing; every round the keys that found a free slot settle."""
        bits = max(4, int(len(keys) * 3).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.full(1 << bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << bits, NONE, np.int32)
        slot, left = mix(keys) & self.mask, np.arange(len(keys))
        self.probes = 1
        while len(left):
            free = left[self.keys[slot[left]] == np.uint64(2**64 - 1)]
            _, one = np.unique(slot[free], return_index=True)
            put = free[one]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            left = left[self.keys[slot[left]] != keys[left]]
            if len(left):
                slot[left] = (slot[left] + np.uint64(1)) & self.mask
                self.probes += 1

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The id of each pair joined, NONE where the bytes are no token or a side is padding."""
        keys = a.astype(np.uint64) * np.uint64(self.size) + b.astype(np.uint64)
        slot = mix(keys) & self.mask
        out = np.full(keys.shape, NONE, np.int32)
        found = self.keys[slot] == keys
        out[found] = self.values[slot[found]]
        open_ = ~found & (self.keys[slot] != np.uint64(2**64 - 1))
        at = np.nonzero(open_)
        rest, slot = keys[at], slot[at]
        for _ in range(self.probes):
            if not len(rest):
                break
            slot = (slot + np.uint64(1)) & self.mask
            held = self.keys[slot]
            hit = held == rest
            out[tuple(x[hit] for x in at)] = self.values[slot[hit]]
            go = ~hit & (held != np.uint64(2**64 - 1))
            at, rest, slot = tuple(x[go] for x in at), rest[go], slot[go]
        out[(a < 0) | (b < 0)] = NONE
        return out

    def _merge_rows(self, ids: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        done: list = [None] * len(ids)
        rows, ranks = np.arange(len(ids)), self.join(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            best = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), NONE)
            stop = best == NONE
            for i in np.flatnonzero(stop):
                done[rows[i]] = ids[i, :lengths[i]]
            if stop.any():
                go = ~stop
                rows, ids, ranks, lengths, at, best = rows[go], ids[go], ranks[go], lengths[go], at[go], best[go]
            if not len(rows):
                break
            k, width = np.arange(len(rows)), ids.shape[1]
            cols = np.arange(width - 1)[None, :]
            ids[k, at] = best
            ids = np.take_along_axis(ids, cols + (cols > at[:, None]), 1)
            gone = cols[:, :-1] + (cols[:, :-1] >= at[:, None])
            ranks = np.take_along_axis(ranks, gone, 1) if width > 2 else np.empty((len(rows), 0), np.int32)
            lengths = lengths - 1
            for side in (at - 1, at):
                ok = np.flatnonzero((side >= 0) & (side < width - 2))
                ranks[ok, side[ok]] = self.join(ids[ok, side[ok]], ids[ok, side[ok] + 1])
            widest = int(lengths.max())
            ids, ranks = ids[:, :widest], ranks[:, :max(widest - 1, 0)]
        return done

    def _merge_long(self, ids: np.ndarray) -> np.ndarray:
        """One long row. All pairs of the least rank merge together, from the left and without
        overlap, unless a new pair would have come before the rest; then only the first does."""
        while len(ids) > 1:
            ranks = self.join(ids[:-1], ids[1:])
            best = ranks.min()
            if best == NONE:
                break
            at = np.flatnonzero(ranks == best)
            if len(at) > 1:
                run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
                at = at[(np.arange(len(at)) - np.repeat(run, np.diff(run, append=len(at)))) % 2 == 0]
            out = self._fuse(ids, at, best)
            if len(at) > 1:
                new = self.join(out[:-1], out[1:])
                if (new[(out[:-1] == best) | (out[1:] == best)] <= best).any():
                    out = self._fuse(ids, at[:1], best)
            ids = out
        return ids

    @staticmethod
    def _fuse(ids: np.ndarray, at: np.ndarray, joined: int) -> np.ndarray:
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        out = ids.copy()
        out[at] = joined
        return out[keep]

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece. Pieces of up to 16 bytes share a matrix with their own length,
        longer ones with lengths up to the next power of two."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        out: list = [np.empty(0, np.int32)] * len(pieces)
        width = np.where(lengths <= 16, lengths, 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
        for w in np.unique(width[lengths > 0]):
            rows = np.flatnonzero(width == w)
            if w > LONG:
                for i in rows:
                    out[i] = self._merge_long(self.byte_id[np.frombuffer(pieces[i], np.uint8)])
                continue
            for part in np.array_split(rows, -(-len(rows) * int(w) // CELLS)):
                flat = np.frombuffer(b"".join(pieces[i] for i in part), np.uint8)
                ids = np.full((len(part), w), -1, np.int32)
                ids[np.arange(w)[None, :] < lengths[part][:, None]] = self.byte_id[flat]
                for i, got in zip(part, self._merge_rows(ids, lengths[part])):
                    out[i] = got
        return out

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids behind one another."""
        n = self.lengths[ids]
        return self.blob[np.repeat(self.starts[ids] - np.cumsum(n) + n, n) + np.arange(n.sum())]


@lru_cache(maxsize=2)
def _opened(file: bytes) -> Ranks:
    return Ranks(file)


def ranks_of(path: str) -> Ranks:
    with open(path, "rb") as file:
        return _opened(file.read())


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>) of each row; special tokens' names are ordinary text."""
    kind, file = docs.schema[key].dataType.simpleString(), shared(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, split, known = _opened(file.value), splitter(pattern), {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                pieces = [split(t) if t else [] for t in part.column(1).to_pylist()]
                if len(known) > REMEMBER:
                    known = {}
                new = list(set(chain.from_iterable(pieces)).difference(known))
                known.update(zip(new, (x.tolist() for x in ranks.encode_pieces([p.encode() for p in new]))))
                got = [np.fromiter(chain.from_iterable(map(known.__getitem__, p)), np.int32) for p in pieces]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int32)
                values = np.concatenate(got) if got else np.empty(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["key", "ids"])

    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, ids, decoded binary) of each row of ids."""
    kind, file = encoded.schema[key].dataType.simpleString(), shared(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _opened(file.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                column = part.column(1)
                flat = column.flatten().to_numpy(zero_copy_only=False)
                n = np.nan_to_num(np.array([len(x) if x is not None else 0 for x in column], np.int64))
                ends = np.cumsum(n)
                texts = [ranks.decode(flat[e - k:e]).tobytes() for e, k in zip(ends, n)]
                yield pa.RecordBatch.from_arrays([part.column(0), column, pa.array(texts, pa.binary())],
                                                 ["key", "ids", "decoded"])

    return encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(
        run, f"key {kind}, ids array<int>, decoded binary").withColumnRenamed("key", key)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes, then decodes what came out."""
    back = decode(encode(docs, path, pattern), path)
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
