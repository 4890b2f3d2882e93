"""Vocabularies of public tokenizers as tables. The driver reads a file once and broadcasts its
bytes (a few MB, whatever the input); a worker opens them once, so no path must exist on it."""

from __future__ import annotations

import json
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast
from pyspark.sql import SparkSession


def shared(spark: SparkSession, path: str) -> Broadcast:
    """The bytes of a vocabulary file for all tasks."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


class Table:
    """The bytes of each token and how many they are."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.names = pa.array([str(i) for i in range(len(tokens))], pa.large_string())

    def join(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids behind one another."""
        n = self.lengths[ids]
        return self.blob[np.repeat(self.starts[ids] - np.cumsum(n) + n, n) + np.arange(n.sum())]


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(x) for x in lists], np.int64)
    return np.fromiter(chain.from_iterable(lists), np.int32, int(n.sum())), n


class ByteLevel(Table):
    """Byte-level BPE whose ids follow the order of its merges, so that ids are ranks."""

    def __init__(self, blob: bytes, pattern: str):
        told = json.loads(blob)
        special = {t["content"] for t in told["added_tokens"]}
        vocabulary = {t: i for t, i in told["model"]["vocab"].items() if t not in special}
        merges = [m if isinstance(m, str) else " ".join(m) for m in told["model"]["merges"]]
        if [vocabulary[m.replace(" ", "", 1)] for m in merges] != list(range(256, 256 + len(merges))):
            raise ValueError("the ids of this vocabulary do not follow its merges")
        # bytes that print stand for themselves, the others for the characters from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in plain} | {
            chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
        ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items()}
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            tokens[i] = token
        super().__init__(tokens)
        self._own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind one another and how many each has; names of special tokens are plain text."""
        return _flat([self._own.encode_ordinary(t) for t in texts])


class Pieces(Table):
    """A sentencepiece model; it puts a space before a text."""

    def __init__(self, blob: bytes):
        import sentencepiece

        self._own = sentencepiece.SentencePieceProcessor(model_proto=blob)
        super().__init__([
            bytes([int(self._own.id_to_piece(i)[3:5], 16)]) if self._own.is_byte(i)
            else self._own.id_to_piece(i).replace("▁", " ").encode() for i in range(self._own.get_piece_size())])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat(self._own.encode(texts, num_threads=1) if texts else [])


@lru_cache(maxsize=2)
def byte_level(blob: bytes, pattern: str) -> ByteLevel:
    return ByteLevel(blob, pattern)


@lru_cache(maxsize=2)
def pieces(blob: bytes) -> Pieces:
    return Pieces(blob)
