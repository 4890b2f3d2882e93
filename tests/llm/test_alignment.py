"""Alignment of two tokenizers against a walk over both token lists."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cellwatch.llm import alignment
from cellwatch.llm.queries import QUERIES

from .conftest import doc, write_tables

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
PRINT = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE = {chr(b): b for b in PRINT} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in PRINT)}


def a_bytes(i):
    return bytes(BYTE[c] for c in A.id_to_token(i))


def b_bytes(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def walked(text):
    """(n_a, n_b, groups, links) by two pointers; None where a tokenizer does not give the text back."""
    a, b = A.encode(f" {text}", add_special_tokens=False).ids if text else [], B.encode(text or "")
    if not text or any(b"".join(map(f, x)) != f" {text}".encode() for f, x in ((a_bytes, a), (b_bytes, b))):
        return None
    ends = [np.cumsum([len(f(i)) for i in x]).tolist() for f, x in ((a_bytes, a), (b_bytes, b))]
    x = y = 0
    links, groups, one, two = [], [], [], []
    while x < len(a):
        one += [x] if x not in one[-1:] else []
        two += [y] if y not in two[-1:] else []
        links.append((a[x], b[y]))
        p, q = ends[0][x], ends[1][y]
        if p == q:
            groups.append(",".join(str(a[i]) for i in one) + "|" + ",".join(str(b[i]) for i in two))
            one, two = [], []
        x, y = x + (p <= q), y + (q <= p)
    return len(a), len(b), groups, links


def expected(docs):
    seen = [(i, walked(t)) for i, t in docs]
    counts, best = Counter(p for _, w in seen if w for p in set(w[3])), Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [(i, 0, 0, 0, 0, 0, 0, "") if w is None else
            (i, w[0], w[1], len(w[2]), len(w[3]), sum(counts[p] == best[p[0]] for p in w[3]), sum(counts[p] for p in w[3]),
             hashlib.sha256(";".join(w[2]).encode()).hexdigest()) for i, w in seen]


def rows(spark, path):
    return sorted(map(tuple, QUERIES["op12_tokenizer_alignment"](spark, path).collect()), key=repr)


def test_odd_texts(spark, odd_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{odd_dir}/documents.parquet").collect()]
    assert rows(spark, odd_dir) == sorted(expected(docs), key=repr)


@pytest.mark.parametrize("block", [1, 8 << 20])
def test_counts_over_blocks(spark, tmp_path, monkeypatch, block):
    """Counts do not depend on how texts fall into blocks; names of special tokens are plain text."""
    monkeypatch.setattr(alignment, "BLOCK", block)
    monkeypatch.setattr(alignment, "SLICE", 1)
    rng = np.random.default_rng(4)
    words = ["the", "tokenizer", "Donaudampfschiff", "été", "漢字", "😀", "x1234", "<s>", "</s>", "<|endoftext|>", "<unk>", "\t", " ", "á"]
    docs = [doc(i, " ".join(rng.choice(words, int(rng.integers(1, 12))))) for i in range(60)]
    docs += [doc(100, "  two  spaces "), doc(101, "the the the"), doc(102, "the the the"), doc(103, "▁under"), doc(104, "\n")]
    path = write_tables(spark, tmp_path, docs)
    assert rows(spark, path) == sorted(expected([d[:2] for d in docs]), key=repr)
