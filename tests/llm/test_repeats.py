"""Suffix and substring dedup against brute force."""
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest_llm import ODD_TEXTS, WORDS, prose
from pricewise.llm import cover
from pricewise.llm import fingerprints as f
from pricewise.llm.substring_dedup import repeated_windows
from pricewise.llm.suffix_dedup import repeated_spans


def corpus(seed=3):
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(150)) for _ in range(30)]
    passages = [prose(rng, rng.randrange(12, 60)) for _ in range(6)] + ["x" * 199, "yz" * 100, "w" * 201]
    texts = list(ODD_TEXTS) + base + base[:6] + [base[0]] * 8 + [base[7] + base[8]] * 3 + [base[7]]
    for _ in range(40):
        parts = [prose(rng, rng.randrange(30)), rng.choice(passages), prose(rng, rng.randrange(30))]
        texts.append(rng.choice([" ", "\n", ""]).join(parts))
    for _ in range(10):  # near copies
        w = rng.choice(base).split(" ")
        for _ in range(3):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        texts.append(" ".join(w))
    texts.append("aé" * 160 + prose(rng, 4))
    rng.shuffle(texts)
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    return rows + [rows[5], (rows[9][0], "same id, " + passages[2]), (None, passages[1]), (None, passages[1]),
                   (-4, passages[3] + " " + base[2])]


def brute_bytes(rows):
    data = [(t or "").encode() for _, t in rows]
    n = Counter(d[i:i + 200] for d in data for i in range(len(d) - 199))
    out = []
    for (doc_id, _), d in zip(rows, data):
        gone = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - 199):
            if n[d[i:i + 200]] > 1:
                gone[i:i + 200] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def brute_words(rows):
    order = lambda i: (i is None, i or 0)
    low = defaultdict(list)
    words = [(t or "").encode().split() for _, t in rows]
    for (doc_id, _), w in zip(rows, words):
        for i in range(len(w) - 12):
            low[tuple(w[i:i + 13])].append(order(doc_id))
    low = {k: min(v) for k, v in low.items()}
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - 12):
            if low[tuple(w[i:i + 13])] < order(doc_id):
                gone[i:i + 13] = [True] * 13
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("block_bytes", [1 << 22, 900])
def test_suffix_dedup(docs_of, monkeypatch, block_bytes):
    monkeypatch.setattr(f, "BLOCK_BYTES", block_bytes)
    rows = corpus()
    got = repeated_spans(docs_of(rows).selectExpr("*", "1 as n_bytes", "'x' as payload")).collect()
    want = brute_bytes(rows)
    assert Counter(tuple(r) for r in got) == want
    assert sum(r[2] > 0 for r in want) > 20


@pytest.mark.parametrize("block_bytes", [1 << 22, 900])
def test_substring_dedup(docs_of, monkeypatch, block_bytes):
    monkeypatch.setattr(f, "BLOCK_BYTES", block_bytes)
    rows = corpus(4)
    got = repeated_windows(docs_of(rows).selectExpr("*", "1 as n_words", "2 as block_id")).collect()
    want = brute_words(rows)
    assert Counter(tuple(r) for r in got) == want
    assert sum(r[2] > 0 for r in want) > 20


def test_empty_tables(docs_of):
    assert repeated_spans(docs_of([])).count() == 0
    assert repeated_windows(docs_of([])).count() == 0
    assert [tuple(r)[1:4] for r in repeated_spans(docs_of([(1, None)])).collect()] == [(0, 0, 0)]


def test_covers():
    assert all(cover.is_cover(v, d) for v, d in cover.PERFECT.items())
    at = cover.cover_positions(7, np.array([0, 20]), np.array([20, 12]), 7, 13)
    assert at.tolist() == [0, 1, 3, 7, 8, 10]


def test_packing():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert (f.unpack_sorted(f.pack_sorted(a))[0] == a).all()
        b = rng.integers(0, 5, n).astype(np.uint64)
        assert (f.unpack_array(b"zz" + f.pack_array(b), 2)[0] == b).all()
        assert (f.unpack_flags(f.pack_flags(b > 2)) == (b > 2)).all()
