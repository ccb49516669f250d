import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest_llm import ODD_TEXTS, prose

from pricewise.llm import periodic_runs as module
from pricewise.llm.periodic_runs import find_runs, op12_periodic_runs, periodic_runs

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """Every stretch of every lag, smallest period of equal stretches."""
    n, best = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and j > i:
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute(doc_id, text):
    words = SPLIT.findall(text or "")
    if doc_id is not None:
        words = planted(words, doc_id)
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def periodic(rng, letters=3, blocks=6):
    out = []
    for _ in range(blocks):
        unit = [rng.randrange(letters) for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 13, 16, 17, 30, 33, 64, 65]))]
        out += unit * rng.choice([1, 2, 4, 5]) + unit[:rng.randrange(len(unit) + 1)]
    return out


@pytest.mark.parametrize("letters", [1, 2, 3, 50])
def test_runs_match_brute_force(letters):
    rng = random.Random(letters)
    docs = [periodic(rng, letters) for _ in range(60)] + [[], [1], [0] * 700, [0, 1] * 300]
    values = np.array([w for d in docs for w in d], dtype=np.uint64)
    size = np.array([len(d) for d in docs])
    start, length, period = find_runs(values, size)
    first = np.cumsum(size) - size
    want = [(int(f) + s, n, q) for f, d in zip(first, docs) for s, n, q in brute_runs(d)]
    assert list(zip(start.tolist(), length.tolist(), period.tolist())) == want


def test_fibonacci_words():
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    s, n, q = find_runs(np.array(b * 5, dtype=np.uint64), np.array([len(b) * 5]))
    assert list(zip(s.tolist(), n.tolist(), q.tolist())) == brute_runs(b * 5)


def rows():
    rng = random.Random(4)
    out = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    for i in range(100, 240):
        text = prose(rng, rng.randrange(1, 120))
        if i % 3 == 0:
            unit = prose(rng, rng.choice([1, 2, 7, 8, 9, 20, 40]))
            text += "\t" + "\n".join([unit] * rng.choice([2, 4, 6])) + " " + text
        out.append((i, text))
    return out + out[-3:] + [(None, "a b " * 9), (None, None)]


def result(spark, docs_of, monkeypatch, data, **kwargs):
    monkeypatch.setattr(module, "read", lambda *_: docs_of(data, **kwargs))
    return sorted(map(tuple, op12_periodic_runs(spark, "").collect()), key=str)


def test_query_matches_brute_force(spark, docs_of, monkeypatch):
    assert result(spark, docs_of, monkeypatch, rows()) == sorted((brute(*r) for r in rows()), key=str)


def test_empty_table(spark, docs_of, monkeypatch):
    assert result(spark, docs_of, monkeypatch, []) == []


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c " * 4, "x", "y")], "doc_id int, text string, runs string, collapsed string")
    r = periodic_runs(df).first()
    assert (r.collapsed, [tuple(x) for x in r.runs]) == ("a b c", [(0, 12, 3)])


def test_text_beyond_a_slice(spark, docs_of):
    """Twelve MB in one text: a run of a long period between two stretches without runs."""
    rng = random.Random(9)
    lead, unit = ([f"{k}{rng.randrange(10**6)}" for _ in range(n)] for k, n in (("l", 200_000), ("u", 300_000)))
    text = " ".join(lead + unit * 4 + ["end"])
    assert len(text) > 10 << 20
    r = periodic_runs(docs_of([(1, text), (2, "a a a a a a")])).orderBy("doc_id").collect()
    assert [[tuple(x) for x in y.runs] for y in r] == [[(200_000, 1_200_000, 300_000)], [(0, 6, 1)]]
    assert r[0].collapsed == " ".join(lead + unit + ["end"])
