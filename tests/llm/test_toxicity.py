import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import ODD_TEXTS, prose

from pricewise.llm import toxicity as module
from pricewise.llm.textblock import Texts
from pricewise.llm.toxicity import (DISCOUNT, MOST, ORDER, Block, curve, op13_toxicity, scored, values)

STEMS = "vashdrek molguth frinzap".split()


def spoken(rng, toxic, n=80):
    words = prose(rng, n).split()
    if toxic:
        for _ in range(max(1, n // 30)):
            words.insert(rng.randrange(len(words)), rng.choice(STEMS) + rng.choice(["", "ed", "ing", "s", "er"]))
    return " ".join(words)


def corpus(seed, n=400):
    rng = random.Random(seed)
    kinds = [rng.random() < 0.3 for _ in range(n)]
    return [(i, spoken(rng, k, rng.randrange(20, 200))) for i, k in enumerate(kinds)], \
        [(i, int(k)) for i, k in enumerate(kinds)]


def symbols(text):
    data = (text or "").encode()
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in data)
    return re.findall(rb"[0-9a-z\x80-\xff]+", data)


def grams(word):
    s = b" " + word + b" "
    return [(s[max(0, i - ORDER + 1):i], s[i]) for i in range(1, len(s))]


def brute_values(docs, label, share):
    """The formulas of the docstring with dictionaries."""
    types = {g for _, t in docs for w in symbols(t) for g in grams(w)}
    ends = Counter()
    for h, b in types:
        ends[h[-2:], b] += 1
    total, kinds = Counter(), Counter()
    for (h, _), k in ends.items():
        total[h] += k
        kinds[h] += 1

    def shared(h, b):
        return (ends[h, b] - DISCOUNT + DISCOUNT * kinds[h] / 256) / total[h]
    counts = {c: defaultdict(Counter) for c in (0, 1)}
    for i, t in docs:
        if i in label:
            for w in symbols(t):
                for h, b in grams(w):
                    counts[label[i]][h][b] += 1

    def p(c, h, b):
        n = counts[c].get(h)
        if not n:
            return shared(h[-2:], b)
        return (max(n[b] - DISCOUNT, 0) + DISCOUNT * len(n) * shared(h[-2:], b)) / sum(n.values())
    out = []
    for i, t in docs:
        gains = [math.log1p(share * math.expm1(min(MOST, sum(
            math.log(p(1, *g)) - math.log(p(0, *g)) for g in grams(w))))) for w in symbols(t)]
        out.append((i, sum(gains) / len(gains) if gains else 0.0))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int")


def test_values_match_the_formulas(spark, docs_of):
    docs, labels = corpus(1, 40)
    docs += [(100 + i, t) for i, t in enumerate(ODD_TEXTS)] + [docs[3], docs[3], (None, "a vashdrek b"), (None, None)]
    label = dict(labels[:30])
    got = values(docs_of(docs), frame(spark, labels[:30]), 0.01).collect()
    order = lambda rows: sorted(((str(i), round(v, 9)) for i, v in rows))
    assert order(map(tuple, got)) == order(brute_values(docs, label, 0.01))


def test_unseen_forms_of_toxic_words_are_found(spark, docs_of, monkeypatch):
    docs, labels = corpus(2)
    tables = {"documents": docs_of(docs), "labels": frame(spark, labels)}
    monkeypatch.setattr(module, "read", lambda s, d, name: tables[name])
    rows = op13_toxicity(spark, "").collect()
    truth = dict(labels)
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.97


def test_held_out_labels_change_nothing(spark, docs_of):
    docs, labels = corpus(3, 120)
    turned = [(i, 1 - k if zlib.crc32(str(i).encode()) % 5 == 0 else k) for i, k in labels]
    a, b = (sorted(map(tuple, scored(docs_of(docs), frame(spark, x)).collect())) for x in (labels, turned))
    assert a == b


@pytest.mark.parametrize("labels", [[], [(1, None), (None, 1)], [(1, 0), (2, 0)]])
def test_without_toxic_labels_nothing_is_toxic(spark, docs_of, labels):
    rows = scored(docs_of([(1, "a b"), (2, ""), (None, None)]), frame(spark, labels)).collect()
    assert len(rows) == 3 and all(r.score < 0.5 for r in rows)


def test_empty_table(spark, docs_of):
    assert scored(docs_of([]), frame(spark, [])).collect() == []


def test_clashing_columns_and_double_labels(spark):
    docs = spark.createDataFrame([(i, f"w{i} vashdrek", 1.0, 2) for i in range(20)],
                                 "doc_id int, text string, score double, toxic int")
    labels = spark.createDataFrame([(i, k, "x") for i in range(20) for k in (0, 1)],
                                   "doc_id long, toxic int, text string")
    assert scored(docs, labels).count() == 20


def test_block_round_trip_and_a_text_beyond_a_block():
    rng = random.Random(5)
    texts = [b"", b"A a b", " é漢字 x".encode(), " ".join(prose(rng, 2_000_000).split()).encode()]
    assert len(texts[3]) > 10 << 20
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    t = Texts(np.array([5, -1, 0, 7]), np.array([0, 0, 1, 0], bool), data, np.append(0, ends[:-1]), ends)
    b = Block.unpack(Block.of(t).pack())
    assert b.ids.tolist() == [5, -1, 0, 7] and b.null_id.tolist() == [False, False, True, False]
    assert int(b.length.sum()) == len(b.letters)
    edges = np.append(0, np.cumsum(b.length))
    for i, text in enumerate(texts):
        mine = {b.letters[edges[w]:edges[w + 1]].tobytes(): int(n)
                for w, n, d in zip(b.word.tolist(), b.times.tolist(), b.doc.tolist()) if d == i}
        assert mine == Counter(symbols(text.decode()))


def test_curve_takes_the_middle_of_the_gap():
    toxic, ordinary = np.zeros(8192), np.zeros(8192)
    toxic[3000], ordinary[1000] = 5, 50
    middle, width = curve(toxic, ordinary)
    assert abs(middle - (-0.5 + 2000.5 / 2048)) < 1e-3 and width > 0
