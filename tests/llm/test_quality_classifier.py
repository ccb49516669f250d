import random
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest_llm import ODD_TEXTS, prose
from pricewise.llm import quality_classifier as q
from pricewise.llm.common import read
from pricewise.llm.textblock import Texts

LABELS = "doc_id long, quality int, toxic int"


def texts_of(texts):
    data = [t.encode() for t in texts]
    ends = np.cumsum([len(d) for d in data])
    return Texts(np.arange(len(data)), np.zeros(len(data), bool),
                 np.frombuffer(b"".join(data), dtype=np.uint8), ends - [len(d) for d in data], ends)


def test_term_counts_match_a_loop():
    rng = random.Random(4)
    texts = [t or "" for t in ODD_TEXTS] + [prose(rng, 30) for _ in range(5)]
    together = q.term_counts(texts_of(texts))
    for i, t in enumerate(texts):
        alone = q.term_counts(texts_of([t]))[0]
        assert (alone == together[i]).all()
        assert alone[: q.TRIGRAMS].sum() == max(0, len(t.encode()) - 2)
        assert alone[q.TRIGRAMS:].sum() == len(t.encode().split())


def test_score_is_the_vote_of_the_nearest():
    rng = np.random.default_rng(2)
    v = rng.standard_normal((300, 6)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[7] = v[8]
    labels = rng.integers(0, 2, 300).astype(float)
    model = q.Model(np.ones(q.TERMS), rng.standard_normal((q.TERMS, 6)).astype(np.float32), v, labels, 9)
    counts = rng.poisson(0.05, (40, q.TERMS)).astype(np.float32)
    counts[3] = 0
    got = model.score(counts)
    cosine = np.maximum(model.embed(counts) @ v.T, 0)
    for i in range(40):
        near = np.argsort(-cosine[i])[:9]
        near = np.nonzero(cosine[i] >= cosine[i][near[-1]])[0]
        want = (cosine[i][near] * labels[near]).sum() / cosine[i][near].sum() if i != 3 else labels.mean()
        assert got[i] == pytest.approx(want, abs=1e-5)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in q.op10_quality_classifier(spark, sf).collect()}
    assert len(rows) == read(spark, sf, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows.values())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    test = [(rows[r.doc_id], r.quality) for r in read(spark, sf, "labels").collect() if rows[r.doc_id].held_out]
    assert np.mean([r.predicted == y for r, y in test]) > 0.95


def test_odd_inputs(spark, docs_of):
    rng = random.Random(9)
    good = [prose(rng, 40) for _ in range(30)]
    bad = [" ".join(w.upper() + "!!" for w in prose(rng, 40).split()) for _ in range(30)]
    rows = list(enumerate(ODD_TEXTS + good + bad)) + [(5, good[0]), (None, bad[0])]
    labels = [(i, int(t in good), 0) for i, t in rows if i is not None and i >= len(ODD_TEXTS)]
    labels += [(12, None, 1), (None, 1, 0), (9999, 1, 0), labels[0]]
    df = docs_of(rows).selectExpr("*", "1 as score", "1 as label")
    model = q.fit(df, spark.createDataFrame([(*r, "x") for r in labels], LABELS + ", text string"), neighbours=5)
    got = q.scored(df, model).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    of = {r.doc_id: r.score for r in got}
    first = len(ODD_TEXTS)
    assert min(of[i] for i in range(first + 1, first + 30)) > max(of[i] for i in range(first + 31, first + 60))
    assert of[0] == of[1] == pytest.approx(model.prior, abs=1e-6)
    none = q.fit(df, spark.createDataFrame([], LABELS))
    assert {r.score for r in q.scored(df, none).collect()} == {0.5}
    assert q.scored(docs_of([]), model).count() == 0
    empty = q.fit(docs_of([]), spark.createDataFrame([], LABELS))
    assert q.scored(docs_of([(1, None)]), empty).first().score == 0.5
