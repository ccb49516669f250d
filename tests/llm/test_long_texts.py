"""Texts of more than ten MB, beyond every slice and block, in the operators whose own tests have
none."""
import random
import zlib

import numpy as np
import pytest
import test_quality_rules
from conftest_llm import prose

from pricewise.llm import license_scan, ngram_join, packing, quality_classifier, quality_rules

LIMIT = 10 << 20


@pytest.fixture(scope="module")
def long_text():
    rng = random.Random(6)
    lines = [prose(rng, 12) for _ in range(150_000)]
    text = "\n".join(lines)
    assert len(text) > LIMIT
    return text


def test_long_text_in_quality_rules(docs_of, long_text):
    rows = [(1, long_text), (2, "short text")]
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
           for r in quality_rules.apply_policy(quality_rules.ledger(docs_of(rows))).collect()}
    assert got == {i: test_quality_rules.brute(t) for i, t in rows}


def test_long_text_in_packing(docs_of, long_text):
    out = packing.pack(docs_of([(1, long_text), (2, "short text")])).orderBy("doc_id", "piece").collect()
    own = [r for r in out if r.doc_id == 1]
    ids = np.append(np.frombuffer(packing.Encoder(packing.vocabulary_path(), None).encode(long_text), "<u4"), 2)
    assert [(r.start, r.length) for r in own] == packing.cut(len(ids), 1024)
    assert [r.ids_crc32 for r in own] == [zlib.crc32(ids[r.start:r.start + r.length].astype("<u4").tobytes()) for r in own]


def test_long_text_in_ngram_join(docs_of, long_text):
    changed = long_text.replace("alpha1 ", "changed ", 50)
    rows = [(3, long_text), (2, changed), (5, long_text[:LIMIT // 3]), (9, "something else")]
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs_of(rows), 4, 85).collect()}
    assert got == {3: 2, 2: 2, 5: 5, 9: 9}
    kept = {r.doc_id for r in ngram_join.one_of_each(docs_of(rows)).select("doc_id").collect()}
    assert kept == {2, 5, 9}


def test_long_text_in_license_scan(spark, long_text):
    header = "Licensed under the Apache License, Version 2.0."
    flat = long_text.replace("\n", " ")
    rows = [("a/x", f"{long_text}\n# {header}\n"), ("a/y", f"{flat[:LIMIT // 2]}. {header} It is so. {flat[LIMIT // 2:]}"),
            ("b/z", long_text), ("b/LICENSE", "Released under the MIT License.")]
    got = {r.path: (r.licence, r.origin) for r in license_scan.scan(
        spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got == {"a/x": ("Apache-2.0", "own"), "a/y": ("Apache-2.0", "own"), "b/z": ("MIT", "directory"),
                   "b/LICENSE": ("MIT", "own")}


def test_long_text_in_quality_classifier(spark, docs_of, long_text):
    rng = random.Random(8)
    rows = [(i, prose(rng, 60) if i % 2 else " ".join(w.upper() + "!!" for w in prose(rng, 60).split())) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    docs = docs_of(rows + [(1000, long_text), (1001, long_text.upper().replace(" ", "!! "))])
    model = quality_classifier.fit(docs, labels)
    got = {r.doc_id: r.score for r in quality_classifier.scored(docs, model).collect()}
    assert got[1000] >= 0.7 > got[1001]
