"""Every stage against brute force on its own input, and the whole run."""
import random
from collections import Counter

import corpus_pipeline as c
import test_decontamination
import test_line_dedup
import test_ngram_join
from conftest_llm import ODD_TEXTS, prose
from pricewise.llm import decontamination as d
from pricewise.llm import quality_classifier as q
from pricewise.llm.common import read


def table(spark, rows):
    full = [(i, t, "en", f"s{(i or 0) % 3}", None if t is None else len(t), "x") for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, "
                                 "component_id string").repartition(3)


def write(spark, path, labels, items):
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def corpus():
    rng = random.Random(21)
    rows = test_ngram_join.corpus(21, families=4, copies=8)
    contaminated, items = test_decontamination.corpus(3)
    rows += [(3000 + i, t) for i, (_, t) in enumerate(contaminated)]
    lines = [prose(rng, 8) for _ in range(10)]
    rows += [(5000 + i, "\n".join(rng.sample(lines, 3) + [prose(rng, 20)])) for i in range(30)]
    rows += [(6000 + i, " ".join(w.upper() + "!!" for w in prose(rng, 50).split())) for i in range(40)]
    return rows, items


def test_stages_match_brute_force(spark, tmp_path):
    rows, items = corpus()
    labels = [(i, 0 if i >= 6000 else 1, 0) for i, t in rows if i is not None and t]
    path = write(spark, tmp_path, labels, items)
    docs = table(spark, rows)
    columns = docs.columns

    model = q.fit(docs, read(spark, path, "labels"))
    out = c.quality(spark, docs, path)
    scores = Counter((r.doc_id, r.score >= 0.7) for r in q.scored(docs, model).collect())
    kept = [(r.doc_id, r.text) for r in out.collect()]
    assert Counter(i for i, _ in kept) == Counter({i: n for (i, ok), n in scores.items() if ok})
    assert out.columns == columns and 0 < sum(i is not None and i >= 6000 for i, _ in rows) > \
        sum(i is not None and i >= 6000 for i, _ in kept)

    out = c.lines(spark, table(spark, rows), path)
    owner = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = test_line_dedup.key(line)
            owner[key] = min(owner.get(key, (True, 0)), (i is None, i or 0))
    want = []
    for i, t in rows:
        own = (t or "").split("\n")
        stay = [x for x in own if len(test_line_dedup.key(x)) < 10
                or owner[test_line_dedup.key(x)] == (i is None, i or 0)]
        if len(stay) == len(own) or "".join(stay).encode().split():
            want.append((i, "\n".join(stay)))
    got = out.collect()
    assert Counter((r.doc_id, r.text or "") for r in got) == Counter(want)
    assert out.columns == columns and all(r.n_chars == len(r.text) for r in got if r.text)

    out = c.near_duplicates(spark, docs, path)
    want = test_ngram_join.kept_rows(rows, 5, 80)
    assert Counter((r.doc_id, r.text) for r in out.collect()) == want
    assert out.columns == columns

    out = c.benchmark(spark, docs, path)
    bad = {x[:1] for x in test_decontamination.brute(rows, items, d.MIN_MATCH, d.THRESHOLD)}
    got = Counter((r.doc_id, r.text) for r in out.collect())
    by_text = {t for i, t in rows if test_decontamination.brute([(i, t)], items, d.MIN_MATCH, d.THRESHOLD)}
    assert got == Counter((i, t) for i, t in rows if t not in by_text) and bad


def test_run(spark, sf_small):
    out = c.run(spark, sf_small)
    rows = out.collect()
    assert rows and out.columns[:2] == ["doc_id", "piece"]
    every = {r.doc_id for r in read(spark, sf_small, "documents").select("doc_id").collect()}
    assert {r.doc_id for r in rows} < every


def test_empty_documents(spark, tmp_path):
    path = write(spark, tmp_path, [], [])
    docs = table(spark, [(1, "x")]).limit(0)
    for _, stage in c.STAGES:
        assert stage(spark, docs, path).count() == 0
    odd = table(spark, list(enumerate(ODD_TEXTS)))
    for _, stage in c.STAGES[1:]:
        assert stage(spark, odd, path).count() > 0
