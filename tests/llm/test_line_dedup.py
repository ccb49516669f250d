import hashlib
import random
from collections import Counter, defaultdict

import pytest

from conftest_llm import ODD_TEXTS, prose
from pricewise.llm import line_dedup as d
from pricewise.llm.common import fresh_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip("\t\n\x0b\x0c\r ").translate(LOWER)


def brute(rows):
    order = lambda i: (i is None, i or 0)
    owner = defaultdict(list)
    for i, t in rows:
        for line in (t or "").split("\n"):
            owner[key(line)].append(order(i))
    owner = {k: min(v) for k, v in owner.items()}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or owner[key(x)] == order(i)]
        out.append((i, len(lines), len(lines) - len(kept),
                    hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def corpus():
    rng = random.Random(11)
    lines = [prose(rng, rng.randrange(1, 6)) for _ in range(40)] + ["", " ", "short", "\tÀbcdéfghijk ", "ÀBCDéfghijk",
             "àbcdéfghijk", "nine char", "ten  chars", "ten  CHARS\x0b", "\x1cten  chars"]
    rows = [(rng.randrange(-5, 300), "\n".join(rng.choice(lines) for _ in range(rng.randrange(9)))) for _ in range(150)]
    rows += [(500 + i, t) for i, t in enumerate(ODD_TEXTS)] + [rows[3], (rows[3][0], lines[2] + "\n" + lines[5])]
    return rows + [(None, lines[1] + "\nonly in null row\nx"), (None, "only in null row")]


@pytest.mark.parametrize("batches,fanout", [(1, 4), (None, 4), (9, 2)])
def test_matches_brute_force(docs_of, batches, fanout):
    rows = corpus()
    df = docs_of(rows).selectExpr("*", "1 as who", "2 as h1", "3 as gone", "4 as doc", "5 as owner", "6 as part", "7 as batch")
    got = d.line_counts(df, batches, fanout).collect()
    want = brute(rows)
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.kept_text.encode()).hexdigest())
                   for r in got) == want
    assert sum(r[2] > 0 for r in want) > 50


def test_extra_columns_are_handed_on(docs_of):
    df = docs_of([(1, "a line that repeats"), (2, "a line that repeats\nown")]).selectExpr("*", "7 as gone", "8 as who")
    got = {r.doc.doc_id: (r.doc.gone, r.doc.who, r.kept_text) for r in d.drop_repeated_lines(df).collect()}
    assert got == {1: (7, 8, "a line that repeats"), 2: (7, 8, "own")}


def test_empty_table(docs_of):
    assert d.line_counts(docs_of([])).count() == 0


def test_runs_are_compacted(spark):
    runs = d.LevelledRuns(spark, fresh_path(spark, "t"), fanout=2)
    for b in range(7):
        batch = spark.range(b * 5, b * 5 + 10).selectExpr(f"{b}L as who", "id as h1", "-id as h2")
        runs.ingest(batch)
        assert len(runs.runs()) <= 4
    known = runs.known().collect()
    assert len(known) == 40 and len({(r.h1, r.h2) for r in known}) == 40
    assert Counter(r.owner for r in known) == Counter({0: 10, **{b: 5 for b in range(1, 7)}})
    assert runs.compactions >= 4 and len(runs.levels) == 3


def test_merge_joins_need_no_exchange_of_the_runs(spark):
    runs = d.LevelledRuns(spark, fresh_path(spark, "t"), fanout=3, buckets=5)
    for b in range(4):
        runs.ingest(spark.range(b * 100, b * 100 + 150).selectExpr(f"{b}L as who", "id as h1", "-id as h2"))
    assert [len(x) for x in runs.levels] == [1, 1]
    batch = spark.range(50, 900).selectExpr("9L as who", "id as h1", "-id as h2")
    fresh = runs.fresh(batch)
    assert fresh.count() == 450
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and plan.count("Bucketed: true") == 2
    assert plan.count("Exchange ") <= 2 and plan.count("hashpartitioning(h1") == plan.count("Exchange ")
    files = spark.table(runs.runs()[0]).inputFiles()
    assert 0 < len(files) <= 5


def test_batches_grow_with_the_texts():
    assert [d.batches_of(n) for n in (0, 1 << 30, 32 << 30, 80 << 30, 100 << 40)] == [4, 4, 4, 10, 12800]


def test_many_rows_of_one_document_or_none(docs_of):
    """Rows that share a doc_id, or have none, lose lines by their own text; none gathers all."""
    shared = [f"line number {k} of many" for k in range(30)]
    rows = [(1, "\n".join(shared[:10]))] + [(7, "\n".join(shared[k % 20:k % 20 + 6] + [f"own line {k}"])) for k in range(60)]
    rows += [(None, "\n".join(shared[k % 25:k % 25 + 5] + [f"nobody's line {k % 9}"])) for k in range(60)]
    df = docs_of(rows)
    runs, keyed = d.ingest_all(df.select("doc_id", "text"), 3, 2)
    gone = d.repeated_lines(keyed, runs).collect()
    assert max(len(r.gone) for r in gone) <= 10 and len(gone) > 40
    got = d.line_counts(df, 3, 2).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.kept_text.encode()).hexdigest())
                   for r in got) == brute(rows)


def test_a_text_beyond_a_slice(docs_of):
    """Twelve MB in one text: repeated lines within it and with others."""
    text = "\n".join(f"line number {k % 200_000} of a long text" for k in range(400_000))
    assert len(text) > 10 << 20
    rows = [(2, text), (1, "line number 5 of a long text\nshort"), (3, text[:4000])]
    got = d.line_counts(docs_of(rows)).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.kept_text.encode()).hexdigest())
                   for r in got) == brute(rows)
