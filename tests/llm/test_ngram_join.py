import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from conftest_llm import ODD_TEXTS, WORDS, prose
from pricewise.llm import ngram_join as j
from pricewise.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_and_groups(rows, k, percent):
    """Each row's shingles, and the number of its component."""
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k
                    else ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    up[max(find(a), find(b))] = min(find(a), find(b))
    return sets, [find(i) for i in range(len(rows))]


def brute(rows, k, percent):
    sets, group = sets_and_groups(rows, k, percent)
    low = {}
    for r, (doc_id, _) in zip(group, rows):
        if doc_id is not None:
            low[r] = min(low.get(r, doc_id), doc_id)
    return Counter((rows[i][0], len(sets[i]), low.get(group[i])) for i in range(len(rows)))


def corpus(seed, families=8, copies=12):
    rng = random.Random(seed)
    texts = list(ODD_TEXTS) + ["one two", "One TWO", "two one", "é É", "a b c", "a b c d", "a b c e"]
    for _ in range(families):
        base = prose(rng, rng.randrange(20, 160)).split(" ")
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                i = rng.randrange(len(w))
                w[i:i + rng.choice([0, 1])] = [rng.choice(WORDS)]
            if rng.random() < 0.2:
                w = w[rng.randrange(9):]
            texts.append(" ".join(w).title() if rng.random() < 0.2 else "\n".join(w))
    texts += [prose(rng, 60) + " " + " ".join(WORDS) for _ in range(10)]
    rng.shuffle(texts)
    rows = [(i * 5 % 1499, t) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[30], (None, texts[31]), (None, "only here"), (None, "only here"), (rows[2][0], texts[40])]


@pytest.mark.parametrize("words,percent,chunk_sets,late_sets", [
    (4, 85, 2000, 2000), (5, 80, 5, 2000), (2, 60, 7, 3), (5, 80, 2, 4)])
def test_components_match_brute_force(docs_of, words, percent, chunk_sets, late_sets):
    rows = corpus(words)
    df = docs_of(rows).selectExpr("*", "'x' as node", "1 as n_shingles", "2 as root")
    got = j.near_duplicates(df, words, percent, chunk_sets, late_sets).collect()
    want = brute(rows, words, percent)
    assert Counter(tuple(r) for r in got) == want
    assert len({c for _, _, c in want}) < len(rows) - 20


def kept_rows(rows, words, percent):
    """What stays of ``rows`` by the rule of ``one_of_each``, row by row."""
    _, label = sets_and_groups(rows, words, percent)
    best = {}
    for k, (i, t) in enumerate(rows):
        if i is not None:
            place = (i, hashlib.md5((t or "").encode()).digest())
            best[label[k]] = min(best.get(label[k], (place, k)), (place, k))
    return Counter(r for k, r in enumerate(rows) if r[0] is None or best[label[k]][1] == k)


def test_one_of_each_decides_by_row(docs_of):
    base = " ".join(WORDS)
    a, b, c = base, "other " * 3 + "words here of no one else", base[6:] + " nothing near it"
    near = base.replace("omega", "end")
    probe = [(1, a), (5, a), (5, b), (None, c), (None, c)]
    out = j.one_of_each(docs_of(probe))
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter([(1, a), (5, b), (None, c), (None, c)])
    probe = [(7, a), (7, a), (7, near), (8, near), (9, ""), (9, ""), (9, None), (None, a), (3, "one two"), (3, "one two")]
    out = j.one_of_each(docs_of(probe), 5, 70)
    assert Counter((r.doc_id, r.text) for r in out.collect()) == kept_rows(probe, 5, 70)


def test_one_of_each_matches_brute_force(docs_of):
    rows = corpus(9)
    out = j.one_of_each(docs_of(rows).selectExpr("*", "'x' as node", "1 as root", "2 as text_key"))
    assert Counter((r.doc_id, r.text) for r in out.collect()) == kept_rows(rows, 5, 80)
    assert out.columns[-3:] == ["node", "root", "text_key"]


def test_a_large_group_of_near_copies_is_about_linear(spark, monkeypatch):
    """20,000 sets that all lie in one cluster: what is sent in both rounds stays below a small
    multiple, and the links connect them all."""
    n, size = 20_000, 60
    sent = []
    real = j._linked

    def counted(groups, percent):
        sent.append(groups.count())
        return real(groups, percent)
    monkeypatch.setattr(j, "_linked", counted)

    def rows(batches):
        for b in batches:
            for k in b.column("id").to_pylist():
                # one shingle of its own in each set, the others are those of all
                own = np.array([*range(size - 1), 10**6 + k], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k.to_bytes(16, "big")]), pa.array([size]),
                     pa.array([own.tobytes() + bytes([200] * (size - 1) + [1])]), pa.array([[0, 1]], pa.list_(pa.int64()))],
                    ["node", "n_shingles", "shingles", "prefix"])
    sets = spark.range(0, n, 1, 8).mapInArrow(rows, "node binary, n_shingles long, shingles binary, prefix array<long>")
    found = components(j.links(sets, 85))
    assert found.count() == n and found.select("root").distinct().count() == 1
    assert sum(sent) <= 4 * n


def test_a_cluster_without_a_large_component_loses_no_link(docs_of):
    """Sets that share boilerplate in their prefixes but link in small groups only."""
    rng = random.Random(12)
    shared = [" ".join(rng.sample(WORDS, 8)) for _ in range(6)]
    rows = []
    for k in range(90):
        w = prose(rng, 50).split()
        for c in range(rng.choice([1, 2, 3])):
            v = list(w)
            v[rng.randrange(len(v))] = f"c{k}{c}"
            rows.append((len(rows), " ".join(v + rng.sample(shared, 2))))
    got = j.near_duplicates(docs_of(rows), 3, 75, 4, 5).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, 3, 75)


def test_empty_tables(docs_of):
    assert j.near_duplicates(docs_of([])).count() == 0
    assert [tuple(r) for r in j.near_duplicates(docs_of([(3, None), (4, "")])).collect()] in (
        [(3, 0, 3), (4, 0, 4)], [(4, 0, 4), (3, 0, 3)])


def test_tree_shares_beginnings_and_prunes():
    sets = [[0, 1, 2, 5], [0, 1, 2, 6], [0, 1, 3], [0, 1, 2, 5, 7], [4, 8]]
    tree = j.build_tree(sets, [len(s) for s in sets])
    paths = sorted(n.path for n in tree.children)
    assert paths == [(0, 1), (4, 8)] and tree.low == 2 and tree.high == 5
    forest = j.link(sets, [len(s) for s in sets], 80, 0)
    assert [forest.find(i) for i in range(5)] == [0, 1, 2, 0, 4]


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_least_overlap(percent):
    for a in range(1, 40):
        for b in range(1, 40):
            want = min(i for i in range(0, 200) if 100 * i >= percent * (a + b - i))
            assert j.least_overlap(percent, a, b) == want


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)]
    up = {n: n for e in edges for n in e}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n
    for a, b in edges:
        up[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in up if any(n in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
