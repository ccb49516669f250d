import gc
import random
import time
import unicodedata
import weakref
from collections import Counter

import numpy as np
import pytest

from conftest_llm import ODD_TEXTS, WORDS, prose
from pricewise.llm import decontamination as d

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(t):
    """One character at a time."""
    out, word = [], ""
    for c in (t or "").translate(LOWER) + " ":
        inside = [any(a <= ord(c) <= b for a, b in blocks) for blocks in (d.UNSPACED, d.SYMBOLS)]
        apart = inside[1] if ord(c) > 0xFFFF else unicodedata.category(c)[0] in "PZSC"
        if not apart and not inside[0]:
            word += c
            continue
        out += [word] * bool(word) + [c] * (not apart)
        word = ""
    return out


HAN = "的一是不了人我在有他这为之大来以个中上们到说国和地也子时道出而要于就下得可你年生"


def brute_tiles(p, t, least):
    """Textbook greedy string tiling: all maximal matches of the greatest length, in order."""
    pf, tf, total, n = [True] * len(p), [True] * len(t), 0, 0
    where = {}
    for j, x in enumerate(t):
        where.setdefault(x, []).append(j)
    while True:
        best, found = least, []
        for i in range(len(p)):
            for j in where.get(p[i], ()):
                k = 0
                while i + k < len(p) and j + k < len(t) and p[i + k] == t[j + k] and pf[i + k] and tf[j + k]:
                    k += 1
                if k > best:
                    best, found = k, [(i, j)]
                elif k == best:
                    found.append((i, j))
        done = 0
        for i, j in found:
            if all(pf[i:i + best]) and all(tf[j:j + best]):
                pf[i:i + best], tf[j:j + best] = [False] * best, [False] * best
                total, n, done = total + best, n + 1, done + 1
        if not done:
            return n, total


def brute(rows, items, least, threshold):
    out = []
    for doc_id, text in rows:
        t = tokens(text)
        for item_id, item in items:
            p = tokens(item)
            if p:
                n, total = brute_tiles(p, t, min(least, len(p)))
                if total >= threshold * len(p) - 1e-9:
                    out.append((doc_id, item_id, total, len(p)))
    return Counter(out)


def corpus(seed):
    rng = random.Random(seed)
    items = [(i, prose(rng, rng.randrange(3, 40))) for i in range(25)]
    items += [(90, "one two"), (91, None), (92, ""), (94, "..."), (95, "Omega7"), (96, "nu3 nu3"), (97, "one two"),
              (93, items[3][1]), (None, items[4][1] + " End, of Ítem"), items[5]]
    items += [(200 + i, "".join(rng.choice(HAN) for _ in range(n))) for i, n in enumerate((2, 3, 4, 9, 50))]
    items += [(210, "สวัสดีครับ ยินดีต้อนรับ"), (211, "これは試験です。よろしく、カナ！"), (212, "한국어 문장 은 띄어 쓴다 여기")]
    texts = list(ODD_TEXTS) + ["one two", "x one, Two!", "two one"]
    for _, t in items[-8:]:
        texts += [t, "前" + t + "後", "abc" + t + "def 中 " + t[::-1], prose(rng, 9) + "“" + t[:len(t) // 2] + "」" + t[len(t) // 2:]]
    for _, t in items[:25]:
        w = t.split(" ")
        half = len(w) // 2
        texts.append(prose(rng, 20) + "\n" + t.upper().replace(" ", ", ") + "! " + prose(rng, 20))
        texts.append(" ".join(w[half:]) + " . " + prose(rng, 9) + " " + " ".join(w[:half]))
        cut = [w[i:i + 6] for i in range(0, len(w), 6)]
        rng.shuffle(cut)
        texts.append(" ".join(rng.choice(WORDS) + " " + " ".join(c) for c in cut))
        texts.append(" ".join(x if rng.random() < 0.8 else "changed" for x in w) + " " + prose(rng, 10))
        texts.append(prose(rng, 60))
    rows = list(enumerate(texts))
    return rows + [rows[12], (None, rows[14][1])], items


@pytest.mark.parametrize("block_tokens", [1 << 20, 150])
def test_contaminated_documents_match_brute_force(spark, docs_of, block_tokens):
    rows, items = corpus(8)
    bench = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    df = docs_of(rows).selectExpr("*", "1 as item_id")
    got = d.matches(df, bench, block_tokens=block_tokens).collect()
    want = brute(rows, items, d.MIN_MATCH, d.THRESHOLD)
    assert Counter((r.doc_id, r.item_id, r.matched_tokens, r.item_tokens) for r in got) == want
    assert len(want) > 50
    assert all(r.coverage == pytest.approx(r.matched_tokens / r.item_tokens) for r in got)


def test_ten_blocks_one_at_a_time(spark, docs_of, monkeypatch):
    """Rows that stay are the same by one block or ten, and one block is in memory at a time."""
    rows, items = corpus(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    alive, most, real = [], [], d.Block.of

    def of(own, min_match):
        block = real(own, min_match)
        alive.append(weakref.ref(block))
        gc.collect()
        most.append(sum(x() is not None for x in alive))
        return block
    monkeypatch.setattr(d.Block, "of", of)
    df = docs_of(rows).selectExpr("*", "'k' as _kind")
    bad = {t for i, t in rows if brute([(i, t)], items, d.MIN_MATCH, d.THRESHOLD)}
    want = Counter(r for r in rows if r[1] not in bad)
    size = sum(len((t or "").encode()) for _, t in items)
    for tokens_, n in ((1 << 20, 1), (-(-size // 20), 10)):
        alive.clear()
        most.clear()
        blocks = d.Blocks(bench, d.MIN_MATCH, tokens_)
        out = d.clean(df, bench, block_tokens=tokens_)
        assert blocks.n == len(most) == n and max(most) <= 2  # the next one is built before the last is let go
        assert Counter((r.doc_id, r.text) for r in out.collect()) == want and out.columns == df.columns


def test_short_items_and_unspaced_scripts(spark, docs_of):
    items = [(1, "Zweigstelle"), (2, "drei kurze Worte"), (3, "".join(HAN[:50])), (4, "ทดสอบระบบ")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = ["die zweigstelle.", "Zweigstellen", "x drei, kurze — worte x", "drei kurze andere Worte", "".join(HAN[:50]),
             "中" + HAN[:50] + "文 und mehr", HAN[20:25], "กข" + items[3][1] + "คง", "nichts"]
    got = sorted((r.doc_id, r.item_id) for r in d.matches(docs_of(list(enumerate(texts))), bench).collect())
    assert got == [(0, 1), (2, 2), (4, 3), (5, 3), (7, 4)]


def test_a_long_text_of_repeated_words(spark, docs_of):
    """Ten MB of a few words against items of the same words: no more than a few seconds."""
    text = "la la land " * 950_000
    assert len(text) > 10 << 20 - 1
    bench = spark.createDataFrame([(1, "la la land " * 40), (2, "la la la " * 30), (3, "no la")], "item_id long, text string")
    start = time.time()
    got = [(r.item_id, r.n_tiles, r.coverage) for r in d.matches(docs_of([(7, text)]), bench).collect()]
    assert got == [(1, 1, 1.0)] and time.time() - start < 120


def test_reordered_parts_are_found(spark, docs_of):
    item = "a1 a2 a3 a4 a5 b1 b2 b3 b4 b5 c1 c2 c3 c4 c5"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = d.matches(docs_of([(5, "c1 c2 c3 c4 c5 x a1 a2 a3 a4 a5 y b1 b2 b3 b4 b5"),
                             (6, "c1 c2 c3 x c4 c5 a1 a2 a3 y b1")]), bench).collect()
    assert [(r.doc_id, r.n_tiles, r.coverage) for r in got] == [(5, 3, 1.0)]


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    assert d.matches(docs_of([(1, "a b c d e")]), none).count() == 0
    assert d.matches(docs_of([]), some).count() == 0
    assert d.matches(docs_of([(1, "A, b c d e!")]), some).count() == 1


def test_tiles_never_overlap():
    rng = np.random.default_rng(1)
    for _ in range(200):
        p = rng.integers(0, 4, rng.integers(4, 30)).astype(np.uint64)
        t = rng.integers(0, 4, rng.integers(4, 60)).astype(np.uint64)
        seeds = {tuple(p[i:i + 4]) for i in range(len(p) - 3)}
        starts = np.array([i for i in range(len(t) - 3) if tuple(t[i:i + 4]) in seeds], dtype=np.int64)
        tiles = d.tile(p, t, starts, 4)
        for at, n in ((1, len(p)), (2, len(t))):
            used = np.zeros(n, int)
            for x in tiles:
                used[x[at]:x[at] + x[0]] += 1
            assert used.max(initial=0) <= 1
        assert all((p[a:a + n] == t[b:b + n]).all() and n >= 4 for n, a, b in tiles)
