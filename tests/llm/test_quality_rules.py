import random
import re
from collections import Counter

from conftest_llm import ODD_TEXTS, prose
from pricewise.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    rep = {i + k for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for k in range(3)}
    base = len(w) < 50 or 100 * len(rep) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(q.SYMBOLS, text)), dup, len(rep), base)


def test_measurements_match_brute_force(docs_of):
    rng = random.Random(1)
    texts = ODD_TEXTS + [prose(rng, rng.randrange(200)).replace(" ", rng.choice([" ", "\n", " # "]), 9)
                         for _ in range(60)]
    texts += texts[:12]
    rows = list(enumerate(texts)) + [(None, "null id text")]
    out = q.apply_policy(q.ledger(docs_of(rows).selectExpr("*", "1 as n_words"))).collect()
    assert len(out) == len(rows)
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                   r.base_failed) for r in out)
    assert got == Counter((i, *brute(t)) for i, t in rows)
    assert all(not r.kept for r in out if r.base_failed)


def test_empty_table_and_ablations(docs_of):
    assert q.ledger(docs_of([])).count() == 0
    rng = random.Random(2)
    rows = [(1, prose(rng, 80)), (2, "too short"), (3, prose(rng, 80) + " #" * 40), (4, "tiny #")]
    led = q.ledger(docs_of(rows))
    ab = {r.rule: r for r in q.ablations(led, "v1").collect()}
    assert ab["few_words"].failed == 2 and ab["few_words"].failed_alone == 1
    assert ab["symbol_ratio"].kept == 1 and ab["symbol_ratio"].kept_without == 2
    assert {r.policy for r in ab.values()} == {"v1"}
