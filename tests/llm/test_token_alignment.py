import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import ODD_TEXTS, prose

from pricewise.llm import token_alignment as module
from pricewise.llm.packing import ranks_path, vocabulary_path
from pricewise.llm.token_alignment import (Tokenizers, align, alignments, op11_token_alignment,
                                           pieces_path, places)

PATHS = vocabulary_path(), ranks_path(), pieces_path()
PLAIN = [" leading", "two  spaces", "tab\tand\nlines\r\n", "<|endoftext|> <s> </s> <unk> <0x41>", "▁ mark",
         "emoji 👩‍👩‍👧 中文字符 ไทย é é", "a" * 5000, " " * 3000 + "x", "\x00\x01", "ﬁ Ⅻ ½", "x y　z"]


def own_tokens(text):
    """Ids and bytes by the two libraries alone, one token at a time."""
    import sentencepiece
    from tokenizers import Tokenizer
    if not own_tokens.__dict__:
        own_tokens.a = Tokenizer.from_file(vocabulary_path())
        own_tokens.a.encode_special_tokens = True
        own_tokens.b = sentencepiece.SentencePieceProcessor(model_file=pieces_path())
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [c for c in range(256) if c not in keep]
        own_tokens.byte = {chr(c): c for c in keep} | {chr(256 + i): c for i, c in enumerate(rest)}
    if not text:
        return [], []
    a = [(i, bytes(own_tokens.byte[c] for c in own_tokens.a.id_to_token(i)))
         for i in own_tokens.a.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in own_tokens.b.encode(text):
        p = own_tokens.b.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if own_tokens.b.is_byte(i) else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if any(b"".join(x[1] for x in side) != whole for side in (a, b)):
        return [], []
    return a, b


def groups_of(a, b):
    out, i, j, at = [], 0, 0, [0, 0]
    ga, gb = [], []
    while i < len(a) or j < len(b):
        if at[0] <= at[1]:
            ga.append(a[i][0])
            at[0] += len(a[i][1])
            i += 1
        else:
            gb.append(b[j][0])
            at[1] += len(b[j][1])
            j += 1
        if at[0] == at[1] and ga and gb:
            out.append((ga, gb))
            ga, gb = [], []
    return out


def brute(rows):
    docs, held = [], Counter()
    for doc_id, text in rows:
        a, b = own_tokens(text)
        groups = groups_of(a, b)
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        held.update(set(links))
        docs.append((doc_id, a, b, groups, links))
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for doc_id, a, b, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links),
                    sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


def rows():
    rng = random.Random(11)
    out = list(enumerate(ODD_TEXTS + PLAIN))
    out += [(100 + i, prose(rng, rng.randrange(1, 80)).replace("a", rng.choice("aäж漢"))) for i in range(60)]
    return out + out[-4:] + [(None, "alpha beta"), (None, None)]


def test_query_matches_brute_force(spark, docs_of, monkeypatch):
    monkeypatch.setattr(module, "read", lambda *_: docs_of(rows()))
    got = sorted(map(tuple, op11_token_alignment(spark, "").collect()), key=str)
    assert got == sorted(brute(rows()), key=str)
    assert [r for r in got if r[0] == len(ODD_TEXTS) + 4][0][1:] == (0, 0, 0, 0, 0, 0, "")  # U+2581 in the text


def test_large_groups_by_distinct_ids(spark, docs_of, monkeypatch):
    monkeypatch.setattr(module, "read", lambda *_: docs_of(rows()[:30]))
    monkeypatch.setattr(module, "LARGE_GROUP", 1)
    t = Tokenizers.of(PATHS)
    from pricewise.llm.textblock import Texts
    texts = [("x　y漢" * k).encode() for k in range(1, 30)]
    ends = np.cumsum([len(x) for x in texts])
    block = Texts(np.arange(len(texts)), np.zeros(len(texts), bool), np.frombuffer(b"".join(texts), np.uint8),
                  np.append(0, ends[:-1]), ends)
    small = module.Aligned.of(block, t).links()
    monkeypatch.setattr(module, "LARGE_GROUP", 10**9)
    large = module.Aligned.of(block, t).links()
    assert all(np.array_equal(x, y) for x, y in zip(small, large))


@pytest.mark.parametrize("seed", range(6))
def test_places_and_overlaps(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 4000))
    a, b = (np.unique(np.append(rng.integers(1, n + 1, int(rng.integers(1, n + 1))), n)) for _ in range(2))
    shorter, longer = sorted((a, b), key=len)
    assert np.array_equal(places(shorter, longer), np.searchsorted(longer, shorter))
    found = align(a, b)
    both = np.intersect1d(a, b)
    assert np.array_equal(a[found.a_last], both) and np.array_equal(b[found.b_last], both)
    if len(a) <= len(b):
        begins, other = np.append(0, a[:-1]), np.append(0, b[:-1])
        for i in range(len(a)):
            meets = np.flatnonzero((other < a[i]) & (b > begins[i]))
            assert (found.first[i], found.last[i]) == (meets[0], meets[-1])


def test_operator_gives_groups_and_overlaps(spark, docs_of):
    r = alignments(docs_of([(1, "tokenization of 漢字")])).first()
    a, b = own_tokens("tokenization of 漢字")
    assert (r.a_ids, r.b_ids) == ([x for x, _ in a], [x for x, _ in b])
    got = [(r.a_ids[g.a_first:g.a_last + 1], r.b_ids[g.b_first:g.b_last + 1]) for g in r.groups]
    assert got == groups_of(a, b) and len(r.overlaps) == min(len(a), len(b))


def test_empty_table_and_clashing_columns(spark, docs_of, monkeypatch):
    monkeypatch.setattr(module, "read", lambda *_: docs_of([]))
    assert op11_token_alignment(spark, "").collect() == []
    df = spark.createDataFrame([(1, "a b", 3, "x")], "doc_id int, text string, n_a int, pair string")
    assert module.link_statistics(df).first()[:3] == (1, 2, 2)


def test_text_beyond_a_block():
    rng = random.Random(3)
    text = prose(rng, 1_000_000) + "y" * 200_000
    text = text + " " + text[::-1]
    assert len(text) > 10 << 20
    t = Tokenizers.of(PATHS)
    a, b = t.encode(text.encode())
    found = align(np.cumsum(t.a_size[a]), np.cumsum(t.b_size[b]))
    ends = np.intersect1d(np.cumsum(t.a_size[a]), np.cumsum(t.b_size[b]))
    assert len(a) and np.array_equal(np.cumsum(t.a_size[a])[found.a_last], ends)


def test_both_ways_to_ids_of_a_agree(sf_small):
    import pyarrow.parquet as pq
    t = Tokenizers.of(PATHS)
    texts = [x for x in pq.read_table(f"{sf_small}/documents.parquet").column("text").to_pylist() if x]
    for text in texts[:200] + [p for p in PLAIN if p]:
        assert t.encode_a(" " + text).tolist() == t.a.encode(" " + text, add_special_tokens=False).ids
