"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters, digits and marks (A-Z in lower case) of scripts that part words;
of scripts that don't (Chinese, Japanese, Thai and their like) every character is a token.
Punctuation, symbols and white space of any script part tokens and are none.

The ``min_match``-token seeds of the benchmark are joined with those of every document. A document
and an item whose shared seeds could cover ``threshold`` of the item are tiled: the longest
common runs of unmarked tokens are found by hashing all windows of a length (Karp-Rabin, from
running hashes), marked longest first, and the length is lowered until ``min_match``. Tiles do
not overlap and may stand in any order, so a passage whose parts were moved is found as well.
A document is contaminated by an item if its tiles cover ``threshold`` of the item's tokens. An
item of fewer tokens than ``min_match`` is its own seed: its one tile is the whole item.

The benchmark is a stated query set against all documents: it is held in blocks of at most
about ``BLOCK_TOKENS`` tokens, one scan of the documents for each block. Where there are several,
each block's result is written before the next block is read, so the driver and a task hold one
block, however large the benchmark is.

Defined cases: null and empty texts, and items without tokens, match nothing; rows that repeat an
item or a document each give their rows; null ids pass through; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, read
from .textblock import (Texts, ascii_lower, batch_slices, byte_sums, prefix_sums, range_hash,
                        slices)

MIN_MATCH = 4
THRESHOLD = 0.6
#: Tokens of a block of the benchmark: some 100 bytes each in a task.
BLOCK_TOKENS = 1 << 20

RESULT = "doc_id long, item_id long, n_tiles int, matched_tokens int, item_tokens int, coverage double"

_CODES = np.arange(256)
_PARTS = ~((_CODES >= 128) | ((_CODES >= 48) & (_CODES <= 57)) | ((_CODES >= 65) & (_CODES <= 90))
           | ((_CODES >= 97) & (_CODES <= 122)))
_SEED_BITS = 20
#: Pairs of equal windows that are looked at in one go.
_PAIRS = 1 << 20

#: Blocks of scripts that don't part words (Thai and Lao, Myanmar, Khmer, Han
#: radicals, kana and bopomofo, Han with extension A, Yi, compatibility Han, half-width kana,
#: kana supplements, further Han planes), and blocks beyond U+FFFF that are symbols.
UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x2FDF), (0x3040, 0x312F),
            (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F),
            (0x1B000, 0x1B16F), (0x20000, 0x3FFFF)]
SYMBOLS = [(0x1D000, 0x1D3FF), (0x1F000, 0x1FAFF)]
_WORD, _SINGLE, _APART = range(3)
_kinds: list[np.ndarray] = []


def _within(code: np.ndarray, blocks: list[tuple[int, int]]) -> np.ndarray:
    out = np.zeros(len(code), dtype=bool)
    for low, high in blocks:
        out |= (code >= low) & (code <= high)
    return out


def kinds_of(code: np.ndarray) -> np.ndarray:
    """Of each code point: part of a word, a token of its own, or parting tokens. Below
    U+10000 punctuation, separators, symbols and controls are known by their categories."""
    if not _kinds:
        small = np.arange(0x10000)
        apart = np.array([unicodedata.category(chr(c))[0] in "PZSC" for c in small.tolist()])
        _kinds.append(np.where(apart, _APART, np.where(_within(small, UNSPACED), _SINGLE, _WORD)))
    high = code >= 0x10000
    out = _kinds[0][np.where(high, 0, code)]
    out[high] = np.where(_within(code[high], SYMBOLS), _APART,
                         np.where(_within(code[high], UNSPACED), _SINGLE, _WORD))
    return out


def _code_points(data: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code point and number of bytes of the UTF-8 characters that begin at ``lead`` (not ASCII)."""
    first = data[lead].astype(np.int64)
    size = np.where(first >= 0xF0, 4, np.where(first >= 0xE0, 3, 2))
    code = first & (0xFF >> (size + 1))
    for k in (1, 2, 3):
        more = size > k
        code[more] = code[more] << 6 | (data[lead[more] + k] & 0x3F)
    return code, size


def token_bounds(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every token, over all texts."""
    n = len(t.data)
    token, cut = ~_PARTS[t.data], np.zeros(n + 1, dtype=bool)
    cut[t.starts], cut[t.ends] = True, True
    lead = np.flatnonzero(t.data >= 0xC0)
    if len(lead):
        code, size = _code_points(t.data, lead)
        kind = kinds_of(code)
        for k in range(4):
            token[(lead + k)[(kind == _APART) & (size > k)]] = False
        alone = kind == _SINGLE
        cut[lead[alone]], cut[(lead + size)[alone]] = True, True
    before, after = np.append(False, token[:-1])[:n], np.append(token[1:], False)[:n]
    return np.flatnonzero(token & (~before | cut[:-1])), np.flatnonzero(token & (~after | cut[1:])) + 1


class Tokens:
    """Token hashes of a slice, running sums over them, and each document's run."""

    def __init__(self, t: Texts):
        begin, end = token_bounds(t)
        self.doc = t.doc_of(begin) if len(begin) else begin
        self.hash = range_hash(byte_sums(ascii_lower(t.data)), begin, end)
        self.sums = prefix_sums(self.hash)
        self.size = np.bincount(self.doc, minlength=len(t))
        self.first = np.cumsum(self.size) - self.size

    def seeds(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions at which ``k`` tokens of one document stand, and their hashes."""
        at = np.arange(max(0, len(self.hash) - k + 1))
        at = at[self.doc[at] == self.doc[at + k - 1]]
        return at, range_hash(self.sums, at, at + k)


def tile(pattern: np.ndarray, text: np.ndarray, starts: np.ndarray, min_match: int) -> list[tuple]:
    """Greedy string tiling of two token sequences: (length, pattern start, text start) of
    the tiles. ``starts`` are the places in ``text`` at which a seed of the pattern stands.
    A length is tried from the longest that can occur; a longer match than twice the length
    begins the search anew at its length; otherwise all matches found are marked, longest
    first, and the length is halved, to ``min_match`` at last."""
    pattern_sums, text_sums = prefix_sums(pattern), prefix_sums(text)
    pattern_free, text_free = np.ones(len(pattern), bool), np.ones(len(text), bool)
    tiles: list[tuple] = []
    # a match is seeds at consecutive places, so it is no longer than the longest run of them
    runs = np.split(starts, np.nonzero(np.diff(starts) != 1)[0] + 1) if len(starts) else []
    s = min(len(pattern), max((len(r) for r in runs), default=0) + min_match - 1)
    while s >= min_match:
        found = _matches(pattern, text, pattern_sums, text_sums, pattern_free, text_free, starts, s)
        longest = max((f[0] for f in found), default=0)
        if longest > 2 * s:
            s = longest
            continue
        for length, p, t in sorted(found, key=lambda f: (-f[0], f[1], f[2])):
            if pattern_free[p:p + length].all() and text_free[t:t + length].all():
                pattern_free[p:p + length] = False
                text_free[t:t + length] = False
                tiles.append((length, p, t))
        if s == min_match:
            # what was found may have been cut by a longer tile: until nothing is left
            if not found:
                break
        else:
            s = max(min_match, s // 2)
    return tiles


def _run_ends(free: np.ndarray) -> np.ndarray:
    """For each place the first one from there on that is not free."""
    stop = np.where(free, len(free), np.arange(len(free)))
    return np.minimum.accumulate(stop[::-1])[::-1]


def _matches(pattern, text, pattern_sums, text_sums, pattern_free, text_free, starts, s) -> list[tuple]:
    """Maximal matches of at least ``s`` unmarked tokens. Pairs of equal windows that only go on
    with a match that begins before are left out in arrays, ``_PAIRS`` at a time."""
    free = np.append(0, np.cumsum(pattern_free))
    p_at = np.arange(len(pattern) - s + 1)
    p_at = p_at[free[p_at + s] - free[p_at] == s]
    p_hash = range_hash(pattern_sums, p_at, p_at + s)
    order = np.argsort(p_hash, kind="stable")
    p_at, p_hash = p_at[order], p_hash[order]
    free = np.append(0, np.cumsum(text_free))
    t_at = starts[starts + s <= len(text)]
    t_at = t_at[free[t_at + s] - free[t_at] == s]
    t_hash = range_hash(text_sums, t_at, t_at + s)
    low = np.searchsorted(p_hash, t_hash)
    n = np.searchsorted(p_hash, t_hash, side="right") - low
    hit = n > 0
    t_at, low, n = t_at[hit], low[hit], n[hit]
    p_end, t_end = _run_ends(pattern_free), _run_ends(text_free)
    total = np.cumsum(n)
    found: list[tuple] = []
    at = 0
    while at < len(n):
        end = max(at + 1, int(np.searchsorted(total, total[at] - n[at] + _PAIRS, side="right")))
        k = n[at:end]
        t = np.repeat(t_at[at:end], k)
        p = p_at[np.repeat(low[at:end] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))]
        goes_on = (p > 0) & (t > 0)
        q, r = p[goes_on] - 1, t[goes_on] - 1
        goes_on[goes_on] = pattern_free[q] & text_free[r] & (pattern[q] == text[r])
        p, t = p[~goes_on], t[~goes_on]
        # as far as both go on alike and unmarked, by halving
        length = np.full(len(p), s)
        most = np.minimum(p_end[p] - p, t_end[t] - t)
        while (length < most).any():
            mid = (length + most + 1) // 2
            same = range_hash(pattern_sums, p, p + mid) == range_hash(text_sums, t, t + mid)
            length, most = np.where(same, mid, length), np.where(same, most, mid - 1)
        found += zip(length.tolist(), p.tolist(), t.tolist())
        at = end
    return found


@dataclass
class Block:
    """Some items of the benchmark: their tokens, and their seeds in order of hash."""
    items: list[int | None]
    tokens: list[np.ndarray]
    seed: np.ndarray       # distinct seed hashes
    begin: np.ndarray      # of a seed's places in ``item`` and ``place``
    item: np.ndarray
    place: np.ndarray
    mask: np.ndarray       # which leading bits of a hash occur
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # items of fewer tokens than a seed, by
                                                     # their number: hashes and items, by hash

    @staticmethod
    def of(rows: list[tuple[int | None, str]], min_match: int) -> Block:
        data = [(text or "").encode() for _, text in rows]
        size = np.array([len(d) for d in data], dtype=np.int64)
        ends = np.cumsum(size)
        t = Texts(np.zeros(len(rows), np.int64), np.zeros(len(rows), bool),
                  np.frombuffer(b"".join(data), dtype=np.uint8), ends - size, ends)
        k = Tokens(t)
        at, h = k.seeds(min_match)
        order = np.argsort(h, kind="stable")
        at, h = at[order], h[order]
        new = np.nonzero(np.append(True, h[1:] != h[:-1])[: len(h)])[0]
        mask = np.zeros(1 << _SEED_BITS, dtype=bool)
        mask[h >> np.uint64(64 - _SEED_BITS)] = True
        short = {}
        for n in range(1, min_match):
            own = np.flatnonzero(k.size == n)
            if len(own):
                key = range_hash(k.sums, k.first[own], k.first[own] + n)
                order = np.argsort(key, kind="stable")
                short[n] = key[order], own[order]
        return Block([i for i, _ in rows], [k.hash[f:f + n] for f, n in zip(k.first, k.size)], h[new],
                     np.append(new, len(h)), k.doc[at], at - k.first[k.doc[at]], mask, short)


def _pairs(block: Block, k: Tokens, min_match: int, threshold: float) -> list[tuple[int, int, np.ndarray]]:
    """(document, item, places of shared seeds in the document) of the pairs whose shared
    seeds, each taken once, cover ``threshold`` of the item."""
    at, h = k.seeds(min_match)
    hit = block.mask[h >> np.uint64(64 - _SEED_BITS)]
    at, h = at[hit], h[hit]
    where = np.minimum(np.searchsorted(block.seed, h), max(0, len(block.seed) - 1))
    hit = block.seed[where] == h if len(block.seed) else np.zeros(len(h), bool)
    at, where = at[hit], where[hit]
    if not len(at):
        return []
    doc = k.doc[at]
    once = np.unique(doc * np.int64(len(block.seed)) + where)
    d, seed = once // len(block.seed), once % len(block.seed)
    n = block.begin[seed + 1] - block.begin[seed]
    entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(block.begin[seed], n)
    d, item, place = np.repeat(d, n), block.item[entry], block.place[entry]
    order = np.lexsort((place, item, d))
    d, item, place = d[order], item[order], place[order]
    fresh = np.append(True, (d[1:] != d[:-1]) | (item[1:] != item[:-1]))
    gain = np.where(fresh, min_match, np.minimum(min_match, np.append(0, np.diff(place))))
    pair = np.cumsum(fresh) - 1
    cover = np.bincount(pair, weights=gain)
    first = np.nonzero(fresh)[0]
    size = np.array([len(x) for x in block.tokens])
    good = np.nonzero(cover >= threshold * size[item[first]] - 1e-9)[0]
    out = []
    for g in good.tolist():
        i, own = int(item[first[g]]), int(d[first[g]])
        lo, hi = np.searchsorted(doc, [own, own + 1])
        shared = set(_seeds_of(block, i, min_match).tolist())
        mine = at[lo:hi][[x in shared for x in where[lo:hi].tolist()]] - k.first[own]
        out.append((own, i, mine))
    return out


def _seeds_of(block: Block, item: int, min_match: int) -> np.ndarray:
    tokens = block.tokens[item]
    at = np.arange(len(tokens) - min_match + 1)
    return np.searchsorted(block.seed, range_hash(prefix_sums(tokens), at, at + min_match))


def _short_items(block: Block, k: Tokens) -> Iterator[tuple[int, int, list[tuple]]]:
    """(document, item, tile) of the items of fewer tokens than a seed that a document holds."""
    for n, (key, item) in block.short.items():
        at, h = k.seeds(n)
        low = np.searchsorted(key, h)
        count = np.searchsorted(key, h, side="right") - low
        at, low, count = at[count > 0], low[count > 0], count[count > 0]
        # the first place of each item in each document
        entry = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        at = np.repeat(at, count)
        _, first = np.unique(k.doc[at] * np.int64(len(block.items)) + item[entry], return_index=True)
        for a, i in zip(at[first].tolist(), item[entry[first]].tolist()):
            d = int(k.doc[a])
            yield d, i, [(n, 0, a - int(k.first[d]))]


def _contaminated(block: Block, k: Tokens, min_match: int, threshold: float
                  ) -> Iterator[tuple[int, int, list[tuple]]]:
    """(document, item, tiles) of the pairs whose tiles cover ``threshold`` of the item."""
    yield from _short_items(block, k)
    for d, i, starts in _pairs(block, k, min_match, threshold):
        text = k.hash[k.first[d]:k.first[d] + k.size[d]]
        tiles = tile(block.tokens[i], text, starts, min_match)
        if sum(x[0] for x in tiles) >= threshold * len(block.tokens[i]) - 1e-9:
            yield d, i, tiles


def _finder(block: Block, min_match: int, threshold: float) -> Callable:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
    names = [x.split()[0] for x in RESULT.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in slices(batches):
            ids, rows = t.id_list(), []
            for d, i, tiles in _contaminated(block, Tokens(t), min_match, threshold):
                matched, n = sum(x[0] for x in tiles), len(block.tokens[i])
                rows.append((ids[d], block.items[i], len(tiles), matched, n, matched / n))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names)
    return run


class Blocks:
    """The benchmark in blocks of bounded size, read one at a time."""

    def __init__(self, benchmark: DataFrame, min_match: int, block_tokens: int):
        self.items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")) \
            .filter(F.col("text").isNotNull())
        self.min_match = min_match
        # a token and what parts it take two bytes at least
        total = self.items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.n = max(1, -(-total // (2 * block_tokens)))

    def __iter__(self) -> Iterator[Block]:
        part = F.pmod(F.xxhash64("item_id", "text"), F.lit(self.n))
        for b in range(self.n):
            own = self.items.filter(part == b).orderBy("item_id", "text").collect()
            yield Block.of([(r["item_id"], r["text"]) for r in own], self.min_match)


def _each_block(docs: DataFrame, blocks: Blocks, of: Callable[[Block], Callable], schema: str) -> DataFrame:
    """What ``of(block)`` finds in ``docs``, over all blocks. The results of several blocks are
    written one after the other."""
    if blocks.n == 1:
        return docs.mapInArrow(of(next(iter(blocks))), schema)
    path = fresh_path(docs.sparkSession, "benchmark-blocks")
    for k, block in enumerate(blocks):
        docs.mapInArrow(of(block), schema).write.mode("append" if k else "error").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def matches(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH,
            threshold: float = THRESHOLD, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per document and item whose tiles cover ``threshold`` of the item."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return _each_block(rows, Blocks(benchmark, min_match, block_tokens),
                       lambda block: _finder(block, min_match, threshold), RESULT)


def clean(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH,
          threshold: float = THRESHOLD, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The rows of ``docs``, all columns, that no item contaminates."""
    blocks = Blocks(benchmark, min_match, block_tokens)

    def keeper(block: Block) -> Callable:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keep = np.ones(b.num_rows, dtype=bool)
                for row, _, t in batch_slices(b):
                    for d, _, _ in _contaminated(block, Tokens(t), min_match, threshold):
                        keep[row + d] = False
                yield b.filter(pa.array(keep))
        return run

    def key_finder(block: Block) -> Callable:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in slices(batches):
                found = {d for d, _, _ in _contaminated(block, Tokens(t), min_match, threshold)}
                if found:
                    keys = [hashlib.md5(t.text(d)).hexdigest() for d in sorted(found)]
                    yield pa.RecordBatch.from_arrays([pa.array(keys)], ["_key"])
        return run
    if blocks.n == 1:
        return docs.mapInArrow(keeper(next(iter(blocks))), docs.schema)
    # a text is contaminated or not wherever it stands: texts go by their MD5
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    bad = _each_block(rows, blocks, key_finder, "_key string").distinct()
    keyed = docs.withColumn("_key", F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return keyed.join(bad, "_key", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all items of the benchmark."""
    return matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
