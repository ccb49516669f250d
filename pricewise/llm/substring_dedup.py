"""Repeated 13-word windows by difference-cover anchors.

Any two equal 13-word windows share, at a shift below the period of 7, a pair of anchors:
7-word windows that both documents hash at cover positions (three positions in seven). Only
anchors that two documents hold can belong to a match; they are extended to the 13-word
windows around them, and each such window asks for the smallest document that holds it.

Words are ``[^\\x20\\x09-\\x0D]+``. A word goes if it lies in a window whose words also start in
a document with a smaller doc_id; windows are judged on the input.

Defined cases: null and empty texts have no words; rows with the same doc_id are one document
(they don't remove each other); rows without doc_id are one document that comes last; extra
columns are not read. One document is handled within one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import read, text_bytes
from .cover import PERFECT, cover_positions, covered, reached
from .fingerprints import (Size, answer, answers_of, blocks_of, distinct, emit, join_answers,
                           pack_array, pack_flags, pack_sorted, pack_texts, send, several,
                           truncated, unpack_array, unpack_flags, unpack_sorted, unpack_texts)
from .textblock import Texts, byte_sums, prefix_sums, range_hash

WINDOW = 13
PERIOD = 7
ANCHOR = WINDOW - PERIOD + 1
#: Words per byte of text, for sizing only.
WORDS_PER_BYTE = 1 / 6

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
HALF = f"block_id long, payload binary, {RESULT}"
_TYPES = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
_NAMES = ["block_id", "payload", "doc_id", "n_words", "n_removed", "kept_sha256"]


class Words:
    """Word hashes of a block, and each document's run of words."""

    def __init__(self, t: Texts):
        begin, end, self.doc = t.words()
        sums = byte_sums(t.data)
        self.sums = prefix_sums(range_hash(sums, begin, end))
        self.size = np.bincount(self.doc, minlength=len(t))
        self.first = np.cumsum(self.size) - self.size
        self.n = len(begin)

    def windows(self, at: np.ndarray, length: int) -> np.ndarray:
        return range_hash(self.sums, at, at + length)

    def anchors(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        at = cover_positions(PERIOD, self.first, self.size, ANCHOR, WINDOW)
        return at, truncated(self.windows(at, ANCHOR), bits)


def id_order(t: Texts) -> np.ndarray:
    """doc_ids as unsigned integers of the same order; null comes last."""
    return np.where(t.null_id, np.uint64(2**64 - 1),
                    t.ids.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63))


def smallest_and_spread(place: np.ndarray, n: int, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per distinct key (``place``): the smallest document, and whether there are several."""
    low = np.full(n, np.uint64(2**64 - 1))
    np.minimum.at(low, place, who)
    high = np.zeros(n, dtype=np.uint64)
    np.maximum.at(high, place, who)
    return low, high > low


def _results(t: Texts, w: Words, gone: np.ndarray | None) -> list[tuple]:
    out = []
    for i, doc_id in enumerate(t.id_list()):
        words = t.text(i).split()
        removed = 0
        if gone is not None:
            flags = gone[w.first[i]:w.first[i] + w.size[i]]
            removed = int(flags.sum())
            if removed:
                words = list(compress(words, (~flags).tolist()))
        out.append((doc_id, int(w.size[i]), removed, hashlib.sha256(b" ".join(words)).hexdigest()))
    return out


def _table(block_id: int, rows: list[tuple], payload: bytes | None = None) -> pa.Table:
    full = [(block_id, None, *r) for r in rows]
    if payload is not None:
        full.append((block_id, payload, None, None, None, None))
    columns = list(zip(*full)) if full else [[]] * len(_NAMES)
    return pa.table([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_NAMES)


def subset(t: Texts, docs: np.ndarray) -> Texts:
    take = np.zeros(len(t.data), dtype=bool)
    for d in docs.tolist():
        take[t.starts[d]:t.ends[d]] = True
    ends = np.cumsum(t.sizes[docs])
    return Texts(t.ids[docs], t.null_id[docs], t.data[take], ends - t.sizes[docs], ends)


def earlier_elsewhere(order: np.ndarray, group: np.ndarray, source: np.ndarray,
                      aux: list[bytes]) -> np.ndarray:
    """Decision: 1 where another block holds the window in a smaller document."""
    owners = []
    for a in aux:
        ids, at = unpack_sorted(a)
        index, _ = unpack_array(a, at)
        owners.append(ids[index.astype(np.int64)])
    owner = np.concatenate(owners)[order]
    starts = np.nonzero(np.append(True, group[1:] != group[:-1]))[0]
    low = np.minimum.reduceat(owner, starts)
    out = np.zeros(len(order), dtype=np.uint8)
    out[order] = owner > low[group]
    return out


def _owners(low: np.ndarray) -> bytes:
    ids, index = np.unique(low, return_inverse=True)
    return pack_sorted(ids) + pack_array(index)


def repeated_windows(docs: DataFrame) -> DataFrame:
    """Per document: words, words removed, and SHA-256 of the kept words."""
    size = Size.of(docs, text_bytes(docs), WORDS_PER_BYTE * len(PERFECT[PERIOD]) / PERIOD)
    bits, buckets = size.filter_bits, size.buckets
    blocks = blocks_of(docs, size.partitions)

    def send_anchors(block_id: int, payload: bytes) -> Iterator[tuple[int, int, bytes]]:
        t, _ = unpack_texts(payload)
        w = Words(t)
        at, keys = w.anchors(bits)
        unique, place, _ = distinct(keys)
        _, shared = smallest_and_spread(place, len(unique), id_order(t)[w.doc[at]])
        yield from send(block_id, unique, bits, buckets, lambda part: pack_flags(shared[part]))

    def settle_anchors(block_id: int, left: pa.Table, right: pa.Table) -> pa.Table:
        t, _ = unpack_texts(left.column("payload")[0].as_py())
        w = Words(t)
        at, keys = w.anchors(bits)
        unique, place, _ = distinct(keys)
        hit = at[answers_of(right, len(unique))[place] > 0]
        candidate = reached(hit, w.first[w.doc[hit]], PERIOD, w.n)
        last = w.first + w.size
        for e in last[np.unique(w.doc[hit])].tolist():
            candidate[max(0, e - WINDOW + 1):e] = False
        run = np.append(0, np.cumsum(candidate))
        open_docs = run[last] > run[w.first]
        keep = np.nonzero(open_docs)[0]
        done = subset(t, np.nonzero(~open_docs)[0])
        payload = None
        if len(keep):
            flags = candidate[np.repeat(open_docs, w.size)]
            payload = pack_texts(subset(t, keep), pack_flags(flags))
        return _table(block_id, _results(done, Words(done), None), payload)

    def _windows(payload: bytes) -> tuple:
        t, extra = unpack_texts(payload)
        w = Words(t)
        at = np.nonzero(unpack_flags(extra))[0]
        unique, place, _ = distinct(w.windows(at, WINDOW))
        who = id_order(t)[w.doc[at]]
        low, _ = smallest_and_spread(place, len(unique), who)
        return t, w, at, unique, place, who, low

    def send_windows(block_id: int, payload: bytes) -> Iterator[tuple[int, int, bytes]]:
        _, _, _, unique, _, _, low = _windows(payload)
        yield from send(block_id, unique, 64, buckets, lambda part: _owners(low[part]))

    def cut(block_id: int, left: pa.Table, right: pa.Table) -> pa.Table:
        done = left.filter(left.column("payload").is_null()).select(_NAMES[2:])
        rows = []
        for payload in left.column("payload").drop_null().to_pylist():
            t, w, at, unique, place, who, low = _windows(payload)
            gone = (answers_of(right, len(unique))[place] > 0) | (who > low[place])
            rows += _results(t, w, covered(at[gone], WINDOW, w.n))
        return pa.concat_tables([done, _table(block_id, rows).select(_NAMES[2:])])

    anchors = answer(emit(blocks, send_anchors), size, several)
    half = join_answers(blocks, anchors, settle_anchors, HALF).repartition(size.partitions, "block_id")
    windows = answer(emit(half, send_windows), size, earlier_elsewhere)
    return join_answers(half, windows, cut, RESULT)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 13-word windows removed from all documents."""
    return repeated_windows(read(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
    SELECT r, doc_id, i, array_to_string(words[i:i + 12], ' ') AS content
    FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM docs)),
firsts AS (SELECT content, min(doc_id) AS first FROM windows GROUP BY content),
hits AS (SELECT r, i FROM windows JOIN firsts USING (content) WHERE first < doc_id),
gone AS (SELECT DISTINCT r, i + k AS place FROM (SELECT r, i, unnest(range(0, 13)) AS k FROM hits)),
words AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM docs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY place) AS text FROM words ANTI JOIN gone USING (r, place)
         GROUP BY r),
removed AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(removed.n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r) LEFT JOIN removed USING (r)
"""
