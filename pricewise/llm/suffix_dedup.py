"""Repeated 200-byte strings by a difference cover over suffixes, one bucket at a time.

Of any two equal 200-byte strings some shift below the cover's period of 91 puts both on
cover positions, where the next 110 bytes agree as well. So:

1. Every document's cover samples (one position in nine) are told apart by their first 110
   bytes: tied or unique. They are settled one bucket of samples at a time.
2. Only suffixes with a tied sample less than a period ahead can have a long tie. They are
   settled by their first 200 bytes, again one bucket at a time.
3. Tied suffixes mark the bytes they cover; each document is cut in its own block.

Of whole documents that are equal only the first sorts its suffixes, as tied ones: a group of
copies costs one document, however large it is.

This is not a suffix order: a sample's rank is replaced by whether its fingerprint is tied, and
a suffix's first 200 bytes by a 64-bit fingerprint. Order among unequal suffixes is not needed
for the result, and ranks by bytes would shuffle 110 bytes for each sample, twelve for each byte of
text. Buckets are ranges of fingerprints, so frequent beginnings cannot swell one. They are counted
for the samples; where most suffixes are candidates, a bucket of the second step holds up to nine
times as many. Two different strings share a key with probability 2**-64.

Defined cases: null and empty texts have no bytes; a repeated row is another place, so its
bytes go like any others; null doc_ids pass through; extra columns are not read. One document
is handled within one task (about 50 bytes of memory per byte of a text over 4 MB).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import read, text_bytes
from .cover import PERFECT, cover_positions, covered, reached
from .fingerprints import (Size, answer, answers_of, blocks_of, distinct, emit, join_answers,
                           pack_flags, pack_texts, send, several, truncated, unpack_flags,
                           unpack_texts)
from .textblock import Texts, byte_sums, range_hash

MATCH = 200
PERIOD = 91
PREFIX = MATCH - PERIOD + 1

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
HALF = f"block_id long, payload binary, {RESULT}"
_TYPES = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
_NAMES = ["block_id", "payload", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def _samples(t: Texts, bits: int) -> tuple[np.ndarray, np.ndarray]:
    at = cover_positions(PERIOD, t.starts, t.sizes, PREFIX, MATCH)
    sums = byte_sums(t.data)
    return at, truncated(range_hash(sums, at, at + PREFIX), bits)


def _suffixes(t: Texts, candidate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.nonzero(candidate)[0]
    sums = byte_sums(t.data)
    return at, range_hash(sums, at, at + MATCH)


def _whole(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Documents of at least 200 bytes, and a fingerprint of each."""
    at = np.nonzero(t.sizes >= MATCH)[0]
    sums = byte_sums(t.data)
    return at, range_hash(sums, t.starts[at], t.ends[at])


def _pack_marks(candidate: np.ndarray, copied: np.ndarray) -> bytes:
    body = pack_flags(candidate)
    return len(body).to_bytes(4, "little") + body + pack_flags(copied)


def _unpack_marks(extra: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = 4 + int.from_bytes(extra[:4], "little")
    return unpack_flags(extra[4:n]), unpack_flags(extra[n:])


def _candidates(t: Texts, tied: np.ndarray) -> np.ndarray:
    """Suffixes of at least 200 bytes with a tied sample (positions) in reach."""
    doc = t.doc_of(tied)
    out = reached(tied, t.starts[doc], PERIOD, len(t.data))
    for e in t.ends[np.unique(doc)].tolist():
        out[max(0, e - MATCH + 1):e] = False
    return out


def _subset(t: Texts, docs: np.ndarray, flags: np.ndarray) -> tuple[Texts, np.ndarray]:
    take = np.zeros(len(t.data), dtype=bool)
    for d in docs.tolist():
        take[t.starts[d]:t.ends[d]] = True
    ends = np.cumsum(t.sizes[docs])
    return Texts(t.ids[docs], t.null_id[docs], t.data[take], ends - t.sizes[docs], ends), flags[take]


def _results(t: Texts, gone: np.ndarray) -> list[tuple]:
    before = np.append(False, gone[:-1]) if len(gone) else gone
    before[t.starts[t.sizes > 0]] = False
    begins = np.append(0, np.cumsum(gone & ~before))
    total = np.append(0, np.cumsum(gone))
    out = []
    for i, doc_id in enumerate(t.id_list()):
        s, e = int(t.starts[i]), int(t.ends[i])
        removed = int(total[e] - total[s])
        kept = t.data[s:e] if not removed else t.data[s:e][~gone[s:e]]
        out.append((doc_id, e - s, removed, int(begins[e] - begins[s]),
                    hashlib.sha256(kept.tobytes()).hexdigest()))
    return out


def _table(block_id: int, rows: list[tuple], payload: bytes | None = None) -> pa.Table:
    full = [(block_id, None, *r) for r in rows]
    if payload is not None:
        full.append((block_id, payload, None, None, None, None, None))
    columns = list(zip(*full)) if full else [[]] * len(_NAMES)
    return pa.table([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_NAMES)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Per document: bytes, bytes removed, maximal removed runs, and SHA-256 of the rest."""
    assert len(PERFECT[PERIOD]) == 10
    size = Size.of(docs, text_bytes(docs), len(PERFECT[PERIOD]) / PERIOD)
    bits, buckets = size.filter_bits, size.buckets
    blocks = blocks_of(docs, size.partitions)

    def send_samples(block_id: int, payload: bytes) -> Iterator[tuple[int, int, bytes]]:
        t, _ = unpack_texts(payload)
        keys, _, n = distinct(_samples(t, bits)[1])
        yield from send(block_id, keys, bits, buckets, lambda part: pack_flags(n[part] > 1))
        whole, _, m = distinct(_whole(t)[1])
        yield from send(block_id, whole, 64, buckets, lambda part: pack_flags(m[part] > 1), buckets)

    def settle_samples(block_id: int, left: pa.Table, right: pa.Table) -> pa.Table:
        t, _ = unpack_texts(left.column("payload")[0].as_py())
        at, keys = _samples(t, bits)
        unique, place, _ = distinct(keys)
        doc, whole = _whole(t)
        same, first, which = np.unique(whole, return_index=True, return_inverse=True)
        codes = answers_of(right, len(unique) + len(same))
        copied = np.zeros(len(t), dtype=np.uint8)  # 1: the first of its copies, 2: a later one
        copied[doc] = codes[len(unique):][which]
        later = np.ones(len(doc), dtype=bool)
        later[first] = False
        copied[doc[later]] = 2
        candidate = _candidates(t, at[codes[: len(unique)][place] > 0])
        gone = np.zeros(len(t.data), dtype=bool)
        for d in np.nonzero(copied == 2)[0].tolist():
            candidate[t.starts[d]:t.ends[d]] = False
            gone[t.starts[d]:t.ends[d]] = True
        run = np.append(0, np.cumsum(candidate))
        open_docs = run[t.ends] > run[t.starts]
        rest = np.nonzero(open_docs)[0]
        payload = None
        if len(rest):
            texts, flags = _subset(t, rest, candidate)
            payload = pack_texts(texts, _pack_marks(flags, copied[rest] == 1))
        done = _subset(t, np.nonzero(~open_docs)[0], gone)
        return _table(block_id, _results(*done), payload)

    def send_suffixes(block_id: int, payload: bytes) -> Iterator[tuple[int, int, bytes]]:
        t, extra = unpack_texts(payload)
        candidate, copied = _unpack_marks(extra)
        at, keys = _suffixes(t, candidate)
        unique, place, n = distinct(keys)
        tied = (n > 1) | (np.bincount(place, weights=copied[t.doc_of(at)], minlength=len(n)) > 0)
        yield from send(block_id, unique, 64, buckets, lambda part: pack_flags(tied[part]))

    def cut(block_id: int, left: pa.Table, right: pa.Table) -> pa.Table:
        done = left.filter(left.column("payload").is_null()).select(_NAMES[2:])
        rows = []
        for payload in left.column("payload").drop_null().to_pylist():
            t, extra = unpack_texts(payload)
            at, keys = _suffixes(t, _unpack_marks(extra)[0])
            unique, place, _ = distinct(keys)
            tied = at[answers_of(right, len(unique))[place] > 0]
            rows += _results(t, covered(tied, MATCH, len(t.data)))
        return pa.concat_tables([done, _table(block_id, rows).select(_NAMES[2:])])

    ranks = answer(emit(blocks, send_samples), size, several)
    half = join_answers(blocks, ranks, settle_samples, HALF).repartition(size.partitions, "block_id")
    ties = answer(emit(half, send_suffixes), size, several)
    return join_answers(half, ties, cut, RESULT)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 200-byte strings removed from all documents."""
    return repeated_spans(read(spark, sf_dir, "documents"))


OP2_SQL = """
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h,
           CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
windows AS (
    SELECT r, i, md5(substr(h, 2 * i + 1, 400)) AS content
    FROM (SELECT r, h, unnest(range(0, n - 199)) AS i FROM docs)),
repeats AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY content) AS k FROM windows) WHERE k > 1),
breaks AS (
    SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 200 THEN 0 ELSE 1 END AS b FROM repeats),
spans AS (
    SELECT r, min(i) AS s, max(i) + 200 AS e
    FROM (SELECT r, i, sum(b) OVER (PARTITION BY r ORDER BY i) AS g FROM breaks) GROUP BY r, g),
kept AS (
    SELECT r, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS a, s AS b FROM spans
    UNION ALL SELECT d.r, coalesce(max(s.e), 0), any_value(d.n) FROM docs d LEFT JOIN spans s USING (r) GROUP BY d.r),
texts AS (
    SELECT r, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h
    FROM kept JOIN docs USING (r) GROUP BY r),
sums AS (SELECT r, sum(e - s) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(texts.h)) AS kept_sha256
FROM docs JOIN texts USING (r) LEFT JOIN sums USING (r)
"""
