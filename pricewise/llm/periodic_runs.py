"""Periodic runs of words, found by minimizers at several scales.

A run is a stretch of consecutive words with smallest period q, at least ``max(6, 4 * q)`` words
long, that can't be extended to either side with that period.

* Periods up to ``SHORT`` are found by direct scans: words equal to the word one lag before.
* For periods in (w/2, w], w a power of two, take the hash of the w words from each position
  and the minima of all windows of w/2 positions. Inside a run the windows repeat at the
  distance of the period, so their minima do; w words are at least a period, so the next equal
  minimizer lies at the smallest period exactly (Fine and Wilf). Of each minimizer only the
  next equal one is paired: seeds are never more than positions.
* A seed is extended to both sides by a binary search over range hashes. Of stretches with
  the same ends the smallest period stays.

Words of several documents are handled together; a word's number holds its document's, so
nothing matches across documents. All is within a document: no shuffle, and memory in
proportion to a slice (``textblock.SLICE_BYTES``) or one longer text.

Words compare by 64-bit hashes.

Defined cases: a null or empty text, or one without words, has no run and collapses to an
empty text; repeated rows and null doc_ids are results of their own; extra columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .textblock import Texts, batch_slices, byte_sums, mix, prefix_sums, range_hash

LEAST, EXPONENT = 6, 4
#: Periods up to this are found by direct lag scans; a power of two.
SHORT = 8
RESULT = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretches of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], equal.view(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _sliding(a: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every ``width`` neighbours (a power of two)."""
    step = 1
    while step < width:
        a = pick(a[:-step], a[step:])
        step *= 2
    return a


def minimizers(key: np.ndarray, width: int) -> np.ndarray:
    """Positions that are the minimum of some ``width`` neighbouring positions (ties all are)."""
    if len(key) < width:
        return np.zeros(0, dtype=np.int64)
    low = _sliding(key, width, np.minimum)
    # the windows that hold a position begin at it or up to width - 1 before
    wide = np.concatenate([np.zeros(width - 1, key.dtype), low, np.zeros(width - 1, key.dtype)])
    return np.flatnonzero(_sliding(wide, width, np.maximum) == key)


def _common(sums: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """How far the words from ``a`` and ``b`` on (or before them) are the same."""
    low, high = np.zeros_like(a), most.copy()
    while (low < high).any():
        mid = (low + high + 1) // 2
        x, y = (a - mid, b - mid) if back else (a, b)
        same = range_hash(sums, x, x + mid) == range_hash(sums, y, y + mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def find_runs(words: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and period. ``words`` are 64-bit values of
    several documents' words end to end, ``size`` the documents' numbers of words; starts count
    over all of them."""
    doc = np.repeat(np.arange(len(size)), size)
    x = mix(words ^ mix(doc.astype(np.uint64) + np.uint64(1)))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def keep(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        long = end - start >= np.maximum(LEAST, EXPONENT * period)
        found.append((start[long], end[long], period[long]))

    for q in range(1, min(SHORT, len(x) - 1) + 1):
        a, b = _stretches(x[q:] == x[:-q])
        keep(a, b + q, np.full(len(a), q))
    w = 2 * SHORT
    where = np.arange(len(x))  # places of x in the whole
    while True:
        # documents too short for this scale's least period leave
        stay = size >= EXPONENT * (w // 2 + 1)
        x, where, size = x[np.repeat(stay, size)], where[np.repeat(stay, size)], size[stay]
        if not len(x):
            break
        sums = prefix_sums(x)
        at = np.arange(len(x) - w + 1)
        key = range_hash(sums, at, at + w)
        p = minimizers(key, w // 2)
        p = p[np.argsort(key[p], kind="stable")]
        a, b = p[:-1], p[1:]
        period = b - a
        seed = (key[a] == key[b]) & (period > w // 2) & (period <= w)
        a, period = a[seed], period[seed]
        b = a + period
        left = _common(sums, a, b, a, True)
        right = _common(sums, a, b, len(x) - b, False)
        keep(where[a - left], where[b + right - 1] + 1, period)
        w *= 2
    start, end, period = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))[:len(start)]
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], (end - start)[order], period[order]


def _ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    return np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


def _joined(t: Texts, begin: np.ndarray, end: np.ndarray, doc: np.ndarray) -> pa.Array:
    """Each document's words, joined by one space."""
    last = np.append(doc[1:] != doc[:-1], True)[:len(doc)]
    n = end - begin + ~last
    out = np.full(int(n.sum()), 32, dtype=np.uint8)
    place = np.cumsum(n) - n
    out[_ranges(place, end - begin)] = t.data[_ranges(begin, end - begin)]
    size = np.bincount(doc, weights=n, minlength=len(t)).astype(np.int64)
    offsets = np.append(0, np.cumsum(size))
    return pa.Array.from_buffers(pa.large_string(), len(t), [
        None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes())]).cast(pa.string())


def _slice_runs(t: Texts) -> list[pa.Array]:
    """Runs and collapsed texts of a slice's documents."""
    begin, end, doc = t.words()
    size = np.bincount(doc, minlength=len(t)).astype(np.int64)
    start, length, period = find_runs(range_hash(byte_sums(t.data), begin, end), size)
    gone = np.zeros(len(doc) + 1, dtype=np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, start + length, -1)
    kept = np.cumsum(gone)[:-1] == 0
    first = np.cumsum(size) - size
    of = doc[start] if len(start) else start
    runs = pa.StructArray.from_arrays([pa.array(start - first[of]), pa.array(length), pa.array(period)],
                                      ["start", "length", "period"])
    offsets = np.append(0, np.cumsum(np.bincount(of, minlength=len(t)))).astype(np.int32)
    return [pa.ListArray.from_arrays(pa.array(offsets), runs),
            _joined(t, begin[kept], end[kept], doc[kept])]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, its runs by start and period, and its words without those
    that a run holds after its first period, joined by one space."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, t in batch_slices(b):
                yield pa.RecordBatch.from_arrays([pa.array(t.ids, mask=t.null_id), *_slice_runs(t)],
                                                 ["doc_id", "runs", "collapsed"])
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, RESULT)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in one document of ten (h = crc32 of the doc_id as text, h mod 10 = 0) the
    words from a = g mod n on repeat with period 1 + floor((n - a) / (3 + g mod 8)), where
    g = floor(h / 10); other texts, and rows without doc_id, stay."""
    doc_id = F.col("doc_id").cast("long")
    h = F.crc32(doc_id.cast("string"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    rows = docs.select(doc_id.alias("doc_id"), F.col("text").cast("string").alias("text"), F.floor(h / 10).alias("g"),
                       F.when(chosen, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))).alias("words"))
    n = F.size("words")
    a = F.col("g") % n
    period = 1 + F.floor((n - a) / (3 + F.col("g") % 8))
    place = F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1),
                        lambda i: F.when(i < a, i).otherwise(a + (i - a) % period))
    repeated = F.array_join(F.transform(place, lambda i: F.col("words")[i]), " ")
    return rows.select("doc_id", F.when(n > 0, repeated).otherwise(F.col("text")).alias("text"))


def _longer(x: Column, y: Column) -> Column:
    """Order by exponent, longest first, then start, then period."""
    a, b = x["length"] * y["period"], y["length"] * x["period"]
    return F.when(a != b, F.when(a > b, -1).otherwise(1)) \
        .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1)) \
        .otherwise(F.when(x["period"] < y["period"], -1).otherwise(F.when(x["period"] > y["period"], 1).otherwise(0)))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, with runs planted in a tenth of them."""
    rows = periodic_runs(with_planted_runs(read(spark, sf_dir, "documents")))
    best = F.get(F.array_sort("runs", _longer), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return rows.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))


#: A run of period q >= 4 has 12 words at its start that stand again q words later (3q >= 12),
#: so such pairs name every period to scan in a document; periods 1 to 3 are scanned in all.
OP12_SQL = r"""
WITH raw AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
hashed AS (
    SELECT r, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
               string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda s, b: list_reduce(list_prepend(xor(s, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
               lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS h
    FROM raw WHERE doc_id IS NOT NULL),
sized AS (SELECT raw.*, CAST(len(words) AS BIGINT) AS n, h, h // 10 AS g FROM raw LEFT JOIN hashed USING (r)),
marked AS (
    SELECT r, doc_id, words, n, coalesce(h % 10 = 0, false) AS chosen, CASE WHEN n > 0 THEN g % n END AS a, g FROM sized),
periods AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM marked),
words AS (
    SELECT r, n, i, words[1 + CASE WHEN chosen AND i >= a THEN a + (i - a) % p ELSE i END] AS word
    FROM (SELECT *, unnest(range(0, n)) AS i FROM periods)),
docs AS (SELECT r, n, list(word ORDER BY i) AS words FROM words GROUP BY r, n),
grams AS (
    SELECT r, n, i, array_to_string(words[i + 1:i + 12], ' ') AS gram
    FROM (SELECT r, n, words, unnest(range(0, n - 11)) AS i FROM docs WHERE n >= 16)),
lags AS (
    SELECT r, unnest([1, 2, 3])::BIGINT AS q FROM docs
    UNION SELECT x.r, y.i - x.i FROM grams x JOIN grams y ON x.r = y.r AND x.gram = y.gram
    WHERE y.i - x.i >= 4 AND 4 * (y.i - x.i) <= x.n),
equal AS (
    SELECT l.r, l.q, x.i FROM lags l JOIN words x ON x.r = l.r JOIN words y ON y.r = l.r AND y.i = x.i + l.q
    WHERE x.word = y.word),
stretches AS (
    SELECT r, q, min(i) AS s, count(*) + q AS len
    FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM equal)
    GROUP BY r, q, island),
runs AS (SELECT r, s, len, min(q) AS q FROM stretches WHERE len >= greatest(6, 4 * q) GROUP BY r, s, len),
best AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY len / q DESC, s, q) AS place FROM runs)
    WHERE place = 1),
listed AS (
    SELECT r, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS text
    FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + len)) AS i FROM runs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.len AS length, best.q AS period,
       CAST(1000 * best.len // best.q AS BIGINT) AS exponent_milli,
       sha256(coalesce(listed.text, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM raw LEFT JOIN best USING (r) LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""
