"""Best-two-fit packing of tokenized documents into fixed-length sequences.

Bins are planned on the histogram of piece lengths, which has at most ``capacity`` entries
whatever the corpus holds: a bin is filled greedily (longest piece that fits), then its
smallest piece is replaced by two unpacked pieces that fill the widened gap more tightly, as
long as that helps. A bin's make-up is repeated as often as the histogram allows, so a plan has
a few thousand patterns at most. Pieces find their place by their rank among the pieces of
their length: counted per task, shifted by the counts of the tasks before, so no length,
however frequent, passes through one task.

A document's tokens are its text's ids and an end id. Documents over ``capacity`` are cut
into pieces of exactly ``capacity``, of which the first takes the remainder.

Defined cases: a null or empty text is the end id alone; repeated rows are packed each; null
doc_ids pass through; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpoint, read

CAPACITY = 1024
END_ID = 2

_SPECIAL = "<|endoftext|>"
_LONG_SPACE = re.compile(r"\s{1000}")
_encoders: dict[tuple, Encoder] = {}


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def ranks_path() -> str:
    """The same vocabulary as merge ranks."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    The vocabulary file defines them. Where the same vocabulary is given as ranks, ordinary
    texts go the faster way; the ids are equal (compared for every token of the vocabulary
    and every code point). Texts with a special token's string or very long runs of white
    space always go by the vocabulary file."""

    def __init__(self, path: str, ranks: str | None):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.fast = None
        if ranks:
            import public_tokenizers
            import tiktoken
            with open(ranks, "rb") as f:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                          mergeable_ranks=table, special_tokens={})

    @staticmethod
    def of(path: str, ranks: str | None) -> Encoder:
        if (path, ranks) not in _encoders:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
            _encoders[path, ranks] = Encoder(path, ranks)
        return _encoders[path, ranks]

    def encode(self, text: str) -> bytes:
        if self.fast is None or _SPECIAL in text or _LONG_SPACE.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, dtype="<u4").tobytes()
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    first = n % capacity or capacity
    if n <= capacity:
        return [(0, n)]
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _tokenizer(path: str, ranks: str | None, capacity: int, end_id: int, keep_ids: bool) -> Callable:
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "place"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = Encoder.of(path, ranks), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        end = np.array([end_id], dtype="<u4").tobytes()

        def batch(rows: list[tuple], ids: list[bytes]) -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            if not keep_ids:
                return pa.RecordBatch.from_arrays(columns, names)
            flat = np.frombuffer(b"".join(ids), dtype="<i4")
            offsets = np.append(0, np.cumsum([len(i) // 4 for i in ids])).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [*columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                [*names, "ids"])

        for b in batches:
            rows, ids, size = [], [], 0
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                whole = encoder.encode(text.as_py() or "") + end
                for k, (start, length) in enumerate(cut(len(whole) // 4, capacity)):
                    part = whole[4 * start:4 * (start + length)]
                    rows.append((doc_id, k, start, length, zlib.crc32(part), task, int(seen[length])))
                    seen[length] += 1
                    if keep_ids:
                        ids.append(part)
                        size += len(part)
                if size > 4 << 20:
                    yield batch(rows, ids)
                    rows, ids, size = [], [], 0
            if rows:
                yield batch(rows, ids)
    return run


def pieces_of(docs: DataFrame, path: str, ranks: str | None, capacity: int = CAPACITY,
              end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents; ``place`` counts a task's pieces of the same length."""
    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long, task int, place long"
              + (", ids array<int>" if keep_ids else ""))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_tokenizer(path, ranks, capacity, end_id, keep_ids), schema)


def _best_two(count: np.ndarray, low: int, room: int) -> tuple[int, int] | None:
    """Two available lengths whose sum is the largest above ``low`` and at most ``room``."""
    have = count > 0
    for total in range(min(room, 2 * (len(count) - 1)), low, -1):
        a = np.arange(max(1, total - len(count) + 1), total // 2 + 1)
        fit = have[a] & have[total - a] & ((a * 2 != total) | (count[a] > 1))
        if fit.any():
            small = int(a[fit][0])
            return total - small, small
    return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths of a bin, how many such bins): every piece of the histogram is placed."""
    count = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        count[length] += n
    out: list[tuple[list[int], int]] = []
    while count.any():
        bin_, gap = [], capacity

        def take(length: int) -> None:
            nonlocal gap
            bin_.append(length)
            count[length] -= 1
            gap -= length

        while gap:
            fits = np.nonzero(count[: gap + 1])[0]
            if not len(fits):
                break
            take(int(fits[-1]))
        while gap and len(bin_) > 1:
            smallest = min(bin_)
            two = _best_two(count, smallest, gap + smallest)
            if two is None:
                break
            bin_.remove(smallest)
            count[smallest] += 1
            gap += smallest
            for length in two:
                take(length)
        used = np.bincount(bin_, minlength=capacity + 1)
        on = np.nonzero(used)[0]
        times = 1 + int((count[on] // used[on]).min())
        count[on] -= used[on] * (times - 1)
        out.append((sorted(bin_, reverse=True), times))
    return out


def _slots(bins: list[tuple[list[int], int]], capacity: int) -> list[np.ndarray]:
    """By length: rows (first rank, first sequence, offset), in order of rank."""
    slots: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]
    rank = [0] * (capacity + 1)
    sequence = 0
    for lengths, times in bins:
        offset = 0
        for length in lengths:
            slots[length].append((rank[length], sequence, offset))
            rank[length] += times
            offset += length
        sequence += times
    return [np.array(s, dtype=np.int64).reshape(-1, 3) for s in slots]


def _placer(slots: list[np.ndarray]) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column("length").to_numpy()
            rank = b.column("rank").to_numpy()
            sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
            for n in np.unique(length).tolist():
                at = np.nonzero(length == n)[0]
                row = slots[n][np.searchsorted(slots[n][:, 0], rank[at], side="right") - 1]
                sequence[at] = row[:, 1] + rank[at] - row[:, 0]
                offset[at] = row[:, 2]
            names = [n for n in b.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(n) for n in names), pa.array(sequence), pa.array(offset)],
                [*names, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
         end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and
    the ids, if asked for). Sequences are gapless from offset 0. ``path`` is a vocabulary
    file; the default has its ranks file beside it."""
    ranks = ranks_path() if path is None else None
    pieces = checkpoint(pieces_of(docs, path or vocabulary_path(), ranks, capacity, end_id, keep_ids))
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("length", "task",
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    histogram = {r["length"]: r["n"] for r in
                 counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row a length
    slots = _slots(plan(histogram, capacity), capacity)
    ranked = pieces.join(shift, ["length", "task"]).withColumn("rank", F.col("place") + F.col("shift"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long"
              + (", ids array<int>" if keep_ids else "") + ", sequence_id long, offset long")
    return ranked.select(*columns, "rank").mapInArrow(_placer(slots), schema)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return pack(read(spark, sf_dir, "documents"))
