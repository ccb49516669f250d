"""Exact set questions over fingerprints of all windows of all texts, as packed messages.

A corpus has far more windows than rows, so one shuffled row per window would be mostly row
overhead. Here documents travel in blocks of a few MB. A block sends each *bucket* (a range
of fingerprint values) one message with its own distinct fingerprints, sorted and
delta-coded, and the bucket answers with one small code per fingerprint. A fingerprint held
by a third of all documents is one entry per block, never one per document: the block is the
map-side combine. Nothing here is a cap: every fingerprint is sent and answered.

The stages are joined by plain Spark exchanges (block_id for texts and answers, bucket for
messages), so a lost executor only repeats its tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import power_of_two, shuffle_partitions
from .textblock import Texts, batch_slices, release

#: There is a message for each block and bucket: on executors with more memory, raise both
#: sizes with the table (a block takes some 60 times its bytes, a bucket some 50 bytes for
#: each fingerprint).
BLOCK_BYTES = 4 << 20
BUCKET_FINGERPRINTS = 1 << 21
#: Spare bits of a fingerprint that is only a filter: about one in 2**7 passes by chance.
FILTER_SPARE_BITS = 7

BLOCK_SCHEMA = "block_id long, payload binary"
MESSAGE_SCHEMA = "bucket int, block_id long, message binary"
ANSWER_SCHEMA = "block_id long, bucket int, answer binary"
MAP_BLOCKS = [pa.field("block_id", pa.int64()), pa.field("payload", pa.binary())]


# ---- packing ---------------------------------------------------------------------------

def pack_array(a: np.ndarray) -> bytes:
    """Non-negative integers as byte planes, compressed; planes of zeros are left out."""
    a = np.ascontiguousarray(a.astype("<u8"))
    planes = a.view(np.uint8).reshape(-1, 8).T
    width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
    body = zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes[:width]).tobytes())
    return len(a).to_bytes(4, "little") + bytes([width]) + len(body).to_bytes(4, "little") + body


def unpack_array(data: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    n, width = int.from_bytes(data[at:at + 4], "little"), data[at + 4]
    size = int.from_bytes(data[at + 5:at + 9], "little")
    body = zstandard.ZstdDecompressor().decompress(data[at + 9:at + 9 + size],
                                                   max_output_size=max(1, n * width))
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(body, dtype=np.uint8)[: n * width].reshape(width, n).T
    return out.view("<u8").reshape(-1).astype(np.uint64), at + 9 + size


def pack_sorted(a: np.ndarray) -> bytes:
    return pack_array(np.diff(a, prepend=np.uint64(0)))


def unpack_sorted(data: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    d, at = unpack_array(data, at)
    return np.cumsum(d, dtype=np.uint64), at


def pack_flags(flags: np.ndarray) -> bytes:
    body = zstandard.ZstdCompressor(level=1).compress(np.packbits(flags).tobytes())
    return len(flags).to_bytes(4, "little") + body


def unpack_flags(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    raw = zstandard.ZstdDecompressor().decompress(data[4:], max_output_size=n // 8 + 8)
    return np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=n).astype(bool)


def pack_texts(t: Texts, extra: bytes = b"") -> bytes:
    head = np.array([len(t), len(t.data), len(extra)], dtype="<i8").tobytes()
    raw = head + t.ids.astype("<i8").tobytes() + t.null_id.astype(np.uint8).tobytes() \
        + t.ends.astype("<i8").tobytes() + extra + t.data.tobytes()
    return zstandard.ZstdCompressor(level=3).compress(raw)


def unpack_texts(payload: bytes) -> tuple[Texts, bytes]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n, size, more = np.frombuffer(raw, dtype="<i8", count=3).tolist()
    ids = np.frombuffer(raw, dtype="<i8", count=n, offset=24)
    null = np.frombuffer(raw, dtype=np.uint8, count=n, offset=24 + 8 * n).astype(bool)
    ends = np.frombuffer(raw, dtype="<i8", count=n, offset=24 + 9 * n)
    at = 24 + 17 * n
    data = np.frombuffer(raw, dtype=np.uint8, count=size, offset=at + more)
    starts = np.concatenate([np.zeros(min(1, n), dtype=np.int64), ends[:-1]])
    return Texts(ids, null, data, starts, ends), raw[at:at + more]


# ---- sizes -----------------------------------------------------------------------------

@dataclass(frozen=True)
class Size:
    """How a table's fingerprints are dealt: buckets, and bits kept of a filter's
    fingerprints (both grow with the table, so a filter is as sharp at every size)."""
    buckets: int
    filter_bits: int
    partitions: int

    @staticmethod
    def of(docs: DataFrame, total: int, per_byte: float) -> Size:
        n = max(1.0, total * per_byte)
        parts = max(shuffle_partitions(docs.sparkSession), -(-total // (64 << 20)))
        buckets = power_of_two(max(n / BUCKET_FINGERPRINTS, 4 * min(parts, 16)))
        bits = max(16, power_of_two(n).bit_length() - 1 + FILTER_SPARE_BITS)
        return Size(min(buckets, 1 << 24), min(64, bits), int(parts))


# ---- stages ----------------------------------------------------------------------------

def blocks_of(docs: DataFrame, partitions: int) -> DataFrame:
    """Documents in compressed blocks, dealt by block_id. A block is named by its task and
    its place there, which a repeated task gives again. Both readers of the result share
    one exchange. ``docs`` should be a table scan, whose tasks give the same rows in the same
    order when they are repeated; write or checkpoint the result of a shuffle first."""
    limit = BLOCK_BYTES

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        k = 0
        for batch in batches:
            for _, _, t in batch_slices(batch, limit):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 32 | k], pa.int64()),
                     pa.array([pack_texts(t)], pa.binary())], ["block_id", "payload"])
                k += 1
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(cut, BLOCK_SCHEMA).repartition(partitions, "block_id")


def send(block_id: int, keys: np.ndarray, bits: int, buckets: int,
         aux: Callable[[slice], bytes] | None = None, base: int = 0
         ) -> Iterator[tuple[int, int, bytes]]:
    """Messages of one block: distinct sorted ``keys`` (the top ``bits`` count) by bucket.
    ``aux(part)`` adds what the decision needs to know of those keys. Keys of another kind
    go to buckets of their own, from ``base`` on."""
    if not len(keys):
        return
    shift = np.uint64(64 - (buckets.bit_length() - 1)) if buckets > 1 else None
    of = (keys >> shift).astype(np.int64) if buckets > 1 else np.zeros(len(keys), dtype=np.int64)
    cut = np.nonzero(np.append(True, of[1:] != of[:-1]))[0]
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(keys)]):
        body = pack_sorted(keys[a:b] >> np.uint64(64 - bits))
        yield base + int(of[a]), block_id, body + (aux(slice(a, b)) if aux else b"")


def truncated(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys >> np.uint64(64 - bits) << np.uint64(64 - bits)


def message_batches(rows: Iterable[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[2]) + 32
        if size >= 1 << 20:
            yield _messages(held)
            held, size = [], 0
    if held:
        yield _messages(held)


def _messages(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    b, i, m = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(b, pa.int32()), pa.array(i, pa.int64()), pa.array(m, pa.binary())],
        ["bucket", "block_id", "message"])


def emit(blocks: DataFrame, of_block: Callable[[int, bytes], Iterable[tuple[int, int, bytes]]]
         ) -> DataFrame:
    """Messages of all blocks: ``of_block(block_id, payload)`` gives those of one."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, bytes]]:
            for b in batches:
                for i, p in zip(b.column("block_id"), b.column("payload")):
                    if p.is_valid:
                        yield from of_block(i.as_py(), p.as_py())
                        release(BLOCK_BYTES)
        yield from message_batches(rows())
    return blocks.mapInArrow(run, MESSAGE_SCHEMA)


Decide = Callable[[np.ndarray, np.ndarray, np.ndarray, list[bytes]], np.ndarray]


def answer(messages: DataFrame, size: Size, decide: Decide) -> DataFrame:
    """One bucket at a time: sort its fingerprints together, decide each entry, and answer
    every block. ``decide(order, group, source, aux)`` gets the sorting order of all entries,
    the number of each sorted entry's group of equals, each entry's source message and the
    messages' aux bytes; it gives a uint8 code per entry, in the entries' own order."""
    def run(table: pa.Table) -> pa.Table:
        block_ids = table.column("block_id").to_pylist()
        by = sorted(range(len(block_ids)), key=block_ids.__getitem__)  # arrival order is not fixed
        arrays, aux = [], []
        for i in by:
            m = table.column("message")[i].as_py()
            a, at = unpack_sorted(m)
            arrays.append(a)
            aux.append(m[at:])
        lengths = np.array([len(a) for a in arrays])
        keys = np.concatenate(arrays)
        order = np.argsort(keys, kind="stable")
        group = np.cumsum(np.append(True, keys[order][1:] != keys[order][:-1])) - 1
        source = np.repeat(np.arange(len(arrays)), lengths)
        codes = decide(order, group, source, aux).astype(np.uint8)
        ends = np.cumsum(lengths)
        out = [zstandard.ZstdCompressor(level=3).compress(codes[e - n:e].tobytes())
               for e, n in zip(ends.tolist(), lengths.tolist())]
        return pa.table([pa.array([block_ids[i] for i in by], pa.int64()),
                         pa.array([table.column("bucket")[0].as_py()] * len(by), pa.int32()),
                         pa.array(out, pa.binary())], names=["block_id", "bucket", "answer"])
    return messages.groupBy("bucket").applyInArrow(run, ANSWER_SCHEMA)


def answers_of(table: pa.Table, n: int) -> np.ndarray:
    """The codes of a block's ``n`` fingerprints, in their order."""
    rows = sorted(zip(table.column("bucket").to_pylist(), table.column("answer").to_pylist()))
    raw = b"".join(zstandard.ZstdDecompressor().decompress(a) for _, a in rows)
    if len(raw) != n:
        raise ValueError(f"{len(raw)} answers for {n} fingerprints")
    return np.frombuffer(raw, dtype=np.uint8)


def join_answers(blocks: DataFrame, answers: DataFrame,
                 finish: Callable[[int, pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``finish(block_id, rows of the block, answers to its messages)`` for each block."""
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = finish(key[0].as_py(), left, right)
        release(BLOCK_BYTES)
        return out
    return blocks.groupBy("block_id").cogroup(answers.groupBy("block_id")).applyInArrow(run, schema)


def several(order: np.ndarray, group: np.ndarray, source: np.ndarray, aux: list[bytes]) -> np.ndarray:
    """Decision: 0 for fingerprints that one block sent once; of others, 1 for the first
    block that sent it and 2 for the rest."""
    flags = np.concatenate([unpack_flags(a) for a in aux])[order]
    found = (np.bincount(group) > 1) | (np.bincount(group, weights=flags) > 0)
    first = np.append(True, group[1:] != group[:-1])  # entries are in order of their sources
    out = np.zeros(len(order), dtype=np.uint8)
    out[order] = np.where(found[group], np.where(first, 1, 2), 0)
    return out


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, each entry's place among them, and how often each occurs."""
    return np.unique(keys, return_inverse=True, return_counts=True)
