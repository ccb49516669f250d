"""Vectorised helpers over a run of texts held as one UTF-8 byte array.

Arrow hands a batch of texts to a task as one byte buffer with offsets, so words,
lines and windows of many documents are found and hashed with a few array
operations. Work goes in slices of bounded size whatever Arrow's batch size is.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
#: Entries that a running sum takes in one go, to keep its temporary arrays small.
CHUNK = 1 << 18
NEWLINE = 10
#: Word separators: space and the five control characters 0x09-0x0D.
SEPARATOR = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: A Python worker gives free memory back after so many bytes of texts.
RELEASE_BYTES = 16 << 20
_seen = [0]
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 5
_TABLE = np.random.default_rng(20240607).integers(1, 2**64, 256, dtype=np.uint64)
_TABLE_2 = np.random.default_rng(20240608).integers(1, 2**64, 256, dtype=np.uint64)
_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def release(n: int) -> None:
    """Say that ``n`` bytes of texts are done with. Workers are used again by later stages, so
    what the allocators keep would add up over an executor."""
    _seen[0] += n
    if _seen[0] >= RELEASE_BYTES:
        _seen[0] = 0
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
        if trim is not None:
            trim(0)


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``B**i`` and ``B**-i`` modulo 2**64 for i below n or more."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = -(-n // CHUNK) * CHUNK
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            t = np.full(size, _U(base))
            t[0] = 1
            _powers[name] = np.cumprod(t, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def prefix_sums(values: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """Running sums of ``values[i] * B**i`` with a leading zero; with a ``table``, of
    ``table[values[i]] * B**i``."""
    n = len(values)
    up, _ = _power_table(n + 1)
    out = np.zeros(n + 1, dtype=np.uint64)
    for a in range(0, n, CHUNK):
        part = values[a:a + CHUNK]
        part = (table[part] if table is not None else part) * up[a:a + len(part)]
        np.cumsum(part, out=out[a + 1:a + 1 + len(part)])
        out[a + 1:a + 1 + len(part)] += out[a]
    return out


def byte_sums(data: np.ndarray, second: bool = False) -> np.ndarray:
    """Running sums over a random 64-bit value per byte; ``second`` is independent of the
    first."""
    return prefix_sums(data, _TABLE_2 if second else _TABLE)


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each range [start, end), the same wherever the content stands."""
    _, down = _power_table(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def ascii_lower(data: np.ndarray) -> np.ndarray:
    return _ASCII_LOWER[data]


@dataclass
class Texts:
    """Texts of a few documents: bytes end to end, and where each begins and ends."""
    ids: np.ndarray      # int64
    null_id: np.ndarray  # bool
    data: np.ndarray     # uint8
    starts: np.ndarray   # int64
    ends: np.ndarray     # int64

    def __len__(self) -> int:
        return len(self.ids)

    @property
    def sizes(self) -> np.ndarray:
        return self.ends - self.starts

    def id_list(self) -> list:
        return [None if n else int(i) for i, n in zip(self.ids, self.null_id)]

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        """Document (index) of each byte position."""
        full = np.nonzero(self.sizes > 0)[0]
        return full[np.searchsorted(self.starts[full], positions, side="right") - 1]

    def words(self, separator: np.ndarray = SEPARATOR
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and end of every word, and the index of its document. ``separator`` tells
        for each byte value whether it parts words."""
        n = len(self.data)
        if not n:
            z = np.zeros(0, dtype=np.int64)
            return z, z, z
        word = ~separator[self.data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.starts[self.sizes > 0]] = True
        edge[n] = True
        first = word.copy()
        first[1:] &= ~word[:-1] | edge[1:n]
        last = word.copy()
        last[:-1] &= ~word[1:] | edge[1:n]
        begin = np.nonzero(first)[0]
        return begin, np.nonzero(last)[0] + 1, self.doc_of(begin)


    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and end of every line (\\n ends one, and an empty text is one line), and the
        index of its document, in order."""
        newline = np.nonzero(self.data == NEWLINE)[0]
        begin = np.concatenate([self.starts, newline + 1])
        doc = np.concatenate([np.arange(len(self)), self.doc_of(newline) if len(newline) else newline])
        order = np.lexsort((begin, doc))
        begin, doc = begin[order], doc[order]
        more = np.append(doc[1:] == doc[:-1], False)[: len(doc)]
        end = np.where(more, np.append(begin[1:], 0)[: len(doc)] - 1, self.ends[doc])
        return begin, end, doc


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an Arrow string column (null texts are empty)."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    buf = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    return off, buf


def id_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    null = np.asarray(column.is_null().to_numpy(zero_copy_only=False), dtype=bool)
    ids = column.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
    return ids.astype(np.int64), null


def batch_slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES, rows: int = 1 << 20
                 ) -> Iterator[tuple[int, int, Texts]]:
    """(first row, end row, texts) for slices of a batch with columns doc_id and text.
    A slice holds at most ``rows`` documents and ``limit`` bytes, or one longer document."""
    if not batch.num_rows:
        return
    off, buf = text_buffer(batch.column("text"))
    ids, null = id_arrays(batch.column("doc_id"))
    row, n = 0, batch.num_rows
    while row < n:
        end = int(np.searchsorted(off, off[row] + limit, side="right")) - 1
        end = min(n, row + rows, max(row + 1, end))
        data = buf[off[row]:off[end]]
        rel = off[row:end + 1] - off[row]
        yield row, end, Texts(ids[row:end], null[row:end], data, rel[:-1], rel[1:])
        release(int(off[end] - off[row]))
        row = end


def slices(batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[Texts]:
    for batch in batches:
        for _, _, texts in batch_slices(batch, limit):
            yield texts
