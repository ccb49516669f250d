"""Alignment of two tokenizers' tokens over the same bytes, by galloping intersection.

A document is encoded by A (byte-level BPE, space + text) and by B (SentencePiece, which adds the
space itself). Of the two lists of byte offsets at which tokens end, the shorter one drives: each
of its ends looks for the first end not below it in the longer list, by exponential steps from
the place of an earlier end and a binary search in the last step. Its lanes gallop together: the
ends at odd multiples of a stride start from the places of the even ones, stride by stride.
Equal ends cut both token lists into *groups*; differences of the places are the ranges of
longer-list tokens that each shorter-list token overlaps.

*Links* are all pairs of A and B token occurrences of a group. The count of an id pair is the
number of documents that hold it linked; it sums over the whole corpus. A document's distinct
pairs travel once, in blocks; a block sends each of its pairs once, with the number of its
documents that hold it, and asks for the pair's count. For one A id there are at most as many
pairs as B has ids.

Defined cases: null and empty texts, and texts that the joined tokens' bytes of A or of B don't
reproduce, have no tokens: zeros and an empty digest; special tokens' strings in texts are
plain text; repeated rows and null doc_ids are documents of their own; an empty table gives no
rows; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import power_of_two, read, shuffle_partitions, text_bytes
from .fingerprints import pack_array, pack_sorted, unpack_array, unpack_sorted
from .packing import ranks_path, vocabulary_path
from .textblock import Texts, batch_slices

BLOCK_BYTES = 4 << 20
#: An id pair is one number, the A id above so many bits of the B id.
B_BITS = 20
#: Groups of more links than this are counted by their distinct ids.
LARGE_GROUP = 4096
_LONG_PIECE = re.compile(r"\s{1000}|\S{20000}")
_pairs: dict[tuple, Tokenizers] = {}


def pieces_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable bytes
    stand for themselves, the others are numbered from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both encoders and the bytes of their tokens.

    The vocabulary file defines A's ids; where the same vocabulary is given as ranks, ordinary
    texts go that faster way, texts with very long pieces by the vocabulary file."""

    def __init__(self, a: str, ranks: str | None, b: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.fast = None
        if ranks:
            import public_tokenizers
            import tiktoken
            with open(ranks, "rb") as f:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                          mergeable_ranks=table, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        byte_of = _byte_level()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.a_size, self.b_size = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        # ids as text, with the mark that follows them: within a group, at its parts' ends
        self.text = [f"{i}{mark}".encode() for t, marks in ((self.a_bytes, ",|"), (self.b_bytes, ",;"))
                     for mark in marks for i in range(len(t))]

    @staticmethod
    def of(paths: tuple) -> Tokenizers:
        if paths not in _pairs:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
            _pairs[paths] = Tokenizers(*paths)
        return _pairs[paths]

    def encode_a(self, text: str) -> np.ndarray:
        if self.fast is None or _LONG_PIECE.search(text):
            return np.array(self.a.encode(text, add_special_tokens=False).ids, dtype=np.int64)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)

    def encode(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids by A and by B; none if either doesn't give the text's bytes back."""
        none = np.zeros(0, dtype=np.int64)
        if not text:
            return none, none
        spaced, string = b" " + text, text.decode()
        a, b = self.encode_a(" " + string), self.b.encode(string)
        if b"".join(map(self.b_bytes.__getitem__, b)) != spaced \
                or b"".join(map(self.a_bytes.__getitem__, a.tolist())) != spaced:
            return none, none
        return a, np.array(b, dtype=np.int64)


def _gallop(longer: np.ndarray, value: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The first place from ``low`` on at which ``longer`` is not below ``value``."""
    n, step = len(longer), 1
    low, high = low.copy(), low.copy()
    open_ = np.arange(len(value))
    while len(open_):  # exponential steps; all below ``low`` is below the value
        below = high[open_] < n
        below[below] = longer[high[open_[below]]] < value[open_[below]]
        open_ = open_[below]
        low[open_] = high[open_] + 1
        high[open_] += step
        step *= 2
    high = np.minimum(high, n)
    while (low < high).any():
        mid = (low + high) // 2
        below = longer[np.minimum(mid, n - 1)] < value
        low, high = np.where(below & (low < high), mid + 1, low), np.where(below, high, mid)
    return low


def places(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """For each of the ascending ``shorter``, the first place of ``longer`` not below it."""
    out = np.zeros(len(shorter), dtype=np.int64)
    if not len(shorter):
        return out
    out[:1] = _gallop(longer, shorter[:1], out[:1])
    stride = power_of_two(len(shorter))
    while stride:
        at = np.arange(stride, len(shorter), 2 * stride)
        out[at] = _gallop(longer, shorter[at], out[at - stride])
        stride //= 2
    return out


@dataclass
class Alignment:
    """Last A and last B token of every group, and the range of longer-list tokens that each
    token of the shorter list overlaps (both ends included)."""
    a_last: np.ndarray
    b_last: np.ndarray
    first: np.ndarray
    last: np.ndarray


def align(a_ends: np.ndarray, b_ends: np.ndarray) -> Alignment:
    """The groups of two ascending lists of token ends over the same bytes."""
    swap = len(a_ends) > len(b_ends)
    shorter, longer = (b_ends, a_ends) if swap else (a_ends, b_ends)
    place = places(shorter, longer)
    common = place < len(longer)
    common[common] = longer[place[common]] == shorter[common]
    mine, other = np.flatnonzero(common), place[common]
    first = np.append(0, (place + common)[:-1])[:len(place)]
    return Alignment(*((other, mine) if swap else (mine, other)), first, np.minimum(place, len(longer) - 1))


def _repeat_ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    return np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


@dataclass
class Aligned:
    """A slice's documents: ids by A and B end to end, and their groups."""
    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray      # by document
    n_b: np.ndarray
    doc: np.ndarray      # by group
    a_first: np.ndarray
    a_size: np.ndarray
    b_first: np.ndarray
    b_size: np.ndarray

    @staticmethod
    def of(t: Texts, tokens: Tokenizers) -> Aligned:
        both = [tokens.encode(t.text(i)) for i in range(len(t))]
        none = [np.zeros(0, dtype=np.int64)]
        a, b = (np.concatenate(none + [x[k] for x in both]) for k in (0, 1))
        n_a, n_b = (np.array([len(x[k]) for x in both], dtype=np.int64) for k in (0, 1))
        # documents lie end to end, so that ends ascend over all of them
        a_ends, b_ends = np.cumsum(tokens.a_size[a]), np.cumsum(tokens.b_size[b])
        last = [], []
        for some in (n_a <= n_b, n_a > n_b):  # in each document the shorter list drives
            at_a, at_b = (np.flatnonzero(np.repeat(some, n)) for n in (n_a, n_b))
            found = align(a_ends[at_a], b_ends[at_b])
            last[0].append(at_a[found.a_last])
            last[1].append(at_b[found.b_last])
        a_last, b_last = (np.sort(np.concatenate(x)) for x in last)
        a_size, b_size = (np.diff(x, prepend=-1) for x in (a_last, b_last))
        doc = np.repeat(np.arange(len(t)), n_a)[a_last]
        return Aligned(a, b, n_a, n_b, doc, a_last + 1 - a_size, a_size, b_last + 1 - b_size, b_size)

    def digests(self, tokens: Tokenizers) -> list[str]:
        """SHA-256 of each document's groups as ``a1,a2|b1;a3|b2,b3``."""
        size = self.a_size + self.b_size
        at = np.cumsum(size) - size
        code = np.empty(int(size.sum()), dtype=np.int64)
        code[_repeat_ranges(at, self.a_size)] = self.a
        code[_repeat_ranges(at + self.a_size, self.b_size)] = self.b + 2 * len(tokens.a_bytes)
        code[at + self.a_size - 1] += len(tokens.a_bytes)
        code[at + size - 1] += len(tokens.b_bytes)
        n = self.n_a + self.n_b
        out = []
        for end, count in zip(np.cumsum(n).tolist(), n.tolist()):
            text = b"".join(map(tokens.text.__getitem__, code[end - count:end].tolist()))
            out.append(hashlib.sha256(text[:-1]).hexdigest() if count else "")
        return out

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, id pair, number of links) of every distinct pair of each document."""
        n = self.a_size * self.b_size
        some = n <= LARGE_GROUP
        g = np.repeat(np.flatnonzero(some), n[some])
        k = np.arange(len(g)) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
        parts = [(self.doc[g], self.a[self.a_first[g] + k // self.b_size[g]] << B_BITS
                  | self.b[self.b_first[g] + k % self.b_size[g]], np.ones(len(g), dtype=np.int64))]
        for i in np.flatnonzero(~some).tolist():
            a, a_n = np.unique(self.a[self.a_first[i]:self.a_first[i] + self.a_size[i]], return_counts=True)
            b, b_n = np.unique(self.b[self.b_first[i]:self.b_first[i] + self.b_size[i]], return_counts=True)
            pair = (a[:, None] << B_BITS | b[None, :]).ravel()
            parts.append((np.full(len(pair), self.doc[i]), pair, np.outer(a_n, b_n).ravel()))
        doc, pair, times = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((pair, doc))
        doc, pair, times = doc[order], pair[order], times[order]
        new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1]))[:len(doc)])
        return doc[new], pair[new], np.add.reduceat(times, new) if len(new) else times


@dataclass
class Block:
    """Documents with their figures, and their links as indices of the block's distinct pairs."""
    ids: np.ndarray
    null_id: np.ndarray
    figures: np.ndarray  # documents x (n_a, n_b, n_groups, n_links)
    digests: list[str]
    size: np.ndarray     # distinct pairs of each document
    index: np.ndarray
    times: np.ndarray
    pairs: np.ndarray    # ascending

    @staticmethod
    def of(t: Texts, tokens: Tokenizers) -> Block:
        x = Aligned.of(t, tokens)
        doc, pair, times = x.links()
        pairs, index = np.unique(pair, return_inverse=True)
        groups = np.bincount(x.doc, minlength=len(t))
        links = np.zeros(len(t), dtype=np.int64)
        np.add.at(links, doc, times)
        return Block(t.ids, t.null_id, np.stack([x.n_a, x.n_b, groups, links], axis=1), x.digests(tokens),
                     np.bincount(doc, minlength=len(t)), index, times, pairs)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ids)), self.size)

    def documents_of_pairs(self) -> np.ndarray:
        return np.bincount(self.index, minlength=len(self.pairs))

    def pack(self) -> bytes:
        step = np.diff(self.index, prepend=0)
        first = (np.cumsum(self.size) - self.size)[self.size > 0]
        step[first] = self.index[first]  # indices ascend in a document
        arrays = (self.ids.view(np.uint64), self.null_id, self.size, step, self.times, self.figures.ravel())
        return b"".join(pack_array(a) for a in arrays) + pack_sorted(self.pairs.astype(np.uint64)) \
            + b"".join(bytes.fromhex(d or "0" * 64) for d in self.digests)

    @staticmethod
    def unpack(payload: bytes) -> Block:
        at, out = 0, []
        for _ in range(6):
            x, at = unpack_array(payload, at)
            out.append(x.astype(np.int64))
        ids, null, size, step, times, figures = out
        pairs, at = unpack_sorted(payload, at)
        figures = figures.reshape(-1, 4)
        digests = [payload[at + 32 * i:at + 32 * i + 32].hex() if n else "" for i, n in enumerate(figures[:, 0])]
        total = np.cumsum(step)
        before = np.zeros(len(size), dtype=np.int64)
        first = (np.cumsum(size) - size)[size > 0]
        before[size > 0] = total[first] - step[first]
        return Block(ids, null.astype(bool), figures, digests, size, total - np.repeat(before, size), times,
                     pairs.astype(np.int64))


def _each_block(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, Block]]:
    for b in batches:
        for i, p in zip(b.column("block_id"), b.column("payload")):
            yield i.as_py(), Block.unpack(p.as_py())


def _paths(a: str | None, b: str | None) -> tuple:
    return a or vocabulary_path(), ranks_path() if a is None else None, b or pieces_path()


def alignments(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, the ids by A and by B, the groups (first and last token of A
    and of B), and for each token of the shorter list (A's, if they are as long) the first and
    last token of the other that it overlaps. ``a`` and ``b`` are vocabulary files."""
    paths = _paths(a, b)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokenizers.of(paths)
        for batch in batches:
            for _, _, t in batch_slices(batch):
                rows = []
                for i in range(len(t)):
                    x, y = tokens.encode(t.text(i))
                    found = align(np.cumsum(tokens.a_size[x]), np.cumsum(tokens.b_size[y]))
                    from_a, from_b = (np.append(0, last + 1)[:len(last)] for last in (found.a_last, found.b_last))
                    rows.append((x, y, [dict(zip(("a_first", "a_last", "b_first", "b_last"), g)) for g in zip(
                        from_a.tolist(), found.a_last.tolist(), from_b.tolist(), found.b_last.tolist())],
                        [dict(zip(("first", "last"), o)) for o in zip(found.first.tolist(), found.last.tolist())]))
                columns = list(zip(*rows))
                number = pa.int64()
                group = pa.struct([(n, number) for n in ("a_first", "a_last", "b_first", "b_last")])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t.ids, mask=t.null_id), pa.array(columns[0], pa.list_(pa.int32())),
                     pa.array(columns[1], pa.list_(pa.int32())), pa.array(columns[2], pa.list_(group)),
                     pa.array(columns[3], pa.list_(pa.struct([("first", number), ("last", number)])))],
                    ["doc_id", "a_ids", "b_ids", "groups", "overlaps"])
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, a_ids array<int>, b_ids array<int>, groups array<struct<a_first: long, "
                                "a_last: long, b_first: long, b_last: long>>, overlaps array<struct<first: long, last: long>>")


def link_blocks(docs: DataFrame, paths: tuple) -> DataFrame:
    """(block_id, payload) of all documents, dealt by block_id; every reader shares the exchange.
    ``docs`` should be a table scan, whose tasks give the same rows when they are repeated."""
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokenizers.of(paths)
        part, k = TaskContext.get().partitionId(), 0
        for b in batches:
            for _, _, t in batch_slices(b, BLOCK_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 32 | k], pa.int64()), pa.array([Block.of(t, tokens).pack()], pa.binary())],
                    ["block_id", "payload"])
                k += 1
    parts = max(shuffle_partitions(docs.sparkSession), -(-text_bytes(docs) // (64 << 20)))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(cut, "block_id long, payload binary").repartition(int(parts), "block_id")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold the id pair linked, and whether no other pair of its
    A id is held by more."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, b in _each_block(batches):
            yield pa.RecordBatch.from_arrays([pa.array(b.pairs), pa.array(b.documents_of_pairs())], ["pair", "n"])
    n = blocks.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    of_a = Window.partitionBy(F.shiftright("pair", B_BITS))
    return n.select("pair", "n", (F.col("n") == F.max("n").over(of_a)).alias("best"))


_FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def link_statistics(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, numbers of tokens, groups and links, links whose pair is the
    most frequent of its A id, the sum of all links' counts, and the groups' digest."""
    blocks = link_blocks(docs, _paths(a, b))

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, b in _each_block(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b.pairs), i)), pa.array(b.pairs)],
                                             ["block_id", "pair"])

    def settle(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("pair").to_numpy())
        known = right.column("pair").to_numpy()[order]
        n, best = (right.column(c).to_numpy()[order].astype(np.int64) for c in ("n", "best"))
        parts = []
        for p in left.column("payload").to_pylist():
            b = Block.unpack(p)
            if not np.array_equal(known, b.pairs):
                raise ValueError(f"{len(known)} answers for {len(b.pairs)} pairs")
            sums = np.zeros((2, len(b.ids)), dtype=np.int64)
            np.add.at(sums[0], b.doc, best[b.index] * b.times)
            np.add.at(sums[1], b.doc, n[b.index] * b.times)
            parts.append(pa.table([pa.array(b.ids, mask=b.null_id), *b.figures.T, *sums, pa.array(b.digests, pa.string())],
                                  names=["doc_id", *_FIGURES, "n_best", "count_sum", "groups_sha256"]))
        return pa.concat_tables(parts)

    answers = blocks.mapInArrow(ask, "block_id long, pair long").join(pair_counts(blocks), "pair")
    return blocks.groupBy("block_id").cogroup(answers.select("block_id", "pair", "n", "best").groupBy("block_id")) \
        .applyInArrow(settle, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                              "count_sum long, groups_sha256 string")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of all documents by a byte-level BPE and a SentencePiece model, aligned."""
    return link_statistics(read(spark, sf_dir, "documents"))
