"""Toxicity by class-conditional Kneser-Ney language models of the bytes of words.

A text's words are runs of letters, digits and bytes from 128 on, A-Z in lower case. A word is
a sequence of bytes between two spaces; a byte's *gram* is itself and up to ``ORDER - 1``
bytes before it, back to the space before the word. Each class, toxic and ordinary, has the
counts of its own labelled documents, discounted and interpolated with one shared
distribution, so a rare or unseen expression gets the same mass in both::

    P_c(b | h)  = (max(n_c(hb) - D, 0) + D * T_c(h) * P(b | h')) / n_c(h)
    P(b | h')   = (k(h'b) - D + D * T(h') / 256) / K(h')

n_c are occurrences in class c and T_c(h) different followers of h there; h' is the last two
bytes of h, and k(h'b) counts the different grams of the whole corpus that end in h'b
(continuation counts), K and T their sum and number over h'. Without h in a class, P_c = P.

A toxic text is mostly ordinary text, so its likelihood is a mixture: a word comes from the
toxic model with probability ``SHARE``, else from the ordinary one. A document's value is the
mean over its words of ln(P_mixture(word) / P_ordinary(word)), that is the difference of the
length-normalised log-likelihoods. A logistic curve turns it into the score; its middle is
where the labelled documents of one fold, which the class models don't count, err least.

Counts cover all documents and grow with them. Texts travel once, as blocks of word counts;
grams and their counts are rows that Spark sums before they are shuffled; a block asks for each
of its grams once. Only a histogram of ``2 * BINS`` counts reaches the driver.

Labels are learnt only from rows with crc32(doc_id as text) mod 5 other than 0 (1 is the fold
of the curve). doc_id, lang and source are never inputs of a score.

Defined cases: a text without words (null, empty) has value 0; several labels of a document
count as one, toxic if half of them are; null labels and labels without doc_id don't count;
repeated rows are counted and scored each; a null doc_id is not held out; without labels of
both kinds in the fold the curve has the middle ``DEFAULT_MIDDLE``; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpoint, read, shuffle_partitions, text_bytes
from .fingerprints import pack_array, unpack_array
from .textblock import Texts, ascii_lower, batch_slices, byte_sums, range_hash

#: Bytes of a gram; grams are exact, as they fit into 40 bits.
ORDER = 5
#: Absolute discount of Kneser and Ney.
DISCOUNT = 0.75
#: Share of toxic words that is assumed of a toxic text.
SHARE = 0.01
#: A single word's log-ratio counts up to this, so that its exponential is finite.
MOST = 30.0
DEFAULT_MIDDLE, DEFAULT_WIDTH = 0.05, 0.02
#: The histogram of the curve's fold: values from LOW up in BINS steps.
BINS, LOW, STEP = 8192, -0.5, 1 / 2048
HELD_OUT, CURVE_FOLD = 0, 1
BLOCK_BYTES = 8 << 20

_SEPARATOR = np.ones(256, dtype=bool)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _SEPARATOR[_a:_b] = False
_SPACE = 32


@dataclass
class Block:
    """Documents as counts of a block's distinct words."""
    ids: np.ndarray      # int64
    null_id: np.ndarray  # bool
    size: np.ndarray     # distinct words of each document
    word: np.ndarray     # word of each (document, word)
    times: np.ndarray    # how often
    length: np.ndarray   # bytes of each distinct word
    letters: np.ndarray  # uint8, the distinct words end to end

    @staticmethod
    def of(t: Texts) -> Block:
        data = ascii_lower(t.data)
        begin, end, doc = t.words(_SEPARATOR)
        _, first, place = np.unique(range_hash(byte_sums(data), begin, end),
                                    return_index=True, return_inverse=True)
        common = np.argsort(-np.bincount(place, minlength=len(first)), kind="stable")
        number = np.empty_like(common)
        number[common] = np.arange(len(common))
        first, place = first[common], number[place]
        pair, times = np.unique(doc * max(1, len(first)) + place, return_counts=True)
        size = np.bincount(pair // max(1, len(first)), minlength=len(t))
        length = end[first] - begin[first]
        letters = data[_ranges(begin[first], length)]
        return Block(t.ids, t.null_id, size, pair % max(1, len(first)), times, length, letters)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ids)), self.size)

    def pack(self) -> bytes:
        first = np.cumsum(self.size) - self.size
        step = np.diff(self.word, prepend=0)
        step[first[self.size > 0]] = self.word[first[self.size > 0]]  # words ascend in a document
        arrays = (self.ids.view(np.uint64), self.null_id, self.size, step, self.times, self.length)
        return b"".join(pack_array(a) for a in arrays) \
            + zstandard.ZstdCompressor(level=3).compress(self.letters.tobytes())

    @staticmethod
    def unpack(payload: bytes) -> Block:
        at, out = 0, []
        for _ in range(6):
            a, at = unpack_array(payload, at)
            out.append(a.astype(np.int64))
        ids, null, size, step, times, length = out
        total = np.cumsum(step)
        first = (np.cumsum(size) - size)[size > 0]
        before = np.zeros(len(size), dtype=np.int64)
        before[size > 0] = total[first] - step[first]
        word = total - np.repeat(before, size)
        raw = zstandard.ZstdDecompressor().decompress(payload[at:], max_output_size=max(1, int(length.sum())))
        return Block(ids, null.astype(bool), size, word, times, length, np.frombuffer(raw, dtype=np.uint8))

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """(gram, word) of each byte of each distinct word and of the space after it."""
        n = self.length + 2
        begin = np.cumsum(n) - n
        symbols = np.full(int(n.sum()), _SPACE, dtype=np.uint8)
        symbols[_ranges(begin + 1, self.length)] = self.letters
        word = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(symbols)) - begin[word]
        gram = symbols.astype(np.int64)
        for back in range(1, ORDER):
            ok = place >= back
            gram[ok] |= symbols[np.nonzero(ok)[0] - back].astype(np.int64) << (8 * back)
        inside = place > 0
        return gram[inside], word[inside]


def _ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All positions of the ranges, end to end."""
    return np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == HELD_OUT, F.lit(False))


def word_blocks(docs: DataFrame) -> DataFrame:
    """(block_id, payload) of all documents, dealt by block_id; every reader shares the exchange.
    ``docs`` should be a table scan, whose tasks give the same rows when they are repeated."""
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for b in batches:
            for _, _, t in batch_slices(b, BLOCK_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 32 | k], pa.int64()), pa.array([Block.of(t).pack()], pa.binary())],
                    ["block_id", "payload"])
                k += 1
    parts = max(shuffle_partitions(docs.sparkSession), -(-text_bytes(docs) // (64 << 20)))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(cut, "block_id long, payload binary").repartition(int(parts), "block_id")


def _each_block(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, Block]]:
    for b in batches:
        for i, p in zip(b.column("block_id"), b.column("payload")):
            yield i.as_py(), Block.unpack(p.as_py())


def one_label(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of every document with a label that may be learnt."""
    return labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()) \
        .filter(~held_out(F.col("doc_id"))) \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg((F.avg(F.col("toxic").cast("double")) >= 0.5).cast("int").alias("toxic"))


def class_counts(blocks: DataFrame, label: DataFrame) -> DataFrame:
    """(gram, toxic, ordinary): every gram of the corpus and its occurrences in the documents
    that ``label`` (doc_id, toxic) names."""
    def ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, b in _each_block(batches):
            known = np.unique(b.ids[~b.null_id])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(known), i)), pa.array(known)],
                                             ["block_id", "doc_id"])

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        of = dict(zip(right.column("doc_id").to_pylist(), right.column("toxic").to_pylist()))
        for p in left.column("payload").to_pylist():
            b = Block.unpack(p)
            kind = np.array([-1 if n else of.get(i, -1) for i, n in zip(b.ids.tolist(), b.null_id)],
                            dtype=np.int64).reshape(-1)
            gram, word = b.grams()
            unique, place = np.unique(gram, return_inverse=True)
            n = [unique]
            for c in (1, 0):
                at = kind[b.doc] == c
                in_class = np.bincount(b.word[at], weights=b.times[at], minlength=len(b.length))
                n.append(np.bincount(place, weights=in_class[word], minlength=len(unique)).astype(np.int64))
            parts.append(pa.table(n, names=["gram", "toxic", "ordinary"]))
        return pa.concat_tables(parts) if parts else pa.table(
            [pa.array([], pa.int64())] * 3, names=["gram", "toxic", "ordinary"])

    named = blocks.mapInArrow(ids, "block_id long, doc_id long").join(label, "doc_id")
    return blocks.groupBy("block_id").cogroup(named.groupBy("block_id")) \
        .applyInArrow(count, "gram long, toxic long, ordinary long") \
        .groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def log_ratios(counts: DataFrame) -> DataFrame:
    """(gram, ratio): ln P_toxic - ln P_ordinary of every gram's last byte after the others.
    A context has 256 grams at most, a shared ending 65,536."""
    tail = F.col("gram").bitwiseAND(F.lit((1 << 24) - 1))
    ends = counts.groupBy(tail.alias("tail")).agg(F.count(F.lit(1)).alias("k"))
    over = Window.partitionBy(F.shiftright("tail", 8))
    shared = ends.select("tail", (
        (F.col("k") - DISCOUNT + DISCOUNT * F.count(F.lit(1)).over(over) / 256)
        / F.sum("k").over(over)).alias("p"))
    context = Window.partitionBy(F.shiftright("gram", 8))
    rows = counts.select("gram", tail.alias("tail"), *[x for c in ("toxic", "ordinary") for x in (
        F.col(c), F.sum(c).over(context).alias(f"{c}_n"),
        F.sum((F.col(c) > 0).cast("long")).over(context).alias(f"{c}_t"))]).join(shared, "tail")

    def p(c: str) -> Column:
        seen = (F.greatest(F.col(c) - DISCOUNT, F.lit(0.0))
                + DISCOUNT * F.col(f"{c}_t") * F.col("p")) / F.col(f"{c}_n")
        return F.when(F.col(f"{c}_n") > 0, seen).otherwise(F.col("p"))
    return rows.select("gram", (F.log(p("toxic")) - F.log(p("ordinary"))).alias("ratio"))


def values(docs: DataFrame, label: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, value) of every row of ``docs``; ``label`` (doc_id, toxic) names the documents
    that the class models count."""
    blocks = word_blocks(docs)
    model = log_ratios(class_counts(blocks, label))

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, b in _each_block(batches):
            gram = np.unique(b.grams()[0])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(gram), i)), pa.array(gram)],
                                             ["block_id", "gram"])

    def settle(left: pa.Table, right: pa.Table) -> pa.Table:
        known = right.column("gram").to_numpy()
        order = np.argsort(known)
        known, ratio = known[order], right.column("ratio").to_numpy()[order]
        parts = []
        for p in left.column("payload").to_pylist():
            b = Block.unpack(p)
            gram, word = b.grams()
            at = np.searchsorted(known, gram)
            if len(gram) and (len(known) == 0 or (known[np.minimum(at, len(known) - 1)] != gram).any()):
                raise ValueError("a gram of the block has no answer")
            each = np.bincount(word, weights=ratio[at], minlength=len(b.length)) if len(gram) else np.zeros(0)
            gain = np.log1p(share * np.expm1(np.minimum(each, MOST)))
            total = np.bincount(b.doc, weights=gain[b.word] * b.times, minlength=len(b.ids))
            n = np.bincount(b.doc, weights=b.times, minlength=len(b.ids))
            parts.append(pa.table([pa.array(b.ids, mask=b.null_id),
                                   pa.array(total / np.maximum(n, 1.0))], names=["doc_id", "value"]))
        return pa.concat_tables(parts)

    answers = blocks.mapInArrow(ask, "block_id long, gram long").join(model, "gram")
    return blocks.groupBy("block_id").cogroup(answers.select("block_id", "gram", "ratio").groupBy("block_id")) \
        .applyInArrow(settle, "doc_id long, value double")


def curve(toxic: np.ndarray, ordinary: np.ndarray) -> tuple[float, float]:
    """(middle, width) of the logistic curve from histograms of both kinds' values: the middle
    of the widest stretch of thresholds at which the two kinds' error shares sum to least."""
    if not toxic.sum() or not ordinary.sum():
        return DEFAULT_MIDDLE, DEFAULT_WIDTH
    # error of the threshold before each bin
    missed = np.append(0, np.cumsum(toxic)) / toxic.sum()
    blamed = 1 - np.append(0, np.cumsum(ordinary)) / ordinary.sum()
    error = missed + blamed
    best = error <= error.min() + 1e-12
    edge = np.flatnonzero(np.diff(np.concatenate([[0], best.astype(np.int8), [0]])))
    runs = edge.reshape(-1, 2)
    low, high = runs[np.argmax(runs[:, 1] - runs[:, 0])]
    middle = LOW + STEP * (low + high - 1) / 2
    mean = [float((h * (LOW + STEP * (np.arange(BINS) + 0.5))).sum() / h.sum()) for h in (toxic, ordinary)]
    return middle, max(STEP, (mean[0] - mean[1]) / 8)


def scored(docs: DataFrame, labels: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, score) of every row of ``docs``."""
    label = one_label(labels)
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    found = checkpoint(values(docs, label.filter(fold != CURVE_FOLD), share))
    at = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("value") - LOW) / STEP)))
    bins = found.join(label.filter(fold == CURVE_FOLD), "doc_id") \
        .groupBy("toxic", at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    histogram = np.zeros((2, BINS))
    for r in bins.collect():  # 2 * BINS rows at most
        histogram[r["toxic"], r["bin"]] = r["n"]
    middle, width = curve(histogram[1], histogram[0])
    score = 1 / (1 + F.exp((F.lit(middle) - F.col("value")) / width))
    return found.select("doc_id", F.round(score, 6).alias("score"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by models counted on the labelled ones."""
    rows = scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))
