"""Document quality by nearest-neighbour voting in a latent-semantic space.

A text's terms are its byte trigrams (A-Z in lower case) and one *form* per word: which kinds
of characters it has, and whether it stands in a repeated 3-word window. Terms are hashed to
a fixed number of columns. Document frequencies come from all documents; the latent space is
a truncated SVD of the TF-IDF rows of at most ``max_labelled`` labelled documents. Their
vectors and the projection have a size fixed by parameters (``max_labelled`` x ``rank`` and
``TERMS`` x ``rank``), so they are broadcast; every document is then multiplied with all of
them, block by block, and its ``neighbours`` nearest vote, weighted by cosine.

Labels are learnt only from rows with crc32(doc_id as text) mod 4 other than 2. doc_id, lang and
source are never inputs of a score.

Defined cases: a text without terms (null, empty) has no direction and gets the share of label 1
among the labelled; several labels of a document count as their mean; a null label doesn't
count; ties for the last neighbour all vote; repeated rows are scored each; a null doc_id is
not held out; without labels every score is 0.5; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .textblock import (Texts, ascii_lower, batch_slices, byte_sums, mix, prefix_sums,
                        range_hash)

TRIGRAMS, FORMS = 4096 - 256, 256
TERMS = TRIGRAMS + FORMS
#: The classifier is fitted on at most so many labelled documents.
MAX_LABELLED = 6144
RANK = 48
NEIGHBOURS = 10
#: Weight of the forms against the trigrams.
FORM_WEIGHT = 2.0
THRESHOLD = 0.7
#: Documents and bytes of a slice whose counts are a dense array.
SLICE_ROWS, SLICE_BYTES = 512, 1 << 20
HELD_OUT = 2

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>@^~_=+{}[]\\/"))
_PUNCTUATION = np.isin(np.arange(256), list(b".,;:!?'\"()-"))


def _class(low: int, high: int) -> np.ndarray:
    return (np.arange(256) >= low) & (np.arange(256) <= high)


_KINDS = (_class(65, 90), _class(97, 122) | _class(128, 255), _class(48, 57), _SYMBOL, _PUNCTUATION)


def _repeated(t: Texts, begin: np.ndarray, end: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Words inside a 3-word window that their text holds twice or more."""
    out = np.zeros(len(begin), dtype=bool)
    if len(begin) < 3:
        return out
    w = prefix_sums(range_hash(byte_sums(t.data), begin, end))
    at = np.nonzero(doc[2:] == doc[:-2])[0]
    if not len(at):
        return out
    _, place, n = np.unique(mix(range_hash(w, at, at + 3) + doc[at].astype(np.uint64)),
                            return_inverse=True, return_counts=True)
    twice = at[n[place] > 1]
    for k in range(3):
        out[twice + k] = True
    return out


def term_counts(t: Texts) -> np.ndarray:
    """Documents x TERMS counts of a slice."""
    n = len(t)
    counts = np.zeros(n * TERMS, dtype=np.float32)
    if len(t.data) >= 3:
        b = ascii_lower(t.data).astype(np.uint32)
        code = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435761)
        column = (code >> np.uint32(8)) % np.uint32(TRIGRAMS)
        doc = np.repeat(np.arange(n), t.sizes)
        inside = doc[:-2] == doc[2:]
        counts += np.bincount(doc[:-2][inside] * TERMS + column[inside], minlength=n * TERMS)
    begin, end, doc = t.words()
    form = np.zeros(len(begin), dtype=np.int64)
    for bit, kind in enumerate(_KINDS):
        run = np.append(0, np.cumsum(kind[t.data]))
        form |= (run[end] > run[begin]).astype(np.int64) << bit
    form |= _repeated(t, begin, end, doc).astype(np.int64) << len(_KINDS)
    counts += np.bincount(doc * TERMS + TRIGRAMS + form, minlength=n * TERMS)
    return counts.reshape(n, TERMS)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit rows. Trigrams count by their logarithm, forms by their share of the words, so
    that a long text is as near to its like as a short one."""
    x = np.log1p(counts) * idf
    x[:, TRIGRAMS:] = 0
    x /= np.maximum(1e-9, np.linalg.norm(x, axis=1, keepdims=True))
    forms = counts[:, TRIGRAMS:]
    x[:, TRIGRAMS:] = FORM_WEIGHT * forms / np.maximum(1.0, forms.sum(axis=1, keepdims=True))
    return (x / np.maximum(1e-9, np.linalg.norm(x, axis=1, keepdims=True))).astype(np.float32)


@dataclass
class Model:
    """Of bounded size: idf (TERMS), projection (TERMS x rank), labelled vectors and labels."""
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int

    @property
    def prior(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.5

    def embed(self, counts: np.ndarray) -> np.ndarray:
        v = weighted(counts, self.idf) @ self.projection
        return v / np.maximum(1e-9, np.linalg.norm(v, axis=1, keepdims=True))

    def score(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        cosine = np.maximum(self.embed(counts) @ self.vectors.T, 0.0)
        k = min(self.neighbours, cosine.shape[1])
        least = np.partition(cosine, cosine.shape[1] - k, axis=1)[:, cosine.shape[1] - k, None]
        weight = np.where(cosine >= least, cosine, 0.0).astype(np.float64)
        total = weight.sum(axis=1)
        score = np.where(total > 1e-9, weight @ self.labels / np.maximum(total, 1e-9), self.prior)
        score[counts.sum(axis=1) == 0] = self.prior
        return np.clip(np.round(score, 6), 0.0, 1.0)


def latent_space(x: np.ndarray, rank: int, seed: int = 7, rounds: int = 4) -> np.ndarray:
    """Right singular vectors of ``x`` by randomised subspace iteration."""
    rank = max(1, min(rank, *x.shape))
    q = np.random.default_rng(seed).standard_normal((x.shape[1], rank + 8)).astype(np.float32)
    for _ in range(rounds):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    return np.ascontiguousarray((q @ v.T)[:, :rank], dtype=np.float32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == HELD_OUT, F.lit(False))


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each term, and documents: over all of ``docs``. A task sends one
    row a term; the driver gets TERMS rows."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(TERMS, dtype=np.int64), 0
        for b in batches:
            for _, _, t in batch_slices(b, SLICE_BYTES, SLICE_ROWS):
                total += (term_counts(t) > 0).sum(axis=0)
                rows += len(t)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(TERMS + 1)), pa.array(np.append(total, rows))], ["term", "n"])

    out = np.zeros(TERMS + 1, dtype=np.int64)
    per_term = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for r in per_term.collect():
        out[r["term"]] = r["n"]
    return out[:TERMS], int(out[TERMS])


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """(doc_id, text, label) of at most ``limit`` labelled rows, by order of a hash."""
    chosen = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()) \
        .filter(~held_out(F.col("doc_id"))) \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.avg("quality").alias("label")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # at most ``limit`` rows of two numbers
    return rows.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text") \
        .limit(limit)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, rank: int = RANK,
        neighbours: int = NEIGHBOURS) -> Model:
    """The driver holds ``max_labelled`` rows of TERMS 32-bit weights at most (100 MB)."""
    df, n = document_frequencies(docs)
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0

    def featurise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label = b.column("label").to_numpy()
            for row, end, t in batch_slices(b, SLICE_BYTES, SLICE_ROWS):
                counts = term_counts(t)
                at = [np.nonzero(c)[0] for c in counts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a.astype("<u2").tobytes() for a in at], pa.binary()),
                     pa.array([c[a].astype("<f4").tobytes() for c, a in zip(counts, at)], pa.binary()),
                     pa.array(label[row:end])], ["at", "n", "label"])

    sample = labelled_sample(docs, labels, max_labelled) \
        .mapInArrow(featurise, "at binary, n binary, label double").collect()
    some = [r for r in sample if r["at"]]
    y = np.array([r["label"] for r in some or sample], dtype=np.float64)
    if not some:
        return Model(idf, np.zeros((TERMS, 1), np.float32), np.zeros((len(y), 1), np.float32), y, neighbours)
    x = np.zeros((len(some), TERMS), dtype=np.float32)
    for first in range(0, len(some), 256):
        counts = np.zeros((len(some[first:first + 256]), TERMS), dtype=np.float32)
        for row, r in zip(counts, some[first:first + 256]):
            row[np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["n"], "<f4")
        x[first:first + 256] = weighted(counts, idf)
    del sample, some
    projection = latent_space(x, rank)
    v = x @ projection
    v /= np.maximum(1e-9, np.linalg.norm(v, axis=1, keepdims=True))
    return Model(idf, projection, v, y, neighbours)


def _batch_scores(model: Model, b: pa.RecordBatch) -> np.ndarray:
    scores = [model.score(term_counts(t)) for _, _, t in batch_slices(b, SLICE_BYTES, SLICE_ROWS)]
    return np.concatenate(scores) if scores else np.zeros(0)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(_batch_scores(model, b))], ["doc_id", "score"])
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``threshold``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_batch_scores(model, b) >= threshold))
    return docs.mapInArrow(run, docs.schema)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a classifier fitted on the labelled ones."""
    docs = read(spark, sf_dir, "documents")
    model = fit(docs, read(spark, sf_dir, "labels"))
    return scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
