"""Full-batch fits of the factorization machine, from sums over the rows.

MLlib's solver walks each row's vector through boxed iterators, twice for every factor: some 8
microseconds a row and step. A score is linear in the terms 1, x_i and x_i x_j, with factors' products
as weights of the pairs, so the gradient of the squared error over all rows follows from the sums of
the terms' products with each other and with the label, whatever the factors are: one pass
takes these sums, and every step is arithmetic on them. Where the pairs are many, rows are packed
into blocks instead, which stay cached, and a step is one pass of matrix products over them. Start,
gradient, steps and the test for convergence are MLlib's (``FMRegressor`` with ``solver`` adamW or gd),
and so is the model: it differs by the order of the sums only."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.ml.regression import FMRegressionModel, FMRegressor
from pyspark.ml.wrapper import JavaParams
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: AdamW's constants in MLlib.
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8
#: Terms (1, slots, pairs of slots) whose products are summed; with more a step passes over the rows.
MAX_TERMS = 128


def by_blocks(est, param_map: dict | None = None) -> bool:
    """Whether ``fit_machine`` fits this estimator; samples of rows and penalties are MLlib's own."""
    if not isinstance(est, FMRegressor):
        return False
    e = est.copy(param_map or {})
    return e.getMiniBatchFraction() == 1.0 and e.getRegParam() == 0.0


def _columns(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights, labels and features of a batch's rows."""
    n = b.column("weight").to_numpy(zero_copy_only=False)
    y = b.column("label").to_numpy(zero_copy_only=False)
    x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
    if np.isnan(y).any() or not np.isfinite(x).all():
        raise ValueError("labels and features must be numbers, features finite")
    return n, y, x


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block: weight, label and features of a batch's rows, row by row."""
    for b in batches:
        if b.num_rows:
            rows = np.column_stack(_columns(b)).astype("<f8")
            yield pa.RecordBatch.from_arrays([pa.array([rows.tobytes()], pa.binary())], ["block"])


def _sum_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums of the products of terms and label: the terms 1, x_i, x_i x_j (i < j), then the label."""
    total = 0.0
    for b in batches:
        if b.num_rows:
            n, y, x = _columns(b)
            i, j = np.triu_indices(x.shape[1], 1)
            terms = np.column_stack([np.ones(len(y)), x, x[:, i] * x[:, j], y])
            total = total + terms.T @ (n[:, None] * terms)
    if isinstance(total, np.ndarray):
        yield pa.RecordBatch.from_arrays([pa.array([total.astype("<f8").tobytes()], pa.binary())], ["block"])


def block_sums(rows: np.ndarray, v: np.ndarray, w: np.ndarray, b: float
               ) -> tuple[np.ndarray, np.ndarray, float]:
    """Gradients of the squared error, summed over a block's rows by weight, for factors, linear
    terms and intercept."""
    n, y, x = rows[:, 0], rows[:, 1], rows[:, 2:]
    xv, x2 = x @ v, x * x
    score = b + x @ w + 0.5 * ((xv * xv).sum(axis=1) - x2 @ (v * v).sum(axis=1))
    m = 2.0 * n * (score - y)
    return x.T @ (m[:, None] * xv) - (x2.T @ m)[:, None] * v, x.T @ m, float(m.sum())


def _summer(v: np.ndarray, w: np.ndarray, b: float):
    def run(blocks: Iterable[bytes]) -> Iterator[tuple[np.ndarray, float]]:
        total, n = np.zeros(v.size + len(w) + 1), 0.0
        for block in blocks:
            rows = np.frombuffer(block, dtype="<f8").reshape(-1, len(w) + 2)
            of_v, of_w, of_b = block_sums(rows, v, w, b)
            total += np.concatenate([of_v.ravel(), of_w, [of_b]])
            n += float(rows[:, 0].sum())
        yield total, n
    return run


def gradient_of_sums(sums: np.ndarray):
    """The mean gradients for factors, linear terms and intercept from the sums of ``_sum_terms``."""
    products, with_label, n = sums[:-1, :-1], sums[:-1, -1], sums[0, 0]

    def gradient(v: np.ndarray, w: np.ndarray, b: float) -> np.ndarray:
        i, j = np.triu_indices(len(w), 1)
        of_terms = 2.0 / n * (products @ np.concatenate([[b], w, (v[i] * v[j]).sum(axis=1)]) - with_label)
        of_pairs = np.zeros((len(w), len(w)))
        of_pairs[i, j] = of_pairs[j, i] = of_terms[1 + len(w):]
        return np.concatenate([(of_pairs @ v).ravel(), of_terms[1:1 + len(w)], of_terms[:1]])
    return gradient


def gradient_of_blocks(blocks: RDD):
    """The same by a pass over all rows."""
    def gradient(v: np.ndarray, w: np.ndarray, b: float) -> np.ndarray:
        sums, counts = zip(*blocks.mapPartitions(_summer(v, w, b)).collect())  # one sum a task
        return np.sum(sums, axis=0) / sum(counts)
    return gradient


def _descend(gradient: Callable, est: FMRegressor, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Factors, linear terms and intercept after the steps."""
    d, k = v.shape
    fitted = np.concatenate([np.ones(d * k), np.full(d, est.getFitLinear()), [est.getFitIntercept()]])
    at = np.concatenate([v.ravel(), np.zeros(d + 1)])
    first, second = np.zeros_like(at), np.zeros_like(at)
    step, adam = est.getStepSize(), est.getSolver() == "adamW"
    for i in range(1, est.getMaxIter() + 1):
        g = fitted * gradient(at[:d * k].reshape(d, k), at[d * k:-1], float(at[-1]))
        if adam:
            first = BETA1 * first + (1 - BETA1) * g
            second = BETA2 * second + (1 - BETA2) * g * g
            move = step * (first / (1 - BETA1 ** i)) / (np.sqrt(second / (1 - BETA2 ** i)) + EPSILON)
        else:
            move = step / np.sqrt(i) * g
        before, at = at, at - move
        if i > 1 and np.linalg.norm(before - at) < est.getTol() * max(np.linalg.norm(at), 1.0):
            break
    return at[:d * k].reshape(d, k), at[d * k:-1], float(at[-1])


def fit_machine(est: FMRegressor, rows: DataFrame, param_map: dict | None = None,
                weight: str | None = None) -> FMRegressionModel:
    """``est.fit(rows, param_map)`` from sums; ``weight`` names a column with the number of rows that
    a row stands for."""
    est = est.copy(param_map or {})
    # without a step, the factors that the seed draws
    start = est.fit(rows.limit(1), {est.maxIter: 0})
    factors = start.factors.toArray()
    terms = 1 + len(factors) + len(factors) * (len(factors) - 1) // 2
    named = rows.select((F.col(weight) if weight else F.lit(1.0)).alias("weight"),
                        F.col(est.getLabelCol()).cast("double").alias("label"),
                        vector_to_array(est.getFeaturesCol()).alias("x"))
    if terms <= MAX_TERMS:
        sums = sum(np.frombuffer(r.block, "<f8") for r in named.mapInArrow(_sum_terms, "block binary").collect())  # one a task
        v, w, b = _descend(gradient_of_sums(sums.reshape(terms + 1, terms + 1)), est, factors)
    else:
        # kept as an RDD: a step is one small job, without a query plan of its own
        blocks = named.mapInArrow(_pack, "block binary").rdd.map(lambda r: bytes(r.block)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            v, w, b = _descend(gradient_of_blocks(blocks), est, factors)
        finally:
            blocks.unpersist()
    sc = rows.sparkSession.sparkContext
    java = JavaParams._new_java_obj(
        "org.apache.spark.ml.regression.FMRegressionModel", est.uid, b, _py2java(sc, DenseVector(w)),
        _py2java(sc, DenseMatrix(*v.shape, v.ravel(), True)))
    return est._copyValues(FMRegressionModel(java))
