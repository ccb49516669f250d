"""The factorization machine by blocks against MLlib's own solver."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import FMRegressor

from pricewise.operators import factorization as fz
from pricewise.operators import tuning as tu
from pricewise.operators.factorization import by_blocks, fit_machine
from pricewise.operators.features import FEATURES, FeatureSpec
from pricewise.operators.learners import make_learner


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    x = rng.random((400, 4)).round(3)
    x[::7, 1] = 0.0
    y = 3 * x[:, 0] - x[:, 1] + 4 * x[:, 2] * x[:, 3]
    rows = [(Vectors.dense(a) if i % 2 else Vectors.sparse(4, [(j, v) for j, v in enumerate(a) if v]), float(b))
            for i, (a, b) in enumerate(zip(x.tolist(), y))]
    return spark.createDataFrame(rows, [FEATURES, "y"]).repartition(3).persist()


@pytest.mark.parametrize("params", [
    {}, {"stepSize": 0.1, "maxIter": 30, "factorSize": 3}, {"solver": "gd", "stepSize": 0.05, "maxIter": 20},
    {"fitLinear": False, "maxIter": 15}, {"fitIntercept": False, "maxIter": 15}, {"tol": 0.5, "maxIter": 50},
    {"maxIter": 0}])
def test_same_model_as_mllib(points, params):
    est = make_learner("fm", "y", **params)
    own, theirs = fit_machine(est, points), est.fit(points)
    assert own.factors.toArray() == pytest.approx(theirs.factors.toArray(), rel=1e-6, abs=1e-9)
    assert own.linear.toArray() == pytest.approx(theirs.linear.toArray(), rel=1e-6, abs=1e-9)
    assert own.intercept == pytest.approx(theirs.intercept, rel=1e-6, abs=1e-9)
    a, b = ([r.prediction for r in m.transform(points).collect()] for m in (own, theirs))
    assert a == pytest.approx(b, rel=1e-6)
    assert own.extractParamMap().keys() >= {own.stepSize, own.solver} and own.getFactorSize() == est.getFactorSize()


def test_samples_and_penalties_are_left_to_mllib(spark):
    assert by_blocks(make_learner("fm", "y"))
    assert not by_blocks(make_learner("fm", "y", miniBatchFraction=0.5))
    assert not by_blocks(make_learner("fm", "y", regParam=0.1))
    est = make_learner("fm", "y")
    assert not by_blocks(est, {est.regParam: 0.1}) and not by_blocks(make_learner("dt", "y"))


def test_fits_and_searches_do_not_run_the_row_by_row_solver(spark, monkeypatch):
    """MLlib's solver took 8 microseconds a row and step: it may draw the start, not take steps."""
    steps, fit = [], FMRegressor.fit
    monkeypatch.setattr(FMRegressor, "fit", lambda self, rows, params=None: (
        steps.append(self.copy(params or {}).getMaxIter()), fit(self, rows, params))[1])
    rows = spark.range(200).selectExpr("id", "cast(id % 10 as double) x", "cast(id % 10 as double) * 2 y")
    spec, est = FeatureSpec(label="y", numeric=("x",)), make_learner("fm", "y", maxIter=3)
    tu.plain_fit(rows, spec, est)
    tu.holdout_search(spark, rows, spec, est, tu.build_grid(est, {"stepSize": [0.1, 0.5]}), ("id",))
    assert steps and set(steps) == {0}


def test_missing_numbers_are_errors(points):
    bad = points.selectExpr(FEATURES, "double('NaN') as y")
    with pytest.raises(Exception, match="NaN|must be numbers"):
        fit_machine(make_learner("fm", "y", maxIter=2), bad)


def test_steps_do_not_pass_over_the_rows(points, monkeypatch):
    """Each step was a pass over all rows: a hundred for each map of each fold."""
    est = make_learner("fm", "y", maxIter=40)
    monkeypatch.setattr(fz, "_summer", lambda *a: pytest.fail("a step over the rows"))
    own = fit_machine(est, points)
    monkeypatch.undo()
    monkeypatch.setattr(fz, "MAX_TERMS", 0)
    by_rows = fit_machine(est, points)
    assert own.factors.toArray() == pytest.approx(by_rows.factors.toArray(), rel=1e-7, abs=1e-10)
    assert own.linear.toArray() == pytest.approx(by_rows.linear.toArray(), rel=1e-7, abs=1e-10)
    assert own.intercept == pytest.approx(by_rows.intercept, rel=1e-7)


@pytest.mark.parametrize("weighted", [False, True])
def test_gradients_of_sums_are_those_of_the_rows(weighted):
    rng = np.random.default_rng(5)
    rows = np.column_stack([rng.integers(1, 4, 200) if weighted else np.ones(200), rng.normal(size=(200, 6))])
    n, y, x = rows[:, 0], rows[:, 1], rows[:, 2:]
    v, w, b = rng.normal(size=(5, 3)), rng.normal(size=5), 0.7
    i, j = np.triu_indices(5, 1)
    terms = np.column_stack([np.ones(200), x, x[:, i] * x[:, j], y])
    of_v, of_w, of_b = fz.block_sums(rows, v, w, b)
    got = fz.gradient_of_sums(terms.T @ (n[:, None] * terms))(v, w, b)
    assert got == pytest.approx(np.concatenate([of_v.ravel(), of_w, [of_b]]) / n.sum(), rel=1e-10, abs=1e-12)
