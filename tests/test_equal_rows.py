"""Rows of equal inputs as one row with a weight, against fits and searches on the rows."""

from __future__ import annotations

import math

import pytest
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import functions as F

from pricewise.operators import equal_rows as eq
from pricewise.operators import evaluate as ev
from pricewise.operators import tuning as tu
from pricewise.operators.features import FeatureSpec, fit_encoders
from pricewise.operators.learners import make_learner
from pricewise.plans import lineitem as li
from pricewise.plans import queries as Q

SPEC = FeatureSpec(label="y", categorical=("g",), numeric=("x",))
LEARNERS = {"dt": {"maxDepth": 3}, "gbt": {"maxDepth": 2, "maxIter": 3}, "fm": {"maxIter": 5},
            "rf": {"maxDepth": 3, "numTrees": 4, "bootstrap": False}}


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(600).selectExpr(
        "id", "concat('k', id % 7 % 4) as g", "cast(id % 5 as double) as x",
        "cast((id % 7) * (id % 5) + (id * 37 % 11) as double) as y").cache()
    yield df
    df.unpersist()


def _on_rows(monkeypatch):
    monkeypatch.setattr(tu, "may_collapse", lambda cands, spec: False)


@pytest.mark.parametrize("kind", list(LEARNERS))
def test_same_model_as_on_the_rows(rows, monkeypatch, kind):
    est = make_learner(kind, "y", **LEARNERS[kind])
    own = tu.plain_fit(rows, SPEC, est)
    assert eq.few_inputs(rows, SPEC)
    _on_rows(monkeypatch)
    theirs = tu.plain_fit(rows, SPEC, est)
    a, b = ([r.prediction for r in m.transform(rows).orderBy("id").collect()] for m in (own, theirs))
    assert a == pytest.approx(b, rel=1e-9)


def test_same_search_as_on_the_rows(spark, rows, monkeypatch):
    groups = {k: (e, [{e.maxDepth: d} for d in (1, 2)]) for k in ("dt", "gbt")
              for e in [make_learner(k, "y", **LEARNERS[k])]}
    own = [f(spark, rows, SPEC, groups, ("id",)) for f in (tu.cross_validate_many, tu.holdout_search_many)]
    _on_rows(monkeypatch)
    theirs = [f(spark, rows, SPEC, groups, ("id",)) for f in (tu.cross_validate_many, tu.holdout_search_many)]
    for a, b in zip(own, theirs):
        for k in groups:
            assert a[k].best_index == b[k].best_index
            assert [x for m in a[k].per_map for x in m["row"]] == pytest.approx(
                [x for m in b[k].per_map for x in m["row"]], rel=1e-9)


def test_queries_on_few_inputs_do_not_cache_rows(spark, sf_small, monkeypatch):
    """Fits and searches took every row through every level of every tree."""
    seen, fit = [], tu.fit_learner
    monkeypatch.setattr(tu, "fit_learner", lambda est, data, pm=None, weight=None: (
        seen.append(data.count()), fit(est, data, pm, weight))[1])
    Q.QUERIES["gbt_predict"](spark, sf_small)
    Q.QUERIES["dt_cv"](spark, sf_small)
    assert len(seen) == 8 and max(seen) <= 33  # 11 discounts in 3 folds


def test_what_draws_or_counts_rows_keeps_them(spark, rows):
    for kind, params in [("rf", {}), ("rf", {"bootstrap": False, "subsamplingRate": 0.5}), ("dt", {"minInstancesPerNode": 2}),
                         ("gbt", {"lossType": "absolute"}), ("fm", {"regParam": 0.1}), ("linreg", {}), ("dtc", {})]:
        assert not eq.by_weights(make_learner(kind, "y", **params)), (kind, params)
    est = make_learner("dt", "y")
    assert eq.by_weights(est) and not eq.by_weights(est, {est.minInstancesPerNode: 5})
    keep = FeatureSpec(label="y", categorical=("g",), handle_invalid="keep")
    assert not eq.may_collapse([(est, {})], keep)
    assert not eq.few_inputs(rows, FeatureSpec(label="y", numeric=("id",)))


def test_label_order_is_by_rows_not_by_inputs(rows):
    small = eq.collapse(rows, SPEC)
    a, b = (next(s for s in m.stages if isinstance(s, StringIndexerModel)).labelsArray
            for m in (fit_encoders(rows, SPEC), fit_encoders(small, SPEC, weight=eq.ROWS)))
    assert [list(x) for x in a] == [list(x) for x in b]


def test_metrics_from_collapsed_rows(rows):
    flat = rows.withColumn("y", F.lit(1.0))
    for df, predicted in [(rows, F.col("x") * 2), (flat, F.lit(1.0)), (flat, F.lit(2.0))]:
        a, b = (ev.multi_metrics(d.withColumn("p", predicted), "y", ["p"])[0] for d in (eq.collapse(df, SPEC), df))
        assert a["n"] == b["n"] and a["rmse"] == pytest.approx(b["rmse"], rel=1e-12)
        assert a["r2"] == pytest.approx(b["r2"], rel=1e-12) or (math.isnan(a["r2"]) and math.isnan(b["r2"]))


def test_a_missing_label_stays_missing(rows):
    bad = rows.withColumn("y", F.when(F.col("id") != 3, F.col("y")))
    assert eq.collapse(bad, SPEC).filter("y is null").count() == 1
    with pytest.raises(Exception):
        tu.plain_fit(bad, SPEC, make_learner("dt", "y"))


def test_training_rows_are_the_same_rows(spark, sf_small):
    train, _ = Q._split(spark, sf_small, li.CELL_SPEC)
    assert train.exceptAll(li.train_rows(spark, sf_small, li.CELL_SPEC)).isEmpty()
