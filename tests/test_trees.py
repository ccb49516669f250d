"""Trees grown over blocks of binned rows, against MLlib's own and against themselves."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewise.operators import trees as tr
from pricewise.operators import tuning as tu
from pricewise.operators.features import FeatureSpec, fit_encoders
from pricewise.operators.learners import fit_learner, make_learner
from pricewise.plans import queries as Q

SPEC = FeatureSpec(label="y", flags=("b",), categorical=("g",), numeric=("x", "z", "c"))


@pytest.fixture(scope="module", params=[400, 30_000])
def rows(spark, request):
    """Few rows, and so many that split candidates come from a sample; a column with many zeros,
    a constant one, equal values."""
    df = spark.range(request.param, numPartitions=3).selectExpr(
        "cast(id % 2 as int) as b", "concat('k', id * 7 % 11 % 6) as g", "cast(hash(id) % 9973 as double) as x",
        "greatest(0.0d, cast(hash(id, 1) % 50 as double)) as z", "1.0d as c",
        "cast(hash(id) % 9973 / 100 * (id % 2) + (id * 7 % 11 % 6) * 10 + hash(id, 2) % 20 as double) as y")
    encoded = fit_encoders(df, SPEC).transform(df).select("features", "y").cache()
    yield encoded
    encoded.unpersist()


def predictions(model, rows):
    return np.array([r.prediction for r in model.transform(rows).select("prediction").collect()])


def nodes(model):
    return model.totalNumNodes if hasattr(model, "totalNumNodes") else model.numNodes


@pytest.mark.parametrize("kind, params", [
    ("dt", {"maxDepth": 7, "maxBins": 20}), ("dt", {"maxDepth": 4, "maxBins": 64, "minInfoGain": 5.0}),
    ("dt", {"maxDepth": 0}), ("gbt", {"maxDepth": 4, "maxIter": 4, "stepSize": 0.3}), ("gbt", {"maxIter": 1})])
def test_trees_are_those_of_mllib(rows, kind, params):
    est = make_learner(kind, "y", **params)
    assert tr.by_levels(est, {}, rows)
    own, theirs = tr.fit_trees(rows, [(est, {})])[0], fit_learner(est, rows)
    assert type(own) is type(theirs) and nodes(own) == nodes(theirs)
    assert np.allclose(predictions(own, rows), predictions(theirs, rows), rtol=1e-9, atol=1e-9)
    a, b = (m.featureImportances.toArray() for m in (own, theirs))
    assert np.allclose(a, b, atol=1e-6)


@pytest.mark.parametrize("kind", ["dt", "rf", "gbt"])
def test_small_nodes_grow_the_same_in_one_task(rows, monkeypatch, kind):
    est = make_learner(kind, "y", maxDepth=8, **{"rf": {"numTrees": 3}, "gbt": {"maxIter": 2}}.get(kind, {}))
    by_level = tr.fit_trees(rows, [(est, {})])[0]
    monkeypatch.setattr(tr, "LEVEL_BYTES", 0)
    monkeypatch.setattr(tr, "LOCAL_ROWS", rows.count() // 5)
    monkeypatch.setattr(tr, "LOCAL_CHUNK", 3)
    monkeypatch.setattr(tr, "CHUNK", 2)
    finished = tr.fit_trees(rows, [(est, {})])[0]
    assert nodes(by_level) == nodes(finished)
    assert np.allclose(predictions(by_level, rows), predictions(finished, rows), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("kind", ["dt", "rf"])
def test_a_smaller_depth_is_the_upper_part(rows, monkeypatch, kind):
    est = make_learner(kind, "y", **({"numTrees": 4} if kind == "rf" else {}))
    grown, real = [], tr.grow
    monkeypatch.setattr(tr, "grow", lambda *a: (grown.append(1), real(*a))[1])
    both = tr.fit_trees(rows, [(est, {est.maxDepth: 3}), (est, {est.maxDepth: 6})])
    assert len(grown) == 1
    for model, depth in zip(both, (3, 6)):
        alone = tr.fit_trees(rows, [(est, {est.maxDepth: depth})])[0]
        assert nodes(model) == nodes(alone)
        assert (predictions(model, rows) == predictions(alone, rows)).all() or \
            np.allclose(predictions(model, rows), predictions(alone, rows), rtol=1e-12)


def test_a_forest_draws_rows_and_features(rows):
    est = make_learner("rf", "y", numTrees=30, maxDepth=6)
    own, theirs = tr.fit_trees(rows, [(est, {})])[0], fit_learner(est, rows)
    again, other = tr.fit_trees(rows, [(est, {})])[0], tr.fit_trees(rows, [(est, {est.seed: 1})])[0]
    got = predictions(own, rows)
    assert np.allclose(got, predictions(again, rows), rtol=1e-12) and not np.allclose(got, predictions(other, rows))
    assert own.getNumTrees == 30 and len({t.toDebugString.split("\n", 1)[1] for t in own.trees}) == 30
    y = np.array([r.y for r in rows.select("y").collect()])
    errors = [np.mean((p - y) ** 2) for p in (got, predictions(theirs, rows))]
    assert 0.8 < errors[0] / errors[1] < 1.25
    n = rows.count()
    plan = tr.Plan(tr.find_bins(rows, est, n), 5, 2, 1, 0.0, 7)
    picked = plan.pick(3, np.arange(1, 4000, dtype=np.uint64))
    assert (picked[:, 0] < picked[:, 1]).all() and np.allclose(np.bincount(picked.ravel()) / 3999, 0.4, atol=0.04)


def test_stored_form_keeps_every_part(rows):
    est = make_learner("dt", "y", maxDepth=3)
    model, theirs = tr.fit_trees(rows, [(est, {})])[0], fit_learner(est, rows)
    assert model.getLabelCol() == "y" and model.getMaxDepth() == 3 and model.uid == est.uid
    variance = [m.copy({m.varianceCol: "v"}).transform(rows).agg(F.avg("v")).first()[0] for m in (model, theirs)]
    assert variance[0] == pytest.approx(variance[1], rel=1e-6)


def test_odd_rows(spark):
    def fitted(values, kind="dt", **params):
        df = spark.createDataFrame(values, "x double, y double")
        enc = fit_encoders(df, FeatureSpec(label="y", numeric=("x",))).transform(df)
        return predictions(tr.fit_trees(enc, [(make_learner(kind, "y", **params), {})])[0], enc).tolist()
    assert fitted([(1.0, 3.0)]) == [3.0]
    assert fitted([(1.0, 3.0), (2.0, 3.0)]) == [3.0, 3.0]
    assert fitted([(1.0, 3.0), (1.0, 5.0)]) == [4.0, 4.0]
    assert fitted([(-1.0, 3.0), (0.0, 5.0)]) == [3.0, 5.0]
    # a tree that draws no row predicts 0, as MLlib's
    drawn = fitted([(1.0, 3.0), (2.0, 3.0)], "rf", numTrees=20)
    assert drawn[0] == drawn[1] and 1.5 < drawn[0] <= 3.0
    with pytest.raises(Exception):
        fitted([(1.0, None), (2.0, 3.0)])


def test_what_goes_to_mllib(rows):
    for kind, params in [("dt", {"minInstancesPerNode": 2}), ("dt", {"maxBins": 300}), ("rf", {"subsamplingRate": 0.5}),
                         ("rf", {"featureSubsetStrategy": "sqrt"}), ("rf", {"bootstrap": False}), ("rf", {"numTrees": 1}),
                         ("gbt", {"lossType": "absolute"}), ("gbt", {"subsamplingRate": 0.5}), ("linreg", {}), ("dt", {"maxBins": 4})]:
        assert not tr.by_levels(make_learner(kind, "y", **params), {}, rows), (kind, params)


def test_reference_pipelines_pass_no_row_objects_through_levels(spark, sf_small, monkeypatch):
    """Every map of every fold was a fit of MLlib, with all rows in each level of each tree."""
    monkeypatch.setattr(tu, "fit_learner", lambda *a: pytest.fail("a fit on row objects"))
    grown, real = [], tr.grow
    monkeypatch.setattr(tr, "grow", lambda *a: (grown.append(1), real(*a))[1])
    for name, trees in [("ref_rf_holdout", 2), ("ref_dt_holdout", 3), ("rf_fit_eval", 1), ("gbt_fit_eval", 5)]:
        grown.clear()
        assert Q.QUERIES[name](spark, sf_small).count() == 1
        assert len(grown) == trees, name


def test_rows_are_packed_once_for_all_bins(rows, monkeypatch):
    est = make_learner("dt", "y", maxDepth=5)
    packed, real = [], tr._blocks
    monkeypatch.setattr(tr, "_blocks", lambda *a: (packed.append(1), real(*a))[1])
    both = tr.fit_trees(rows, [(est, {est.maxBins: b}) for b in (40, 12)])
    assert len(packed) == 1
    for model, b in zip(both, (40, 12)):
        theirs = fit_learner(est, rows, {est.maxBins: b})
        assert model.getMaxBins() == b and nodes(model) == nodes(theirs)
        assert np.allclose(predictions(model, rows), predictions(theirs, rows), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("kind, params", [("dt", {}), ("rf", {"numTrees": 5}), ("gbt", {"maxIter": 3})])
@pytest.mark.parametrize("entries", [0, 1 << 20])
def test_scores_by_blocks_are_those_of_the_models(rows, monkeypatch, kind, params, entries):
    """Each candidate was stored, loaded by MLlib and walked node by node for each row."""
    monkeypatch.setattr(tr, "STEP_ENTRIES", entries)
    est = make_learner(kind, "y", **params)
    grown = tr.grow_trees(rows, [(est, {est.maxDepth: d}) for d in (0, 3, 7)])
    scored = tr.score_trees(rows, "y", grown, ["a", "b", "c"])
    assert scored.columns == ["y", "a", "b", "c"]
    got = np.array([tuple(r) for r in scored.collect()])
    for column, g in enumerate(grown, 1):
        want = np.array([tuple(r) for r in g.to_model(rows).transform(rows).select("y", "prediction").collect()])
        assert np.allclose(got[:, [0, column]], want, rtol=1e-9, atol=1e-9)


def test_a_search_stores_only_the_model_that_it_returns(spark, sf_small, monkeypatch):
    stored, real = [], tr.to_model
    monkeypatch.setattr(tr, "to_model", lambda *a: (stored.append(1), real(*a))[1])
    assert Q.QUERIES["ref_dt_holdout"](spark, sf_small).count() == 1
    assert len(stored) == 1


def test_rows_of_small_nodes_meet_in_rounds(rows, monkeypatch):
    """All rows of all trees were shuffled, and kept on disk, at once."""
    est = make_learner("rf", "y", maxDepth=8, numTrees=5)
    by_level = tr.fit_trees(rows, [(est, {})])[0]
    n = rows.count()
    rounds, real = [], tr._finish
    monkeypatch.setattr(tr, "_finish", lambda *a: (rounds.append(a[-1]), real(*a))[1])
    monkeypatch.setattr(tr, "LEVEL_BYTES", 0)
    monkeypatch.setattr(tr, "ROUND_ROWS", int(2.5 * n))
    finished = tr.fit_trees(rows, [(est, {})])[0]
    assert len(rounds) >= 2 and sorted(sum(rounds, [])) == list(range(5))
    assert nodes(by_level) == nodes(finished)
    assert np.allclose(predictions(by_level, rows), predictions(finished, rows), rtol=1e-9, atol=1e-9)


def test_bins_travel_in_words():
    x = np.random.default_rng(1).integers(0, [2, 64, 256, 3, 100], (50, 5)).astype(np.uint8)
    bins = tr.Bins([None, *[np.arange(k - 1.0) for k in (64, 256, 3, 100)]], np.array([2, 0, 0, 0, 0]))
    fields = tr._fields(bins)
    assert tr._to_words(x, fields).shape == (50, 3) and (tr._from_words(tr._to_words(x, fields), fields) == x).all()
    assert tr._fields(tr.Bins([np.arange(255.0)] * 9, np.zeros(9, int))) is None


def test_rows_make_room_for_their_blocks(rows, monkeypatch):
    """Encoded rows, blocks and residuals of boosted trees were all kept to the end."""
    est, held, real = make_learner("gbt", "y", maxIter=3), [], tr.grow
    copy = rows.select("*").persist()
    copy.count()
    sc = rows.sparkSession.sparkContext._jsc.sc()
    before = sc.getPersistentRDDs().size()
    monkeypatch.setattr(tr, "grow", lambda *a: (held.append(sc.getPersistentRDDs().size() - before), real(*a))[1])
    grown = tr.grow_trees(copy, [(est, {})], copy.unpersist)
    assert max(held) <= 0 and sc.getPersistentRDDs().size() < before
    assert np.allclose(predictions(grown[0].to_model(rows), rows), predictions(fit_learner(est, rows), rows), rtol=1e-9, atol=1e-9)


def test_boosted_trees_of_two_depths_share_the_first(rows, monkeypatch):
    est = make_learner("gbt", "y", maxIter=3, stepSize=0.3)
    grown, real = [], tr.grow
    monkeypatch.setattr(tr, "grow", lambda *a: (grown.append(1), real(*a))[1])
    both = tr.fit_trees(rows, [(est, {est.maxDepth: d}) for d in (2, 5)])
    assert len(grown) == 5
    for model, depth in zip(both, (2, 5)):
        alone = tr.fit_trees(rows, [(est, {est.maxDepth: depth})])[0]
        assert np.allclose(predictions(model, rows), predictions(alone, rows), rtol=1e-9, atol=1e-9)


def test_encoded_rows_of_trees_are_not_cached(spark, monkeypatch):
    """Vectors of all rows were cached beside the blocks, which took most of the executors' memory."""
    df = spark.range(500).selectExpr("id", "cast(hash(id) % 97 as double) x", "cast(hash(id, 1) % 97 as double) z",
                                     "cast(hash(id) % 97 as double) * 2 + id % 3 y")
    spec, held, real = FeatureSpec(label="y", numeric=("x", "z")), [], tr.grow
    sc = spark.sparkContext._jsc.sc()
    before = sc.getPersistentRDDs().size()
    monkeypatch.setattr(tr, "grow", lambda *a: (held.append(sc.getPersistentRDDs().size() - before), real(*a))[1])
    est = make_learner("gbt", "y", maxIter=1)
    tu.plain_fit(df, spec, est)
    assert held == [1]
    linear = make_learner("linreg", "y")
    cached = tu._Encoded(df, spec, None, False, [(est, {}), (linear, {})])
    assert cached.rows.is_cached
    cached.release()
    assert not tu._Encoded(df, spec, None, False, [(est, {})]).rows.is_cached


def test_split_candidates_of_rows_drawn_before_encoding(spark, monkeypatch):
    """All rows were encoded for a sample of them."""
    df = spark.range(30_000, numPartitions=3).selectExpr("id", "cast(hash(id) % 9973 as double) x", "concat('k', id % 3) g",
                                                         "cast(hash(id) % 97 as double) y")
    spec, est = FeatureSpec(label="y", categorical=("g",), numeric=("x",)), make_learner("dt", "y")
    enc = tu._Encoded(df, spec, 32, False, [(est, {})])
    first, encoded = (tr.find_bins(enc.rows, est, 30_000, d) for d in (enc.drawn, None))
    assert len(first.thresholds[1]) > 20 and (first.thresholds[1] == encoded.thresholds[1]).all()
    assert (first.arity == encoded.arity).all()
