"""Linear models, one-hot and standard scaling, classification, ranking, ALS, stored models."""
import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel
from pyspark.sql import functions as F

from pricewise.operators import recommend as rec
from pricewise.operators import tuning as tu
from pricewise.operators.evaluate import feature_importances
from pricewise.operators.features import (FEATURES, CardinalityError, FeatureSpec, fit_encoders,
                                          fitted_slot_names)
from pricewise.operators.learners import make_learner
from pricewise.operators.persist import load_model, save_model
from pricewise.operators.ranking import areas, running_counts
from pricewise.plans import lineitem as li
from pricewise.plans import models as M
from pricewise.plans import queries as Q
from pricewise.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    data = [(i, rng.choice("aabbc"), rng.choice("xy"), rng.random() * 10, 7.0) for i in range(300)]
    data = [(*r, {"a": 1.0, "b": 5.0, "c": -2.0}[r[1]] + r[3] + rng.random()) for r in data]
    return spark.createDataFrame(data, "id int, g string, h string, x double, c double, y double").cache()


def features(df):
    return np.array([r[0] for r in df.select(vector_to_array(FEATURES)).collect()])


def test_standard_scaler_and_its_constant_slot(rows):
    spec = FeatureSpec(label="y", numeric=("x", "c"), scaler="standard")
    got = features(fit_encoders(rows, spec).transform(rows))
    x = np.array([r.x for r in rows.select("x").collect()])
    assert np.allclose(got[:, 0], (x - x.mean()) / x.std(ddof=1)) and (got[:, 1] == 0).all()


@pytest.mark.parametrize("drop_last", [True, False])
def test_one_hot_slots_and_names(spark, rows, drop_last):
    spec = FeatureSpec(label="y", categorical=("h",), one_hot=("g",), numeric=("x",), drop_last=drop_last)
    model = fit_encoders(rows, spec)
    names = fitted_slot_names(spec, model)
    labels = [r.g for r in rows.groupBy("g").count().orderBy(F.desc("count"), "g").collect()]
    assert names == ("h", *[f"g={x}" for x in (labels[:-1] if drop_last else labels)], "x")
    got = features(model.transform(rows))
    for i, r in enumerate(rows.select("g").collect()):
        assert [x for x, v in zip(names[1:-1], got[i, 1:-1]) if v] == ([f"g={r.g}"] if f"g={r.g}" in names else [])
    with pytest.raises(ValueError):
        spec.slot_names


@pytest.mark.parametrize("drop_last", [True, False])
def test_one_hot_of_unseen_and_null_labels(spark, rows, drop_last):
    spec = FeatureSpec(label="y", one_hot=("g",), handle_invalid="keep", drop_last=drop_last)
    model = fit_encoders(rows, spec)
    names = fitted_slot_names(spec, model)
    got = features(model.transform(spark.createDataFrame([("zz",), (None,), ("a",)], "g string")))
    assert got.shape == (3, len(names)) and set(names) == {"g=a", "g=b", "g=c"} | (set() if drop_last else {"g="})
    assert (got[0] == got[1]).all() and got[0].sum() == (0 if drop_last else 1)
    assert got[2].sum() == got[2, names.index("g=a")] == 1 and (drop_last or got[0, names.index("g=")] == 1)
    with pytest.raises(Exception, match="Unseen label"):
        strict = fit_encoders(rows, FeatureSpec(label="y", one_hot=("g",)))
        strict.transform(spark.createDataFrame([("zz",)], "g string")).collect()


def test_label_lists_have_a_limit_by_default(spark):
    assert FeatureSpec(label="y", categorical=("g",)).max_labels == 100_000
    df = spark.range(2000).select(F.col("id").cast("string").alias("g"), F.lit(1.0).alias("y"))
    with pytest.raises(CardinalityError):
        fit_encoders(df, FeatureSpec(label="y", one_hot=("g",), max_labels=100))


def test_importances_name_one_hot_slots(rows):
    spec = FeatureSpec(label="y", one_hot=("g",), numeric=("x",), drop_last=False)
    model = tu.plain_fit(rows, spec, make_learner("dt", "y", maxDepth=3))
    table = feature_importances(model, spec, model.transform(rows))
    assert {r.feature for r in table.collect()} == {"g=a", "g=b", "g=c", "x"}


def test_linear_model_on_one_hot_gives_group_means(rows):
    spec = FeatureSpec(label="y", one_hot=("g",))
    model = tu.plain_fit(rows, spec, make_learner("linreg", "y", regParam=0.0, solver="normal"))
    means = {r.g: r.m for r in rows.groupBy("g").agg(F.avg("y").alias("m")).collect()}
    assert all(math.isclose(r.prediction, means[r.g], abs_tol=1e-9) for r in model.transform(rows).collect())


@pytest.mark.parametrize("reg", [0.0, 0.3, 50.0])
def test_ridge_matches_numpy(rows, reg):
    spec = FeatureSpec(label="y", one_hot=("g",), numeric=("x",), scaler="standard")
    model = tu.plain_fit(rows, spec, make_learner("linreg", "y", regParam=reg))
    data = model.transform(rows)
    x, y = features(data), np.array([r.y for r in data.select("y").collect()])
    z = (x - x.mean(0)) / x.std(0)
    n = len(y)
    k = np.linalg.solve(z.T @ z / n + reg / y.std() * np.eye(z.shape[1]), z.T @ ((y - y.mean()) / y.std()) / n)
    assert np.allclose(model.stages[-1].coefficients.toArray(), k * y.std() / x.std(0), atol=1e-7)


def test_saturated_logistic_model_gives_shares(spark, rows):
    flag = rows.withColumn("flag", (F.col("y") > 8).cast("int"))
    spec = FeatureSpec(label="flag", one_hot=("g",))
    model = tu.plain_fit(flag, spec, make_learner("logreg", "flag", **M.SATURATED))
    share = {r.g: r.s for r in flag.groupBy("g").agg(F.avg("flag").alias("s")).collect()}
    for r in model.transform(flag).select("g", vector_to_array("probability")[1].alias("p")).distinct().collect():
        assert abs(r.p - share[r.g]) < 1e-6


def test_forest_is_the_mean_of_trees_that_differ(rows):
    spec = FeatureSpec(label="y", categorical=("g", "h"), numeric=("x",))
    model = tu.plain_fit(rows, spec, make_learner("rf", "y", numTrees=7, maxDepth=4, featureSubsetStrategy="onethird"))
    forest = model.stages[-1]
    x = features(model.transform(rows))
    each = np.array([[t.predict(Vectors.dense(v)) for t in forest.trees] for v in x[:60]])
    assert all(isinstance(t, DecisionTreeRegressionModel) for t in forest.trees)
    assert (each.std(axis=1) > 0).any() and len({t.toDebugString.split("\n", 1)[1] for t in forest.trees}) > 1
    assert np.allclose(each.mean(axis=1), [forest.predict(Vectors.dense(v)) for v in x[:60]])
    y = [r.y for r in rows.select("y").collect()]
    assert each.min() >= min(y) and each.max() <= max(y)


# ---------------------------------------------------------------- ranking

def brute_areas(pairs):
    pairs = [(y, s) for y, s in pairs if y is not None and s is not None]
    p, n = sum(y for y, _ in pairs), sum(1 - y for y, _ in pairs)
    roc = sum((a > b) + (a == b) / 2 for y, a in pairs if y for z, b in pairs if not z)
    points, tp, seen = [], 0, 0
    for s in sorted({s for _, s in pairs}, reverse=True):
        own = [y for y, t in pairs if t == s]
        tp, seen = tp + sum(own), seen + len(own)
        points.append((tp / p if p else 0, tp / seen))
    pr = sum((r - q[0]) * (k + q[1]) / 2 for (r, k), q in zip(points, [(0, points[0][1] if points else 0), *points]))
    return (roc / (p * n) if p and n else None, pr if p else None, p, n)


def close(a, b):
    return all((x is None) == (y is None) and (x is None or math.isclose(x, y, abs_tol=1e-9)) for x, y in zip(a, b))


@pytest.mark.parametrize("kind", ["many", "ties", "one value", "no positives", "no negatives", "empty"])
def test_areas_match_brute_force(spark, kind):
    rng = random.Random(7)
    pairs = [(int(rng.random() < 0.3), rng.random() if kind == "many" else float(rng.randrange(6))) for _ in range(300)]
    if kind == "one value":
        pairs = [(y, 1.0) for y, _ in pairs]
    if kind in ("no positives", "no negatives"):
        pairs = [(int(kind == "no negatives"), s) for _, s in pairs]
    if kind == "empty":
        pairs = []
    pairs += [(None, 0.5), (1, None)]
    df = spark.createDataFrame(pairs, "y int, s double").repartition(3)
    assert close(areas(df, "y", "s", partitions=5).first(), brute_areas(pairs))
    if kind in ("many", "ties"):
        known = df.dropna()
        for metric, got in zip(("areaUnderROC", "areaUnderPR"), areas(df, "y", "s").first()):
            own = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", metricName=metric, numBins=0)
            assert math.isclose(own.evaluate(known), got, rel_tol=1e-9)


def test_running_counts_need_no_single_partition(spark):
    df = spark.range(5000).select((F.col("id") % 3 == 0).cast("int").alias("y"), F.col("id").cast("double").alias("s"))
    got = running_counts(df, "y", "s", partitions=6)
    assert got.groupBy(F.spark_partition_id()).count().count() > 1
    r = {x.score: (x.above_pos, x.above_neg) for x in got.collect()}
    assert r[0.0] == (1666, 3333) and r[4999.0] == (0, 0) and len(r) == 5000


# ---------------------------------------------------------------- recommendation

def ratings(spark, seed=3):
    rng = random.Random(seed)
    users, items = ([rng.uniform(0.5, 2) for _ in range(n)] for n in (40, 30))
    return spark.createDataFrame([(u, i, users[u] * items[i] + rng.gauss(0, 0.05)) for u in range(40)
                                  for i in rng.sample(range(30), 12)], "user int, item int, rating double")


def test_half_step_is_the_step_of_mllib(spark):
    df = ratings(spark)
    model = rec.fit_als(df, rank=1, reg=0.2, iterations=3)
    held = model.itemFactors.select(F.col("id").alias("item"), F.col("features")[0].cast("double").alias("factor"))
    got = {r.user: r.factor for r in rec.half_step(df, held, 0.2).collect()}
    want = {r.id: r.features[0] for r in model.userFactors.collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[u], want[u], rel_tol=1e-4) for u in want)


def test_half_step_cases(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 2, 3.0), (2, 9, 1.0)], "user int, item int, rating double")
    held = spark.createDataFrame([(1, 1.0), (2, 2.0)], "item int, factor double")
    assert [tuple(r) for r in rec.half_step(df, held, 0.5).collect()] == [(1, 8 / 6)]
    twice = spark.createDataFrame([(1, 1, 2.0), (1, 1, 4.0), (None, 1, 1.0), (1, 2, None)], "u int, i int, r double")
    assert [tuple(r) for r in rec.one_rating(twice, "u", "i", "r").collect()] == [(1, 1, 3.0)]


def test_als_beats_the_mean_and_its_cold_start(spark):
    df = ratings(spark)
    train, test = df.filter("(user + item) % 5 > 0"), df.filter("(user + item) % 5 = 0")
    model = rec.fit_als(train, rank=2, reg=0.05)
    r = rec.held_out_error(model, train, test).first()
    assert r.rmse < r.rmse_of_mean / 2 and r.n_scored == test.count()
    new = spark.createDataFrame([(999, 1, 1.0), (1, 1, 1.0)], "user int, item int, rating double")
    assert model.transform(new).count() == 1
    kept = rec.fit_als(train, rank=2, reg=0.05, cold_start="nan").transform(new).collect()
    assert sorted(math.isnan(x.prediction) for x in kept) == [False, True]
    with pytest.raises(ValueError):
        rec.fit_als(train, cold_start="zero")


def test_als_query_beats_the_mean(spark, sf_small):
    r = M.q_als_predict(spark, sf_small).first()
    assert r.n_scored > 0 and r.rmse < r.rmse_of_mean


def test_als_query_makes_its_ratings_once(spark, sf_small, monkeypatch):
    """The held-out part was joined from the tables a second time."""
    plans, real = [], M.rec.held_out_error

    def spy(model, train, test):
        plans.extend(df._jdf.queryExecution().executedPlan().toString() for df in (train, test))
        return real(model, train, test)
    monkeypatch.setattr(M.rec, "held_out_error", spy)
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    out = M.q_als_predict(spark, sf_small)
    assert len(plans) == 2 and all("InMemoryTableScan" in p for p in plans)
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() <= before


# ---------------------------------------------------------------- stored models

def test_stored_model_scores_as_the_fitted_one(spark, rows):
    spec = FeatureSpec(label="y", categorical=("g",), one_hot=("h",), numeric=("x",), scaler="standard")
    model = tu.plain_fit(rows, spec, make_learner("gbt", "y", maxIter=3))
    path = save_model(model, scratch_path(spark, "stored"))
    again = load_model(spark.newSession(), path, GBTRegressionModel)
    a, b = ([(r.id, r.prediction) for r in m.transform(rows).orderBy("id").collect()] for m in (model, again))
    assert a == b
    with pytest.raises(TypeError):
        load_model(spark, path, DecisionTreeRegressionModel)
    with pytest.raises(Exception):
        save_model(model, path)
    assert save_model(model, path, overwrite=True) == path


def test_first_factors_are_those_of_the_seed(spark, sf_small):
    still = {**M.FM_FACTORS, "stepSize": 1e-300, "maxIter": 1}
    model, _ = Q._fitted(spark, sf_small, "fm", li.SMALL_SPEC, still)
    assert np.allclose(model.stages[-1].factors.toArray(), M.FM_FIRST, atol=0, rtol=1e-12)
