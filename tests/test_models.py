import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewise.operators import evaluate as ev
from pricewise.operators import splits as sp
from pricewise.operators import tuning as tu
from pricewise.operators.learners import PRESETS, execution_params, make_learner
from pricewise.plans import lineitem as li
from pricewise.plans import queries as Q


@pytest.fixture(scope="module")
def split(spark, sf_small):
    train, test = Q._split(spark, sf_small, li.FULL_SPEC)
    train = train.cache()
    yield train, test
    train.unpersist()


def _cell_means(train):
    return {(r[0], r[1]): r[2] for r in
            train.groupBy("l_returnflag", "l_linestatus").agg(F.avg("price")).collect()}


@pytest.mark.parametrize("kind", ["dt", "rf", "gbt"])
def test_closed_form_cell_means(spark, split, kind):
    train, test = split
    model = tu.plain_fit(train, li.CELL_SPEC, make_learner(kind, li.LABEL, **Q.CELL_PARAMS[kind]))
    means = _cell_means(train)
    for r in model.transform(test).select("l_returnflag", "l_linestatus", "prediction").collect():
        assert abs(r.prediction - means[(r.l_returnflag, r.l_linestatus)]) < 1e-6


def test_metrics_match_numpy(spark, split):
    train, test = split
    model = tu.plain_fit(train, li.CELL_SPEC, make_learner("dt", li.LABEL, maxDepth=5))
    scored = model.transform(test)
    y, p = map(np.array, zip(*[(r.price, r.prediction) for r in scored.select("price", "prediction").collect()]))
    m = ev.regression_metrics(scored, li.LABEL).first()
    assert math.isclose(m.r2, 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum(), rel_tol=1e-9, abs_tol=1e-12)
    assert math.isclose(m.rmse, math.sqrt(((y - p) ** 2).mean()), rel_tol=1e-9)
    from pyspark.ml.evaluation import RegressionEvaluator
    assert math.isclose(m.r2, RegressionEvaluator(labelCol="price", metricName="r2").evaluate(scored),
                        rel_tol=1e-9, abs_tol=1e-12)


def test_learnable_label(spark, split):
    train, test = split
    model = tu.plain_fit(train, li.BASE_SPEC, make_learner("gbt", li.LABEL, maxDepth=5, maxIter=5))
    assert ev.evaluate(model.transform(test), li.LABEL) > 0.95


def test_fm_score_identity(spark, split):
    train, test = split
    model = tu.plain_fit(train, li.BASE_SPEC, make_learner("fm", li.LABEL, maxIter=5))
    fm = model.stages[-1]
    b, w, V = fm.intercept, fm.linear.toArray(), fm.factors.toArray()
    for r in model.transform(test).select("features", "prediction").limit(50).collect():
        x = r.features.toArray()
        inter = 0.5 * (((V.T @ x) ** 2) - ((V.T ** 2) @ (x ** 2))).sum()
        assert math.isclose(b + w @ x + inter, r.prediction, rel_tol=1e-9, abs_tol=1e-6)


def test_importances_named_and_sum_to_one(spark, split):
    train, _ = split
    model = tu.plain_fit(train, li.FULL_SPEC, make_learner("gbt", li.LABEL, maxIter=3))
    scored = model.transform(train)
    imp = ev.feature_importances(model, li.FULL_SPEC, scored).collect()
    with pytest.raises(ValueError, match="slots"):
        ev.feature_importances(model, li.BASE_SPEC, scored)
    assert [r.feature for r in imp if r.feature] and len(imp) == len(li.FULL_SPEC.slot_names)
    assert set(r.feature for r in imp) == set(li.FULL_SPEC.slot_names)
    assert math.isclose(sum(r.importance for r in imp), 1.0, rel_tol=1e-9)
    vals = [r.importance for r in imp]
    assert vals == sorted(vals, reverse=True)
    # the label is extendedprice * (1-discount) * (1+tax): the price slot must dominate
    assert imp[0].feature == "l_extendedprice"


def test_grid_dedupe_and_table(spark):
    est = make_learner("dt", li.LABEL, **PRESETS["dt"].params)
    maps = tu.build_grid(est, PRESETS["dt"].grid)
    assert len(maps) == 4
    assert len(tu.build_grid(est, PRESETS["dt"].grid, dedupe=False)) == 6
    t = tu.grid_table(spark, maps).collect()
    assert [(r.maxDepth, r.maxBins) for r in t] == [(6.0, 65.0), (6.0, 50.0), (9.0, 65.0), (9.0, 50.0)]


def test_execution_params_by_depth(spark):
    dt = make_learner("dt", "y")
    gbt = make_learner("gbt", "y")
    deep = {dt.getParam("maxDepth"): 16}
    assert execution_params(dt, deep)[dt.getParam("cacheNodeIds")] is True
    assert execution_params(dt, {}) == {}
    gbt_deep = execution_params(gbt, {gbt.getParam("maxDepth"): 12})
    assert gbt.getParam("cacheNodeIds") not in gbt_deep
    assert gbt_deep[gbt.getParam("maxMemoryInMB")] == 1024
    assert dt.getParam("maxMemoryInMB") not in execution_params(dt, deep)
    fm = make_learner("fm", "y")
    assert execution_params(fm, {}) == {}


def test_execution_params_leave_set_values_alone(spark):
    shallow = make_learner("dt", "y", cacheNodeIds=True, maxDepth=3)
    assert execution_params(shallow, {}) == {}
    off = make_learner("rf", "y", cacheNodeIds=False, maxDepth=12)
    assert execution_params(off, {}) == {}
    big = make_learner("gbt", "y", maxMemoryInMB=4096, maxDepth=12)
    assert execution_params(big, {}) == {}
    gbt = make_learner("gbt", "y", maxDepth=12)
    own = {gbt.getParam("maxMemoryInMB"): 300}
    assert execution_params(gbt, own) == own


def test_grids_over_text_and_flags(spark):
    rf = make_learner("rf", "y")
    maps = tu.build_grid(rf, {"featureSubsetStrategy": ["all", "sqrt"], "bootstrap": [True, False], "maxDepth": [2]})
    t = tu.grid_table(spark, maps)
    assert dict(t.dtypes) == {"map_id": "int", "featureSubsetStrategy": "string", "bootstrap": "boolean",
                              "maxDepth": "double"}
    assert [(r.featureSubsetStrategy, r.bootstrap) for r in t.collect()] == [
        ("all", True), ("all", False), ("sqrt", True), ("sqrt", False)]


def test_text_valued_search(spark, split):
    train, _ = split
    est = make_learner("fm", li.LABEL, **Q.FM_EXACT)
    maps = tu.build_grid(est, {"solver": ["gd", "adamW"]})
    res = tu.holdout_search(spark, train, li.SEARCH_SPEC, est, maps, li.KEY)
    assert [r.solver for r in res.metrics.orderBy("map_id").collect()] == ["gd", "adamW"]


def test_cross_validate_equals_cross_validator(spark, split):
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator

    from pricewise.operators.features import encoder_stages
    train, _ = split
    est = make_learner("dt", li.LABEL, maxBins=64)
    maps = tu.build_grid(est, {"maxDepth": [2, 5], "minInfoGain": [0.0, 1e6]})
    ours = tu.cross_validate(spark, train, li.BASE_SPEC, est, maps, li.KEY, num_folds=3)
    cv = CrossValidator(estimator=Pipeline(stages=[*encoder_stages(li.BASE_SPEC), est]), estimatorParamMaps=maps,
                        evaluator=RegressionEvaluator(labelCol=li.LABEL, metricName="r2"), numFolds=3,
                        foldCol=sp.FOLD_COL).fit(sp.with_folds(train, li.KEY, 3))
    assert [m["score"] for m in ours.per_map] == pytest.approx(cv.avgMetrics, abs=1e-9)
    assert ours.best_index == int(np.argmax(cv.avgMetrics))
    assert [r.std_r2 for r in ours.metrics.orderBy("map_id").collect()] == pytest.approx(cv.stdMetrics, abs=1e-9)


def test_models_are_scored_in_bounded_groups(spark, split, monkeypatch):
    train, test = split
    groups = {k: v for k, v in Q._search_groups().items() if k in ("dt", "gbt")}
    whole = tu.holdout_search_many(spark, train, li.SEARCH_SPEC, groups, li.KEY)
    monkeypatch.setattr(tu, "SCORED_NODES", 1)
    parts = tu.holdout_search_many(spark, train, li.SEARCH_SPEC, groups, li.KEY)
    for k in groups:
        assert [m["score"] for m in parts[k].per_map] == pytest.approx([m["score"] for m in whole[k].per_map])
    models = [r.learner for r in whole.values()]
    assert [len(g) for g in tu.model_groups(models, 1)] == [1, 1]
    assert [len(g) for g in tu.model_groups(models, 10**6)] == [2]


def test_constant_label_is_defined(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (1.0, 1.0, 1.0)], "y double, exact double, off double")
    m = ev.multi_metrics(df, "y", ["exact", "off"])
    assert math.isnan(m[0]["r2"]) and m[1]["r2"] == -math.inf and m[0]["rmse"] == 0.0
    with pytest.raises(ValueError, match="undefined"):
        tu._best([float("nan"), None], "r2")


_CORES = """
import sys
sys.path.insert(0, {root!r})
from pricewise.session import local_session
from pricewise.operators import evaluate as ev, tuning as tu
from pricewise.operators.learners import make_learner
from pricewise.plans import lineitem as li
spark = local_session(int(sys.argv[1]), shuffle_partitions=int(sys.argv[1]))
train, test = li.train_and_test(spark, {sf!r}, li.BASE_SPEC)
model = tu.plain_fit(train, li.BASE_SPEC, make_learner("rf", li.LABEL, numTrees=5, maxDepth=6))
m = ev.multi_metrics(model.transform(test), li.LABEL, ["prediction"])[0]
print("METRICS", round(m["r2"], 10), round(m["rmse"], 6))
"""


def test_sampled_forest_does_not_depend_on_cores(sf_small):
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = _CORES.format(root=root, sf="/root/testdata/sf0.01")
    said = [subprocess.run([sys.executable, "-c", code, n], capture_output=True, text=True, timeout=600,
                           env=os.environ | {"PRICEWISE_DRIVER_MEMORY": "4g"}).stdout for n in ("4", "8")]
    lines = [[x for x in s.splitlines() if x.startswith("METRICS")] for s in said]
    assert lines[0] == lines[1] and len(lines[0]) == 1


def test_cv_best_is_argmax_and_refit(spark, split):
    train, test = split
    est, maps = Q._search_groups()["dt"]
    res = tu.cross_validate(spark, train, li.SEARCH_SPEC, est, maps, li.KEY, num_folds=3)
    scores = [m["score"] for m in res.per_map]
    assert res.best_index == int(np.argmax(scores))
    rows = res.metrics.orderBy("map_id").collect()
    assert [r.avg_r2 for r in rows] == pytest.approx(scores)
    assert res.model.transform(test).count() == test.count()
    again = tu.cross_validate(spark, train, li.SEARCH_SPEC, est, maps, li.KEY, num_folds=3)
    assert [m["score"] for m in again.per_map] == pytest.approx(scores, abs=1e-12)


def test_holdout_search(spark, split):
    train, _ = split
    est, maps = Q._search_groups()["rf"]
    res = tu.holdout_search(spark, train, li.SEARCH_SPEC, est, maps, li.KEY, train_ratio=0.8)
    assert res.metrics.count() == 2
    assert res.best_params["minInfoGain"] in (0.0, 1e18)


def test_empty_validation_fold_is_an_error(spark, split):
    train, _ = split
    est = make_learner("dt", li.LABEL, maxDepth=3)
    data = train.withColumn(sp.FOLD_COL, F.lit(0))
    with pytest.raises(ValueError, match="empty"):
        tu.cross_validate(spark, data, li.CELL_SPEC, est, [{}], li.KEY, num_folds=2)


def test_multi_learner_search_matches_single(spark, split):
    train, test = split
    groups = {k: v for k, v in Q._search_groups().items() if k in ("dt", "gbt")}
    many = tu.holdout_search_many(spark, train, li.SEARCH_SPEC, groups, li.KEY, 0.8)
    for kind, (est, maps) in groups.items():
        one = tu.holdout_search(spark, train, li.SEARCH_SPEC, est, maps, li.KEY, 0.8)
        assert [m["score"] for m in one.per_map] == pytest.approx(
            [m["score"] for m in many[kind].per_map], abs=1e-9)
        assert one.best_index == many[kind].best_index
    shared = tu.score_results(many, test, li.LABEL)
    for kind, res in many.items():
        alone = ev.multi_metrics(res.model.transform(test), li.LABEL, ["prediction"])[0]
        assert shared[kind]["r2"] == pytest.approx(alone["r2"], abs=1e-12)
        assert shared[kind]["rmse"] == pytest.approx(alone["rmse"], rel=1e-12)


def test_evaluator_picks_lowest_rmse():
    assert tu._best([3.0, 1.0, 2.0], "rmse") == 1
    assert tu._best([3.0, 1.0, 3.0], "r2") == 0
    assert tu._best([float("nan"), 0.5], "r2") == 1


def test_comparison_table_unions_by_name(spark):
    a = spark.createDataFrame([("dt", 0.5)], "learner string, r2 double")
    b = spark.createDataFrame([(0.7, "rf")], "r2 double, learner string")
    rows = ev.comparison_table([a, b]).orderBy("learner").collect()
    assert [(r.learner, r.r2) for r in rows] == [("dt", 0.5), ("rf", 0.7)]
