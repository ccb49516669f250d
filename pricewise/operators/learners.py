"""Regressors (R1-R5), linear models and a tree classifier with explicit seeds, and the
reference's parameter presets.

Training is MLlib's own distributed tree induction, normal equations or quasi-Newton steps
(per-partition sufficient statistics combined with treeAggregate), or the factorization
machine's steps and the trees of ``trees`` over blocks of rows, so no learner ever gathers rows into one task."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.regression import (DecisionTreeRegressor, FMRegressor, GBTRegressor,
                                   LinearRegression, RandomForestRegressor)
from pyspark.sql import DataFrame

from .factorization import by_blocks, fit_machine
from .features import FEATURES

DEFAULT_SEED = 5560

LEARNERS = {
    "dt": DecisionTreeRegressor,
    "rf": RandomForestRegressor,
    "gbt": GBTRegressor,
    "fm": FMRegressor,
    "linreg": LinearRegression,
    "logreg": LogisticRegression,
    "dtc": DecisionTreeClassifier,
}
TREE_KINDS = ("dt", "rf", "gbt", "dtc")


def make_learner(kind: str, label: str, seed: int = DEFAULT_SEED, features: str = FEATURES,
                 prediction: str = "prediction", **params):
    if kind not in LEARNERS:
        raise KeyError(f"unknown learner {kind!r}; choose from {sorted(LEARNERS)}")
    est = LEARNERS[kind](labelCol=label, featuresCol=features, predictionCol=prediction)
    if est.hasParam("seed"):  # linear models draw nothing
        est = est.setParams(seed=seed)
    if kind in TREE_KINDS:
        est = est.setCheckpointInterval(10)
    if params:
        est = est.setParams(**params)
    return est


DEEP_TREE = 10
DEEP_TREE_MEMORY_MB = 1024


def execution_params(est, param_map: dict | None = None) -> dict:
    """``param_map`` plus execution-only settings that do not change the model. A setting
    that the estimator or the map already has is left alone.

    Deep single trees and forests keep node ids in a cached, periodically
    checkpointed RDD instead of shipping the growing trees to every task at each
    level (much less work past depth ~10, and a lineage cut when a checkpoint
    dir is set). Boosting re-grows trees every iteration, where the cache costs
    more than it saves, so it stays off there; deep boosted trees get a larger
    per-task histogram budget instead (fewer node groups, so fewer passes).
    Executors need that headroom per task."""
    pm = dict(param_map or {})
    if not est.hasParam("cacheNodeIds"):
        return pm
    depth_p = est.getParam("maxDepth")
    if pm.get(depth_p, est.getOrDefault(depth_p)) < DEEP_TREE:
        return pm
    name, value = (("maxMemoryInMB", DEEP_TREE_MEMORY_MB) if isinstance(est, GBTRegressor)
                   else ("cacheNodeIds", True))
    p = est.getParam(name)
    if p not in pm and not est.isSet(p):
        pm[p] = value
    return pm


def fit_learner(est, rows: DataFrame, param_map: dict | None = None, weight: str | None = None):
    """``est`` with ``param_map`` fitted on encoded rows; ``weight`` names a column with the number
    of rows that a row stands for."""
    if by_blocks(est, param_map):
        return fit_machine(est, rows, param_map, weight)
    pm = execution_params(est, param_map)
    if weight is None:
        return est.fit(rows, pm)
    model = est.fit(rows, {**pm, est.weightCol: weight})
    model.clear(model.weightCol)  # rows to be scored have none
    return model


def max_bins_of(est, param_map: dict | None = None) -> int | None:
    """Effective maxBins (grid value wins over the constructor) or None for FM."""
    if not est.hasParam("maxBins"):
        return None
    p = est.getParam("maxBins")
    if param_map and p in param_map:
        return int(param_map[p])
    return int(est.getOrDefault(p))


@dataclass(frozen=True)
class Preset:
    """A learner with constructor values, a grid and a feature set, as in one reference file."""
    kind: str
    params: dict = field(default_factory=dict)
    grid: dict = field(default_factory=dict)
    features: str = "base"   # base | base_last (one categorical moved last) | fewer | full


# The learners, constructor arguments and grids the reference tunes.
PRESETS = {
    "dt": Preset("dt", {"maxBins": 3000},
                 {"maxDepth": [6, 9], "minInfoGain": [0.0], "maxBins": [65, 50, 65]}),
    "rf": Preset("rf", {},
                 {"maxDepth": [13, 16], "minInfoGain": [0.0], "maxBins": [64]}),
    "gbt_holdout": Preset("gbt", {},
                          {"maxDepth": [12], "minInfoGain": [0.0], "maxBins": [64], "maxIter": [5]},
                          "base_last"),
    "gbt_cv": Preset("gbt", {},
                     {"maxDepth": [8, 12], "minInfoGain": [0.0], "maxBins": [64], "maxIter": [5]},
                     "base_last"),
    "gbt_plain": Preset("gbt", {"maxBins": 64}, {}, "full"),
    "fm": Preset("fm", {}, {"stepSize": [1.0, 0.5]}, "fewer"),
}
