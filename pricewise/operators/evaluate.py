"""Evaluation and explanation.

Metrics are one global aggregate with partial aggregation per task: R² and RMSE
of any number of prediction columns in a single pass over the scored rows.
``var_pop`` is Spark's numerically stable central-moment aggregate, the same
quantity RegressionEvaluator uses for the total sum of squares."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .equal_rows import HIGH, LOW, ROWS, SPREAD, is_collapsed
from .features import FEATURES, FeatureSpec, fitted_slot_names


def metric_columns(label: str, prediction: str, suffix: str = "") -> list:
    """R² and RMSE aggregates. With a constant label R² is minus infinity, or NaN where the
    prediction is exact, as RegressionEvaluator has it (a division by zero)."""
    err2 = F.pow(F.col(label) - F.col(prediction), 2)
    mse = F.avg(err2)
    spread = F.var_pop(F.col(label))
    flat = F.when(mse > 0, F.lit(float("-inf"))).when(mse == 0, F.lit(float("nan")))
    return [
        F.when(spread == 0, flat).otherwise(F.lit(1.0) - F.try_divide(mse, spread))
        .alias(f"r2{suffix}"),
        F.sqrt(mse).alias(f"rmse{suffix}"),
    ]


def regression_metrics(scored: DataFrame, label: str, prediction: str = "prediction",
                       digits: int | None = None) -> DataFrame:
    """One-row DataFrame ``r2, rmse, n`` of a scored frame (lazy)."""
    out = scored.agg(*metric_columns(label, prediction), F.count(F.lit(1)).alias("n"))
    if digits is not None:
        out = out.select(F.round("r2", digits).alias("r2"), F.round("rmse", digits).alias("rmse"),
                         "n")
    return out


def multi_metrics(scored: DataFrame, label: str, predictions: Sequence[str]) -> list[dict]:
    """R²/RMSE of several prediction columns from ONE pass; returns small dicts."""
    if is_collapsed(scored):
        return _collapsed_metrics(scored, label, predictions)
    cols = []
    for i, p in enumerate(predictions):
        cols += metric_columns(label, p, f"_{i}")
    row = scored.agg(*cols, F.count(F.lit(1)).alias("n")).first()
    return [{"r2": row[f"r2_{i}"], "rmse": row[f"rmse_{i}"], "n": row["n"]}
            for i in range(len(predictions))]


def _collapsed_metrics(scored: DataFrame, label: str, predictions: Sequence[str]) -> list[dict]:
    """The same from rows that stand for several: the squared errors around a prediction are those
    of the mean label and the spread around it."""
    n, y = F.col(ROWS), F.col(label)
    whole = scored.agg(F.sum(n).alias("n"), (F.sum(n * y) / F.sum(n)).alias("mean"),
                       F.min(LOW).alias("low"), F.max(HIGH).alias("high")).first()
    if not whole["n"]:
        return [{"r2": None, "rmse": None, "n": 0} for _ in predictions]

    def mean_square(center):
        return F.sum(n * (F.col(SPREAD) + F.pow(y - center, 2))) / F.lit(whole["n"])
    row = scored.agg(mean_square(F.lit(whole["mean"])).alias("total"),
                     *[mean_square(F.col(p)).alias(f"mse_{i}") for i, p in enumerate(predictions)]).first()
    out = []
    for i in range(len(predictions)):
        mse = row[f"mse_{i}"]
        if mse is None:
            r2 = None
        elif whole["low"] == whole["high"]:
            r2 = float("-inf") if mse > 0 else float("nan")
        else:
            r2 = 1.0 - mse / row["total"]
        out.append({"r2": r2, "rmse": None if mse is None else math.sqrt(mse), "n": int(whole["n"])})
    return out


def evaluate(scored: DataFrame, label: str, metric: str = "r2", prediction: str = "prediction"
             ) -> float:
    row = scored.agg(*metric_columns(label, prediction)).first()
    return float(row[metric])


IMPORTANCE_SCHEMA = StructType([StructField("feature", StringType(), False),
                                StructField("importance", DoubleType(), False)])


def feature_importances(model: PipelineModel, spec: FeatureSpec, scored: DataFrame) -> DataFrame:
    """(feature, importance) of the last stage, named slot by slot, sorted high to low.

    Slot order is fixed by the assembler: categorical slots (flags, indexed strings,
    int categoricals), one-hot slots, then scaled numerics. The slot count that ``scored`` (a frame the
    model has transformed) carries in its ``ml_attr`` metadata is checked against the names.
    """
    learner = model.stages[-1]
    if not hasattr(learner, "featureImportances"):
        raise TypeError(f"{type(learner).__name__} has no feature importances")
    values = learner.featureImportances.toArray().tolist()
    names = list(fitted_slot_names(spec, model))
    n_attrs = scored.schema[FEATURES].metadata.get("ml_attr", {}).get("num_attrs")
    if n_attrs is not None and n_attrs != len(names):
        raise ValueError(f"features has {n_attrs} slots, spec names {len(names)}")
    if len(values) != len(names):
        raise ValueError(f"{len(values)} importances for {len(names)} named slots")
    # Bounded by the number of features, not by data size.
    df = scored.sparkSession.createDataFrame(list(zip(names, [float(v) for v in values])),
                                             IMPORTANCE_SCHEMA)
    return df.orderBy(F.desc("importance"), F.asc("feature"))


def comparison_table(rows: Sequence[DataFrame]) -> DataFrame:
    """Union of per-learner metric rows."""
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
