"""Rows of equal inputs as one row with a weight.

Under squared error a learner that draws no rows sees rows of equal inputs only through their
number and their mean label: the spread of the labels around that mean is the same for every
split, gradient or prediction, so gains, leaves, steps and models are the same up to the order of
sums. Where inputs repeat (categoricals, numerics of few values) one aggregate with partial
aggregation then replaces the rows in every later pass; where they don't, rows are left as they are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .factorization import by_blocks
from .features import SKETCH_RSD, FeatureSpec

#: Columns of ``collapse``: number of rows, the labels' variance around their mean, their range.
ROWS, SPREAD, LOW, HIGH = "_rows", "_spread", "_low", "_high"
#: Rows are collapsed if there are about so many different inputs at most, and so many rows of each.
MAX_INPUTS = 200_000
ROWS_PER_INPUT = 4


def by_weights(est, param_map: dict | None = None) -> bool:
    """Whether rows of equal inputs may stand as one with a weight: squared error, no row is
    drawn, no limit counts rows."""
    if by_blocks(est, param_map):
        return True
    if not isinstance(est, (DecisionTreeRegressor, RandomForestRegressor, GBTRegressor)):
        return False
    e = est.copy(param_map or {})
    if (e.getMinInstancesPerNode() != 1 or e.getMinWeightFractionPerNode() != 0.0
            or e.isDefined("weightCol")):
        return False
    if isinstance(est, DecisionTreeRegressor):
        return True
    if e.getSubsamplingRate() != 1.0:
        return False
    if isinstance(est, RandomForestRegressor):
        return not e.getBootstrap()
    return e.getLossType() == "squared" and not e.isDefined("validationIndicatorCol")


def few_inputs(rows: DataFrame, spec: FeatureSpec) -> bool:
    """Whether ``rows`` are many for their different inputs, by a sketch: one pass."""
    row = rows.agg(F.count(F.lit(1)).alias("n"),
                   F.approx_count_distinct(F.xxhash64(*spec.input_columns), SKETCH_RSD).alias("inputs")).first()
    return row["inputs"] <= MAX_INPUTS and row["inputs"] * ROWS_PER_INPUT <= row["n"]


def may_collapse(cands: Sequence[tuple], spec: FeatureSpec) -> bool:
    """Whether every (estimator, map) pair and the encoders take weighted rows. The deviation of
    a standard scaler counts rows, and an index kept for unseen labels needs a bin that
    MLlib grants by the number of rows only."""
    return (spec.scaler == "minmax" and spec.handle_invalid != "keep"
            and all(by_weights(est, pm) for est, pm in cands))


def collapse(rows: DataFrame, spec: FeatureSpec, by: Sequence[str] = ()) -> DataFrame:
    """A row for each ``by`` and inputs: the mean label, and ``ROWS`` to ``HIGH``. A missing label
    leaves the mean missing, so that a fit on it fails as it does on the rows."""
    y = F.col(spec.label).cast("double")
    low, high = F.min(y), F.max(y)
    mean = F.when(F.count(y) < F.count(F.lit(1)), F.lit(None)).when(low == high, low).otherwise(F.avg(y))
    return rows.groupBy(*by, *spec.input_columns).agg(
        mean.alias(spec.label), F.count(F.lit(1)).cast("double").alias(ROWS),
        F.var_pop(y).alias(SPREAD), low.alias(LOW), high.alias(HIGH))


def is_collapsed(df: DataFrame) -> bool:
    return ROWS in df.columns
