"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator
of the survey. Model fits run when the query is built (they are actions);
scoring and reporting stay lazy so the caller decides when to execute."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from ..operators import evaluate as ev
from ..operators import splits as sp
from ..operators import tuning as tu
from ..operators.features import (CAT_IDX_VEC, FEATURES, NORM_VEC, FeatureSpec, fit_encoders,
                                  vector_columns)
from ..operators.learners import PRESETS, make_learner
from ..operators.prepare import prediction_projection, prepare, rename
from ..session import ensure_checkpoint_dir, scratch_path
from ..sources.files import (read_csv, read_table, register_view, sql_scan, write_csv,
                             write_table)
from . import lineitem as li

PRED_DIGITS = 4
METRIC_DIGITS = 8

# Closed-form configurations (see README). Cells: a tree deep enough to separate the
# (returnflag, linestatus) cells predicts each cell's training mean.
CELL_PARAMS = {
    "dt": {"maxDepth": 5},
    "rf": {"numTrees": 20, "bootstrap": False, "featureSubsetStrategy": "all", "maxDepth": 5},
    "gbt": {"maxIter": 20, "maxDepth": 5},
}
# Factors of (practically) zero and a fixed number of full-batch steps: the model is a linear
# one whose coefficients are a closed expression of training averages.
FM_EXACT = {"initStd": 1e-200, "tol": 0.0, "miniBatchFraction": 1.0, "maxIter": 2}
# Searches over one feature of few distinct values: every map's model is an exact SQL search
# or average, and every learner has another answer. A minInfoGain that no split can reach
# gives the training mean.
NO_SPLIT_GAIN = 1e18
SEARCH_PARAMS = {
    "dt": {"maxBins": 64},
    "rf": {"numTrees": 20, "bootstrap": False, "featureSubsetStrategy": "all", "maxDepth": 1,
           "maxBins": 64},
    "gbt": {"maxDepth": 1, "maxBins": 64},
    "fm": {"solver": "gd", **FM_EXACT},
}
SEARCH_GRIDS = {
    "dt": {"maxDepth": [1, 2]},
    "rf": {"minInfoGain": [0.0, NO_SPLIT_GAIN]},
    "gbt": {"maxIter": [1, 2]},
    "fm": {"stepSize": [0.1, 0.5]},
}
# The comparison lets every learner work in full, and still has an exact answer: trees that tell
# all values of the feature apart, the default numbers of boosting iterations and of solver steps
# (over one feature a factorization machine has no pairs, so its steps are those of a linear model).
COMPARE_PARAMS = {
    "dt": {"maxBins": 64},
    "rf": {"numTrees": 20, "bootstrap": False, "featureSubsetStrategy": "all", "maxBins": 64},
    "gbt": {"maxDepth": 1, "maxBins": 64},
    "fm": {"solver": "gd", "tol": 0.0, "miniBatchFraction": 1.0, "maxIter": 100},
}
COMPARE_GRIDS = {
    "dt": {"maxDepth": [2, 10]},
    "rf": {"maxDepth": [1, 10]},
    "gbt": {"maxIter": [2, 20]},
    "fm": {"stepSize": [0.1, 0.5]},
}


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def _split(spark: SparkSession, sf_dir: str, spec: FeatureSpec) -> tuple[DataFrame, DataFrame]:
    """(train, test) rows with the columns that ``spec`` needs."""
    ensure_checkpoint_dir(spark)
    return li.train_and_test(spark, sf_dir, spec)


def _score(model, test: DataFrame, label: str = li.LABEL) -> DataFrame:
    scored = model.transform(test)
    out = prediction_projection(scored, label, keys=li.KEY)
    return out.select(*li.KEY, F.round("prediction", PRED_DIGITS).alias("prediction"),
                      "trueLabel")


def _round_metrics(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name.endswith("rmse"):
            cols.append(F.round(f.name, PRED_DIGITS).alias(f.name))
        elif f.name.endswith("r2"):
            cols.append(F.round(f.name, METRIC_DIGITS).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ------------------------------------------------------------------ sources

def q_csv_scan(spark, sf_dir):
    """Reference-shaped rows written as CSV with a header, read back with
    ``inferSchema``, then prepared; columns cast to their declared types."""
    path = write_csv(li.raw_frame(spark, sf_dir), scratch_path(spark, "csv_scan"))
    df = prepare(read_csv(spark, path, infer_schema=True), li.PREPARE)
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in PREPARED_TYPES])


RAW_SCHEMA = StructType([
    StructField("l_orderkey", LongType(), False), StructField("l_linenumber", IntegerType(), False),
    StructField("l_partkey", LongType(), False), StructField("l_suppkey", LongType(), False),
    StructField("l_returnflag", StringType(), False), StructField("l_linestatus", StringType(), False),
    StructField("line_label", StringType(), False), StructField("is_discounted", BooleanType(), False),
    StructField("ship_date", StringType(), False), StructField("l_quantity", DoubleType(), False),
    StructField("l_extendedprice", DoubleType(), False), StructField("l_discount", DoubleType(), False),
    StructField("l_tax", DoubleType(), False), StructField("ship_epoch", LongType(), False),
    StructField("price", DoubleType(), False),
])

PREPARED_TYPES = [(f.name, f.dataType.simpleString()) for f in RAW_SCHEMA.fields] + [
    ("ship_month", "int"), ("ship_day", "int"), ("ship_year", "int")]
PREPARED_TYPES = [(c, "int" if c == "is_discounted" else t) for c, t in PREPARED_TYPES]


def q_schema_scan(spark, sf_dir):
    """Headerless CSV read with an explicit StructType: no inference pass."""
    path = write_csv(li.raw_frame(spark, sf_dir), scratch_path(spark, "schema_scan"), header=False)
    return prepare(read_csv(spark, path, schema=RAW_SCHEMA, header=False), li.PREPARE)


def q_view_sql(spark, sf_dir):
    register_view(li.prepared_frame(spark, sf_dir), "prepared_rows")
    return sql_scan(spark, "prepared_rows")


def q_parquet_sink(spark, sf_dir):
    """Prepared rows saved as a parquet table in the shared folder, read back by name."""
    name = write_table(li.prepared_frame(spark, sf_dir), "prepared_sink",
                       scratch_path(spark, "parquet_sink"))
    return spark.table(name)


# ------------------------------------------------------------------ prepare (P, F)

def q_project_cast(spark, sf_dir):
    df = li.prepared_frame(spark, sf_dir)
    cols = df.select(*li.KEY, "l_returnflag", "l_linestatus", "line_label", "is_discounted",
                     "l_quantity", "l_extendedprice", "l_discount", "l_tax", li.LABEL)
    return rename(cols, {li.LABEL: "trueLabel"})


def q_date_parts(spark, sf_dir):
    df = li.prepared_frame(spark, sf_dir)
    return df.select(*li.KEY, "ship_date", "ship_month", "ship_day", "ship_year")


# ------------------------------------------------------------------ splits & counts (D, A)

def q_hash_split(spark, sf_dir):
    df = sp.with_hash_split(li.prepared_frame(spark, sf_dir), li.KEY, 0.7)
    return df.select(*li.KEY, sp.SPLIT_COL)


def q_random_split(spark, sf_dir):
    df = sp.with_random_split(li.prepared_frame(spark, sf_dir), li.KEY, 0.7, seed=42)
    return df.select(*li.KEY, sp.SPLIT_COL)


def q_split_counts(spark, sf_dir):
    df = sp.with_hash_split(li.prepared_frame(spark, sf_dir), li.KEY, 0.7)
    return sp.split_counts(df).withColumnRenamed("rows", "n_rows")


def q_fold_assign(spark, sf_dir):
    train, _ = sp.hash_split(li.prepared_frame(spark, sf_dir), li.KEY, 0.7)
    return sp.with_folds(train, li.KEY, 3).select(*li.KEY, sp.FOLD_COL)


def q_holdout_assign(spark, sf_dir):
    train, _ = sp.hash_split(li.prepared_frame(spark, sf_dir), li.KEY, 0.7)
    return sp.with_holdout_flag(train, li.KEY, 0.8).select(*li.KEY, sp.HOLDOUT_COL)


def q_preview(spark, sf_dir):
    """First 20 rows in order of the row key, which no two rows share."""
    return li.prepared_frame(spark, sf_dir).orderBy(*li.KEY).limit(20)


def q_row_count(spark, sf_dir):
    """Row count of the prepared data (A1)."""
    return sp.row_count(li.prepared_frame(spark, sf_dir)).withColumnRenamed("rows", "n_rows")


def q_schema_report(spark, sf_dir):
    """printSchema + count as a table: one aggregate pass for non-null counts."""
    df = li.prepared_frame(spark, sf_dir)
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    rows = [(i, f.name, f.dataType.simpleString(), int(row[f.name]), int(row["__n"]))
            for i, f in enumerate(df.schema.fields)]
    schema = StructType([StructField("position", IntegerType(), False),
                         StructField("column_name", StringType(), False),
                         StructField("data_type", StringType(), False),
                         StructField("non_null", LongType(), False),
                         StructField("n_rows", LongType(), False)])
    return spark.createDataFrame(rows, schema)


# ------------------------------------------------------------------ encoders (E)

def _encoded_all_rows(spark, sf_dir, spec: FeatureSpec = li.FULL_SPEC) -> DataFrame:
    with persisted(li.encoder_rows(spark, sf_dir, spec)) as t:
        enc = fit_encoders(t, spec)
    return enc.transform(li.pruned(li.prepared_frame(spark, sf_dir), spec))


def q_string_index(spark, sf_dir):
    spec = FeatureSpec(label=li.LABEL, categorical=("l_returnflag", "l_linestatus", "line_label"))
    rows = li.pruned(li.prepared_frame(spark, sf_dir), spec)
    train, _ = sp.hash_split(rows, li.KEY, 0.7)
    out = fit_encoders(train, spec).transform(rows)
    return out.select(*li.KEY, *spec.indexed)


def q_brand_index(spark, sf_dir):
    """Label order on a 25-label column with frequency ties (part.p_brand)."""
    part = read_table(spark, sf_dir, "part")
    spec = FeatureSpec(label="p_retailprice", categorical=("p_brand", "p_type"))
    enc = fit_encoders(part, spec)
    return enc.transform(part).select("p_partkey", *spec.indexed)


def q_vector_index(spark, sf_dir):
    df = _encoded_all_rows(spark, sf_dir)
    return df.select(*li.KEY, *vector_columns(df, CAT_IDX_VEC, "c", len(li.FULL_SPEC.cat_inputs),
                                              METRIC_DIGITS))


def q_minmax_scale(spark, sf_dir):
    df = _encoded_all_rows(spark, sf_dir)
    return df.select(*li.KEY, *vector_columns(df, NORM_VEC, "n", len(li.FULL_SPEC.numeric),
                                              METRIC_DIGITS))


def q_assemble_features(spark, sf_dir):
    df = _encoded_all_rows(spark, sf_dir)
    return df.select(*li.KEY, *vector_columns(df, FEATURES, "f", len(li.FULL_SPEC.slot_names),
                                              METRIC_DIGITS))


# ------------------------------------------------------------------ learners (R)

def _fitted(spark, sf_dir, kind: str, spec: FeatureSpec, params: dict):
    """A plain fit on the training rows, and the test rows. The cached rows are computed only
    for a fit that reads them."""
    train, test = _split(spark, sf_dir, spec)
    with persisted(train) as t:
        return tu.plain_fit(t, spec, make_learner(kind, spec.label, **params),
                            rows=li.train_rows(spark, sf_dir, spec)), test


def _predict(name: str, kind: str, spec: FeatureSpec, params: dict):
    def run(spark, sf_dir):
        return _score(*_fitted(spark, sf_dir, kind, spec, params))
    run.__name__ = f"q_{name}"
    return run


def q_scored_rows(spark, sf_dir):
    """``features, prediction, trueLabel`` of the scored test rows (P5, P6), the
    feature vector given slot by slot."""
    model, test = _fitted(spark, sf_dir, "dt", li.CELL_SPEC, CELL_PARAMS["dt"])
    out = prediction_projection(model.transform(test), li.LABEL, keys=li.KEY, features=True)
    return out.select(*li.KEY, *vector_columns(out, FEATURES, "f", len(li.CELL_SPEC.slot_names)),
                      F.round("prediction", PRED_DIGITS).alias("prediction"), "trueLabel")


# Depth-1 and depth-2 trees and two boosted stumps on the scaled quantity: MLlib's search over
# continuous candidates, its level-wise recursion and its pseudo-residual step.
q_stump_predict = _predict("stump_predict", "dt", li.STUMP_SPEC, {"maxDepth": 1, "maxBins": 64})
q_depth2_predict = _predict("depth2_predict", "dt", li.STUMP_SPEC, {"maxDepth": 2, "maxBins": 64})
q_gbt_stumps_predict = _predict("gbt_stumps_predict", "gbt", li.STUMP_SPEC,
                                {"maxDepth": 1, "maxIter": 2, "maxBins": 64})
# Boosted trees with the reference's plain defaults (depth 5, 20 iterations) on the cells.
q_gbt_plain = _predict("gbt_plain", "gbt", li.CELL_SPEC, PRESETS["gbt_plain"].params)
# Factorization machine: two exact steps by either solver, and the defaults.
q_fm_gd_predict = _predict("fm_gd_predict", "fm", li.SMALL_SPEC,
                           {"solver": "gd", "stepSize": 0.5, **FM_EXACT})
q_fm_adamw_predict = _predict("fm_adamw_predict", "fm", li.SMALL_SPEC,
                              {"solver": "adamW", "stepSize": 1.0, **FM_EXACT})
q_fm_predict = _predict("fm_predict", "fm", li.FEWER_SPEC, {})


def q_fm_identity(spark, sf_dir):
    """Default factorization machine: each prediction against
    ``b + w.x + 1/2 sum_f((sum v x)^2 - sum v^2 x^2)`` with the model's coefficients."""
    model, test = _fitted(spark, sf_dir, "fm", li.FEWER_SPEC, {})
    fm = model.stages[-1]
    x = vector_to_array(FEATURES)
    w, v = fm.linear.toArray().tolist(), fm.factors.toArray().tolist()
    total = F.lit(float(fm.intercept))
    for i, wi in enumerate(w):
        total = total + F.lit(wi) * x[i]
    for f in range(len(v[0])):
        dot = sum((F.lit(v[i][f]) * x[i] for i in range(len(w))), F.lit(0.0))
        squares = sum((F.lit(v[i][f] ** 2) * x[i] * x[i] for i in range(len(w))), F.lit(0.0))
        total = total + F.lit(0.5) * (dot * dot - squares)
    scored = model.transform(test)
    return scored.select(*li.KEY, F.abs(F.round(F.col("prediction") - total, PRED_DIGITS)).alias("error"))


# ------------------------------------------------------------------ selection (T)

def _search_groups(all_params: dict = SEARCH_PARAMS, grids: dict = SEARCH_GRIDS) -> dict:
    out = {}
    for kind, params in all_params.items():
        est = make_learner(kind, li.LABEL, **params)
        out[kind] = (est, tu.build_grid(est, grids[kind]))
    return out


def _search(kind: str, method: str, spark, sf_dir) -> tu.SearchResult:
    train, _ = _split(spark, sf_dir, li.SEARCH_SPEC)
    est, maps = _search_groups()[kind]
    rows = li.train_rows(spark, sf_dir, li.SEARCH_SPEC)
    with persisted(train) as t:
        if method == "cv":
            return tu.cross_validate(spark, t, li.SEARCH_SPEC, est, maps, li.KEY, num_folds=3, rows=rows)
        return tu.holdout_search(spark, t, li.SEARCH_SPEC, est, maps, li.KEY, train_ratio=0.8, rows=rows)


def _search_query(kind: str, method: str):
    def run(spark, sf_dir):
        return _round_metrics(_search(kind, method, spark, sf_dir).metrics)
    run.__name__ = f"q_{kind}_{method}"
    return run


def q_best_params(spark, sf_dir):
    """The winning map: chosen on the metrics as they are, rounded for the report."""
    res = _search("dt", "cv", spark, sf_dir)
    return _round_metrics(tu.best_row(res.metrics.drop("std_r2", "avg_rmse"), "avg_r2"))


# ------------------------------------------------------------------ evaluation (M, X)

def q_eval_metrics(spark, sf_dir):
    """Flagship: hash split, encode, decision tree, score test, R² and RMSE."""
    model, test = _fitted(spark, sf_dir, "dt", li.CELL_SPEC, CELL_PARAMS["dt"])
    return ev.regression_metrics(model.transform(test), li.LABEL, digits=None).select(
        F.round("r2", METRIC_DIGITS).alias("r2"), F.round("rmse", PRED_DIGITS).alias("rmse"), "n")


def q_feature_importance(spark, sf_dir):
    """Boosted trees (reference plain-fit preset) on the full feature set, with
    every importance named by its own slot."""
    model, test = _fitted(spark, sf_dir, "gbt", li.FULL_SPEC, PRESETS["gbt_plain"].params)
    return ev.feature_importances(model, li.FULL_SPEC, model.transform(test))


def q_tree_importance(spark, sf_dir):
    """Importances of a depth-2 tree over three features: gain times rows of every split,
    as shares, largest first."""
    model, test = _fitted(spark, sf_dir, "dt", li.SMALL_SPEC, {"maxDepth": 2, "maxBins": 64})
    table = ev.feature_importances(model, li.SMALL_SPEC, model.transform(test))
    return table.select("feature", F.round("importance", METRIC_DIGITS).alias("importance"))


def q_model_compare(spark, sf_dir):
    """Learner x selection method (M3, U1): per method one search over all learners (each
    fold encoded once and shared by all learners and maps), every learner's best map refitted
    on one shared encoding and scored on the test rows; a table per method, united."""
    train, test = _split(spark, sf_dir, li.SEARCH_SPEC)
    groups = _search_groups(COMPARE_PARAMS, COMPARE_GRIDS)
    rows = li.train_rows(spark, sf_dir, li.SEARCH_SPEC)
    schema = StructType([StructField("learner", StringType(), False),
                         StructField("selection", StringType(), False),
                         StructField("best_map", IntegerType(), False),
                         StructField("test_r2", DoubleType(), True),
                         StructField("test_rmse", DoubleType(), True)])
    tables = []
    with persisted(train) as t:
        for method in ("cv", "holdout"):
            if method == "cv":
                res = tu.cross_validate_many(spark, t, li.SEARCH_SPEC, groups, li.KEY, 3, rows=rows)
            else:
                res = tu.holdout_search_many(spark, t, li.SEARCH_SPEC, groups, li.KEY, 0.8, rows=rows)
            scores = tu.score_results(res, test, li.LABEL)
            table = [(k, method, r.best_index, scores[k]["r2"], scores[k]["rmse"]) for k, r in res.items()]
            tables.append(spark.createDataFrame(table, schema))
    return _round_metrics(ev.comparison_table(tables))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_scan": q_csv_scan,
    "schema_scan": q_schema_scan,
    "view_sql": q_view_sql,
    "parquet_sink": q_parquet_sink,
    "project_cast": q_project_cast,
    "date_parts": q_date_parts,
    "hash_split": q_hash_split,
    "random_split": q_random_split,
    "split_counts": q_split_counts,
    "fold_assign": q_fold_assign,
    "holdout_assign": q_holdout_assign,
    "preview": q_preview,
    "row_count": q_row_count,
    "schema_report": q_schema_report,
    "string_index": q_string_index,
    "brand_index": q_brand_index,
    "vector_index": q_vector_index,
    "minmax_scale": q_minmax_scale,
    "assemble_features": q_assemble_features,
    "two_dates": li.two_dates,
    "dt_predict": _predict("dt_predict", "dt", li.CELL_SPEC, CELL_PARAMS["dt"]),
    "rf_predict": _predict("rf_predict", "rf", li.CELL_SPEC, CELL_PARAMS["rf"]),
    "gbt_predict": _predict("gbt_predict", "gbt", li.CELL_SPEC, CELL_PARAMS["gbt"]),
    "scored_rows": q_scored_rows,
    "stump_predict": q_stump_predict,
    "depth2_predict": q_depth2_predict,
    "gbt_stumps_predict": q_gbt_stumps_predict,
    "fm_predict": q_fm_predict,
    "fm_gd_predict": q_fm_gd_predict,
    "fm_adamw_predict": q_fm_adamw_predict,
    "fm_identity": q_fm_identity,
    "gbt_plain": q_gbt_plain,
    **{f"{kind}_{method}": _search_query(kind, method)
       for kind in SEARCH_GRIDS for method in ("cv", "holdout")},
    "best_params": q_best_params,
    "eval_metrics": q_eval_metrics,
    "feature_importance": q_feature_importance,
    "tree_importance": q_tree_importance,
    "model_compare": q_model_compare,
}


# ------------------------------------------------------------------ reference pipelines
# Full feature set, the reference's learners and grids (PRESETS); answers depend
# on tree induction over continuous features, so these are rows-only checks.

RESULT_SCHEMA = StructType([StructField("learner", StringType(), False),
                            StructField("selection", StringType(), False),
                            StructField("best_params", StringType(), False),
                            StructField("test_r2", DoubleType(), True),
                            StructField("test_rmse", DoubleType(), True),
                            StructField("n_test", LongType(), True)])


def _params_text(pm: dict) -> str:
    return ",".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name))


def run_pipeline(spark, sf_dir, preset: str, selection: str) -> DataFrame:
    """One reference pipeline: prepare, hash split, search (or plain fit), refit,
    score the test rows, R² and RMSE."""
    pre = PRESETS[preset]
    spec = li.SPECS[pre.features]
    train, test = _split(spark, sf_dir, spec)
    est = make_learner(pre.kind, li.LABEL, **pre.params)
    maps = tu.build_grid(est, pre.grid) if selection != "plain" else [{}]
    with persisted(train) as t:
        if selection == "cv":
            res = tu.cross_validate(spark, t, spec, est, maps, li.KEY, num_folds=3)
            model, best = res.model, res.param_maps[res.best_index]
        elif selection == "holdout":
            res = tu.holdout_search(spark, t, spec, est, maps, li.KEY, train_ratio=0.8)
            model, best = res.model, res.param_maps[res.best_index]
        else:
            model, best = tu.plain_fit(t, spec, est), {}
    m = tu.score_fit(model, test, li.LABEL)
    row = (pre.kind, selection, _params_text(best), m["r2"], m["rmse"], m["n"])
    return spark.createDataFrame([row], RESULT_SCHEMA)


FIT_CONFIGS = {
    "dt": {"maxDepth": 6, "maxBins": 65},
    "rf": {"maxDepth": 8, "maxBins": 64, "numTrees": 20},
    "gbt": {"maxDepth": 8, "maxIter": 5, "maxBins": 64},
    "fm": {"stepSize": 1.0, "maxIter": 100, "factorSize": 8},
}


def _fit_eval(kind: str):
    def run(spark, sf_dir):
        model, test = _fitted(spark, sf_dir, kind, li.BASE_SPEC, FIT_CONFIGS[kind])
        return _round_metrics(ev.regression_metrics(model.transform(test), li.LABEL))
    run.__name__ = f"q_{kind}_fit_eval"
    return run


def _reference(preset: str, selection: str):
    def run(spark, sf_dir):
        return run_pipeline(spark, sf_dir, preset, selection)
    run.__name__ = f"q_ref_{preset}_{selection}"
    return run


QUERIES.update({
    "dt_fit_eval": _fit_eval("dt"),
    "rf_fit_eval": _fit_eval("rf"),
    "gbt_fit_eval": _fit_eval("gbt"),
    "fm_fit_eval": _fit_eval("fm"),
    "ref_dt_cv": _reference("dt", "cv"),
    "ref_dt_holdout": _reference("dt", "holdout"),
    "ref_rf_cv": _reference("rf", "cv"),
    "ref_rf_holdout": _reference("rf", "holdout"),
    "ref_gbt_cv": _reference("gbt_cv", "cv"),
    "ref_gbt_holdout": _reference("gbt_holdout", "holdout"),
    "ref_gbt_plain": _reference("gbt_plain", "plain"),
    "ref_fm_cv": _reference("fm", "cv"),
    "ref_fm_holdout": _reference("fm", "holdout"),
})


# ------------------------------------------------------------------ streaming (R6 on a stream)

def q_stream_score(spark, sf_dir):
    """Decision tree (cell features) fitted on train, then test rows scored from a
    parquet file stream into a parquet sink; the sink is read back."""
    from ..streaming.scoring import read_sink, run_to_parquet, score_stream
    model, _ = _fitted(spark, sf_dir, "dt", li.CELL_SPEC, CELL_PARAMS["dt"])
    _, test_rows = sp.hash_split(li.prepared_stream(spark, sf_dir), li.KEY, 0.7)
    scored = score_stream(model, test_rows, li.KEY, li.LABEL)
    base = scratch_path(spark, "stream_score")
    out = read_sink(spark, run_to_parquet(scored, f"{base}/out", f"{base}/_checkpoint"), scored.schema)
    return out.select(*li.KEY, F.round("prediction", PRED_DIGITS).alias("prediction"), "trueLabel")


QUERIES["stream_score"] = q_stream_score
