"""Model selection (T1-T5): parameter grids, k-fold search on a hash fold column,
hold-out search on a hash validation flag, plain fit, best-map choice.

Per fold the encoders are fitted once on that fold's training rows (exactly what
refitting the whole pipeline per map gives, since no grid value touches an
encoder), the encoded rows are persisted once (as blocks of bins for trees) and shared by every map, maps
are fitted in a bounded thread pool, and the maps of a fold are scored together:
one aggregate pass over the validation rows for each group of models of bounded size.

Where every learner takes weighted rows and inputs repeat, one aggregate by fold and inputs
(``equal_rows``) stands for the rows in all of this."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, StringType, StructField,
                               StructType)

from .equal_rows import HIGH, LOW, ROWS, SPREAD, collapse, few_inputs, is_collapsed, may_collapse
from .evaluate import multi_metrics
from .features import (FEATURES, FeatureSpec, check_bins, check_cardinality,
                       fit_encoders, label_limit_of)
from .learners import fit_learner, max_bins_of
from .splits import FOLD_COL, HOLDOUT_COL, with_folds, with_holdout_flag
from .trees import Grown, by_levels, draw, grow_trees, score_trees

HIGHER_IS_BETTER = {"r2": True, "rmse": False}
#: Models are shipped to the executors to score with: at most so many tree nodes (or
#: coefficients) in one pass.
SCORED_NODES = 2_000_000


def build_grid(est, grid: dict[str, Sequence], dedupe: bool = True) -> list[dict]:
    """Cartesian product of value lists in insertion order (T1). With ``dedupe``
    repeated maps (the reference lists maxBins 65 twice) are fitted once."""
    if not grid:
        return [{}]
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(est.getParam(name), list(values))
    maps = b.build()
    if not dedupe:
        return maps
    seen, out = set(), []
    for pm in maps:
        sig = tuple(sorted((p.name, float(v) if isinstance(v, (int, float)) else v)
                           for p, v in pm.items()))
        if sig not in seen:
            seen.add(sig)
            out.append(pm)
    return out


def grid_names(param_maps: Sequence[dict]) -> list[str]:
    names: list[str] = []
    for pm in param_maps:
        for p in pm:
            if p.name not in names:
                names.append(p.name)
    return names


def param_fields(param_maps: Sequence[dict]) -> list[StructField]:
    """A column for each parameter: double for numbers, else boolean or text."""
    out = []
    for n in grid_names(param_maps):
        kinds = {type(v) for v in (_value(pm, n) for pm in param_maps) if v is not None}
        if kinds <= {int, float}:
            kind = DoubleType()
        else:
            kind = BooleanType() if kinds == {bool} else StringType()
        out.append(StructField(n, kind, True))
    return out


def param_values(pm: dict, fields: Sequence[StructField]) -> list:
    """Values of one map for ``fields``."""
    cast = {DoubleType(): float, StringType(): str, BooleanType(): bool}
    values = [_value(pm, f.name) for f in fields]
    return [None if v is None else cast[f.dataType](v) for f, v in zip(fields, values)]


def grid_table(spark: SparkSession, param_maps: Sequence[dict]) -> DataFrame:
    """One row per map: ``map_id`` then one column per parameter."""
    fields = param_fields(param_maps)
    schema = StructType([StructField("map_id", IntegerType(), False)] + fields)
    return spark.createDataFrame([[i] + param_values(pm, fields) for i, pm in enumerate(param_maps)],
                                 schema)


def _value(pm: dict, name: str):
    for p, v in pm.items():
        if p.name == name:
            return v
    return None


@dataclass
class SearchResult:
    metrics: DataFrame               # map_id, params..., metric columns
    param_maps: list
    best_index: int
    model: PipelineModel             # encoders + learner refitted on all training rows
    per_map: list                    # driver-side metric dicts (bounded by grid size)
    encoders: PipelineModel | None = None   # the refit's encoder stages (shared in a multi search)
    learner: object | None = None           # the refit's last stage

    @property
    def best_params(self) -> dict:
        return {p.name: v for p, v in self.param_maps[self.best_index].items()}


def _tree_bins(est, param_maps) -> int | None:
    bins = [max_bins_of(est, pm) for pm in param_maps]
    bins = [b for b in bins if b is not None]
    return min(bins) if bins else None


def pool_map(fn, items: Sequence, parallelism: int) -> list:
    """Run independent Spark jobs from a bounded driver thread pool (what
    CrossValidator's ``parallelism`` does); order of results follows ``items``."""
    items = list(items)
    if len(items) <= 1 or parallelism <= 1:
        return [fn(x) for x in items]
    # job group, scheduler pool and tags of the calling thread hold in the pool's threads
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as pool:
        return [f.result() for f in [pool.submit(inherit(fn), x) for x in items]]


def _fit_candidates(cands: Sequence[tuple], enc: _Encoded, parallelism: int, models: bool = True) -> list:
    """Fit every (estimator, param map) pair on the same rows, concurrently. ``models``: MLlib's
    models; else trees stay as they are grown, which is all that scores need."""
    data = enc.rows
    weight = ROWS if is_collapsed(data) else None
    levels = [i for i, c in enumerate(cands) if weight is None and by_levels(*c, data)]
    others = [i for i in range(len(cands)) if i not in levels]
    out = dict(zip(others, pool_map(lambda i: fit_learner(cands[i][0], data, cands[i][1], weight), others, parallelism)))
    if levels:
        # blocks hold what trees need of the rows
        grown = grow_trees(data, [cands[i] for i in levels], enc.release, enc.drawn)
        out.update(zip(levels, [g.to_model(data) for g in grown] if models else grown))
    return [out[i] for i in range(len(cands))]


def _measures(df: DataFrame) -> list[str]:
    """What rows that stand for several carry along."""
    return [ROWS, SPREAD, LOW, HIGH] if is_collapsed(df) else []


class _Encoded:
    """Encoders fitted on some rows plus those rows encoded, and persisted unless all of ``cands`` are
    trees: these keep blocks of their own, far smaller than vectors."""

    def __init__(self, fit_df: DataFrame, spec: FeatureSpec, bins: int | None, precheck: bool, cands: Sequence[tuple]):
        if fit_df.isEmpty():
            raise ValueError("training part is empty: no rows to fit on")
        weight = ROWS if is_collapsed(fit_df) else None
        self.model = fit_encoders(fit_df, spec, label_limit=bins, precheck=precheck, weight=weight)
        encoded = self.model.transform(fit_df).select(FEATURES, spec.label, *([weight] if weight else []))
        if bins is not None:
            check_bins(encoded, spec, bins)
        by_blocks = weight is None and all(by_levels(*c, encoded) for c in cands)
        self.rows = encoded if by_blocks else encoded.persist(StorageLevel.MEMORY_AND_DISK)
        # rows are encoded one by one, so a sample may be taken first where none is skipped
        self.drawn = (lambda share, seed: self.model.transform(draw(fit_df.select(*dict.fromkeys((*spec.input_columns, spec.label))), share, seed))) \
            if by_blocks and spec.handle_invalid != "skip" else None

    def release(self):
        self.rows.unpersist()


def _score_maps(enc: PipelineModel, models: list, eval_df: DataFrame, label: str) -> list[dict]:
    """Every model's R²/RMSE on ``eval_df``, which must have rows."""
    out = score_models(enc, models, eval_df, label)
    if out and out[0]["n"] == 0:
        raise ValueError("validation part is empty: no rows to score")
    return out


def score_models(enc: PipelineModel, models: list, eval_df: DataFrame, label: str) -> list[dict]:
    """Every model's R²/RMSE on ``eval_df``: one aggregate pass for each group of models
    of bounded size, with one prediction column per model. Models of ``trees`` score by blocks of rows."""
    grown = [None if is_collapsed(eval_df) else m if isinstance(m, Grown) else getattr(m, "_grown", None) for m in models]
    out: dict = {}
    for own in ([i for i, g in enumerate(grown) if g is None], [i for i, g in enumerate(grown) if g is not None]):
        todo = iter(own)
        for group in model_groups([grown[i] or models[i] for i in own], SCORED_NODES):
            scored = enc.transform(eval_df).select(FEATURES, label, *_measures(eval_df))
            preds = [f"_pred_{i}" for i in range(len(group))]
            if isinstance(group[0], Grown):
                scored = score_trees(scored, label, group, preds)
            else:
                for m, name in zip(group, preds):
                    scored = m.copy().setPredictionCol(name).transform(scored)
            out.update((next(todo), m) for m in multi_metrics(scored, label, preds))
    return [out[i] for i in range(len(models))]


def model_size(model) -> int:
    """Tree nodes of a tree, forest or boosted model; coefficients of any other."""
    if isinstance(model, Grown):
        return model.size
    for name in ("totalNumNodes", "numNodes"):
        if hasattr(model, name):
            return int(getattr(model, name))
    return int(model.numFeatures)


def model_groups(models: Sequence, limit: int) -> list[list]:
    """``models`` in order, in groups of at most ``limit`` nodes (or one larger model). Trees that
    neighbours share count once."""
    out: list[list] = []
    size = 0
    for m in models:
        shared = out and isinstance(m, Grown) and isinstance(out[-1][-1], Grown) and m.trees is out[-1][-1].trees
        n = 0 if shared else model_size(m)
        if not out or size + n > limit:
            out.append([])
            size = 0
        out[-1].append(m)
        size += n
    return out


def _fit_and_score(fit_df, eval_df, spec, cands, bins, parallelism) -> list[dict]:
    enc = _Encoded(fit_df, spec, bins, False, cands)
    try:
        models = _fit_candidates(cands, enc, parallelism, models=False)
    finally:
        enc.release()
    return _score_maps(enc.model, models, eval_df, spec.label)


def _best(values: Sequence[float], metric: str) -> int:
    """Index of the best value; the first of equals. Undefined values can't win."""
    sign = 1.0 if HIGHER_IS_BETTER[metric] else -1.0
    known = [(sign * v, -i) for i, v in enumerate(values) if v is not None and not math.isnan(v)]
    if not known:
        raise ValueError(f"{metric} is undefined for every parameter map")
    return -max(known)[1]


@contextmanager
def _training(train: DataFrame, rows: DataFrame | None, spec: FeatureSpec, cands: Sequence[tuple],
              by: Sequence[str] = ()) -> Iterator[DataFrame]:
    """``train``, or where rows of equal inputs may stand as one, these by ``by`` and inputs. They
    need no order, so they are taken from ``rows``: the same rows where they are read."""
    rows = train if rows is None else rows
    if not (may_collapse(cands, spec) and few_inputs(rows, spec)):
        yield train
        return
    small = collapse(rows, spec, by).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield small
    finally:
        small.unpersist()


def plain_fit(train: DataFrame, spec: FeatureSpec, est, param_map: dict | None = None,
              rows: DataFrame | None = None) -> PipelineModel:
    """Fit encoders and learner once, no search (T4). ``rows``: the rows of ``train`` as they are
    read, where ``train`` holds them dealt and ordered for learners that draw rows."""
    param_map = param_map or {}
    with _training(train, rows, spec, [(est, param_map)]) as data:
        enc = _Encoded(data, spec, _tree_bins(est, [param_map]), True, [(est, param_map)])
        try:
            model = _fit_candidates([(est, param_map)], enc, 1)[0]
        finally:
            enc.release()
    return PipelineModel(stages=list(enc.model.stages) + [model])


Groups = dict  # name -> (estimator, [param maps])


def _search(spark, data, rows, spec, groups: Groups, part_col, parts, metric, parallelism,
            table_cols, summarize) -> dict[str, SearchResult]:
    """Common driver of every search. ``part_col`` deals ``data`` (and ``rows``, see ``plain_fit``)
    into parts, and ``parts`` are the (fit, eval) conditions on it; ``groups`` maps a name to an
    estimator and its grid, so several learners can be searched over the same folds.

    Per task the encoders are fitted once and shared by every (learner, map)
    candidate, and the candidates are scored together. At most ``parallelism`` jobs run at
    once, over all running tasks, and only running tasks hold their encoded rows. After
    the last one all rows are encoded, and every group's best map is refitted
    on those shared rows."""
    groups = {g: (est, list(maps)) for g, (est, maps) in groups.items()}
    cands = [(est, pm) for est, maps in groups.values() for pm in maps]
    with _training(data, rows, spec, cands, [part_col]) as train:
        tasks = [(train.filter(fit), train.filter(held)) for fit, held in parts]
        return _run_search(spark, train.drop(part_col), spec, groups, cands, tasks, metric, parallelism,
                           table_cols, summarize)


def _run_search(spark, train, spec, groups, cands, tasks, metric, parallelism, table_cols,
                summarize) -> dict[str, SearchResult]:
    tree_bins = [b for est, maps in groups.values() for b in [_tree_bins(est, maps)]
                 if b is not None]
    bins = min(tree_bins) if tree_bins else None
    check_cardinality(train, spec.categorical, label_limit_of(spec, bins))
    at_once = max(1, min(parallelism, len(tasks)))
    inner = max(1, parallelism // at_once)
    per_task = pool_map(lambda t: _fit_and_score(t[0], t[1], spec, cands, bins, inner), tasks, at_once)
    chosen, offset = [], 0
    for name, (est, maps) in groups.items():
        part = [pt[offset:offset + len(maps)] for pt in per_task]
        offset += len(maps)
        per_map = summarize(part, len(maps))
        chosen.append((name, est, maps, _best([m["score"] for m in per_map], metric), per_map))
    winners = [(est, maps[best]) for _, est, maps, best, _ in chosen]
    full = _Encoded(train, spec, bins, False, winners)
    try:
        learners = _fit_candidates(winners, full, parallelism)
    finally:
        full.release()
    out = {}
    for (name, est, maps, best, per_map), learner in zip(chosen, learners):
        table = _metrics_table(spark, maps, [m["row"] for m in per_map], table_cols)
        model = PipelineModel(stages=list(full.model.stages) + [learner])
        out[name] = SearchResult(table, maps, best, model, per_map, full.model, learner)
    return out


def cross_validate_many(spark: SparkSession, train: DataFrame, spec: FeatureSpec, groups: Groups,
                        key_cols: Sequence[str], num_folds: int = 3, metric: str = "r2",
                        parallelism: int = 4, fold_col: str = FOLD_COL,
                        rows: DataFrame | None = None) -> dict[str, SearchResult]:
    """K-fold search (T2) of one or several learners over the same hash folds.
    Fold membership is the same in every run and in SQL; every fold refits the
    encoders on its own training rows. Per learner: mean and population std of
    the metric per map, and the best map refitted on all of ``train``."""
    data, rows = (df if df is None or fold_col in df.columns else with_folds(df, key_cols, num_folds, fold_col)
                  for df in (train, rows))
    parts = [(F.col(fold_col) != k, F.col(fold_col) == k) for k in range(num_folds)]

    def summarize(per_fold, n_maps):
        out = []
        for i in range(n_maps):
            vals = [per_fold[k][i][metric] for k in range(num_folds)]
            rm = [per_fold[k][i]["rmse"] for k in range(num_folds)]
            mean = sum(vals) / num_folds
            std = math.sqrt(sum((v - mean) ** 2 for v in vals) / num_folds)
            out.append({"score": mean, "folds": vals,
                        "row": (mean, std, sum(rm) / num_folds)})
        return out

    return _search(spark, data, rows, spec, groups, fold_col, parts, metric, parallelism,
                   [f"avg_{metric}", f"std_{metric}", "avg_rmse"], summarize)


def cross_validate(spark: SparkSession, train: DataFrame, spec: FeatureSpec, est,
                   param_maps: Sequence[dict], key_cols: Sequence[str], num_folds: int = 3,
                   metric: str = "r2", parallelism: int = 4, fold_col: str = FOLD_COL,
                   rows: DataFrame | None = None) -> SearchResult:
    """K-fold search of one learner (see ``cross_validate_many``)."""
    return cross_validate_many(spark, train, spec, {"model": (est, param_maps)}, key_cols,
                               num_folds, metric, parallelism, fold_col, rows)["model"]


def holdout_search_many(spark: SparkSession, train: DataFrame, spec: FeatureSpec, groups: Groups,
                        key_cols: Sequence[str], train_ratio: float = 0.8, metric: str = "r2",
                        parallelism: int = 4, flag_col: str = HOLDOUT_COL,
                        rows: DataFrame | None = None) -> dict[str, SearchResult]:
    """Hold-out search (T3) of one or several learners on a hash validation flag;
    each learner's best map refitted on all rows."""
    data, rows = (df if df is None or flag_col in df.columns
                  else with_holdout_flag(df, key_cols, train_ratio, flag_col) for df in (train, rows))
    parts = [(~F.col(flag_col), F.col(flag_col))]
    other = "rmse" if metric == "r2" else "r2"

    def summarize(per_task, n_maps):
        return [{"score": m[metric], "row": (m[metric], m[other])} for m in per_task[0]]

    return _search(spark, data, rows, spec, groups, flag_col, parts, metric, parallelism,
                   [f"valid_{metric}", f"valid_{other}"], summarize)


def holdout_search(spark: SparkSession, train: DataFrame, spec: FeatureSpec, est,
                   param_maps: Sequence[dict], key_cols: Sequence[str], train_ratio: float = 0.8,
                   metric: str = "r2", parallelism: int = 4, flag_col: str = HOLDOUT_COL,
                   rows: DataFrame | None = None) -> SearchResult:
    """Hold-out search of one learner (see ``holdout_search_many``)."""
    return holdout_search_many(spark, train, spec, {"model": (est, param_maps)}, key_cols,
                               train_ratio, metric, parallelism, flag_col, rows)["model"]


def score_fit(model: PipelineModel, df: DataFrame, label: str) -> dict:
    """Test metrics of one fitted pipeline."""
    return score_models(PipelineModel(stages=model.stages[:-1]), [model.stages[-1]], df, label)[0]


def score_results(results: dict[str, SearchResult], df: DataFrame, label: str) -> dict[str, dict]:
    """Test metrics of every refitted model of one multi search: the shared encoders run
    once for each group of models, each learner adds its own prediction column."""
    encs = {id(r.encoders) for r in results.values()}
    if len(encs) != 1 or None in [r.encoders for r in results.values()]:
        raise ValueError("score_results needs models refitted on one shared encoding")
    first = next(iter(results.values()))
    metrics = _score_maps(first.encoders, [r.learner for r in results.values()], df, label)
    return dict(zip(results, metrics))


def _metrics_table(spark: SparkSession, param_maps, values, value_names) -> DataFrame:
    fields = param_fields(param_maps)
    schema = StructType([StructField("map_id", IntegerType(), False)] + fields +
                        [StructField(v, DoubleType(), True) for v in value_names])
    rows = [[i] + param_values(pm, fields) + [float(x) for x in vals]
            for i, (pm, vals) in enumerate(zip(param_maps, values))]
    return spark.createDataFrame(rows, schema)


def best_row(metrics: DataFrame, metric_col: str, higher_is_better: bool = True) -> DataFrame:
    """Argmax (or argmin) row of a metrics table; ties go to the lowest map_id (T5)."""
    order = F.desc(metric_col) if higher_is_better else F.asc(metric_col)
    return metrics.orderBy(order, F.asc("map_id")).limit(1)
