"""Queries of linear models, classification, recommendation and stored models, and their
DuckDB SQL. The SQL solves the same small systems from sums over the training rows."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..operators import recommend as rec
from ..operators import splits as sp
from ..operators.features import (FEATURES, HOT_SUFFIX, NORM_VEC, fit_encoders, fitted_slot_names,
                                  vector_columns)
from ..operators.persist import load_model, save_model
from ..operators.ranking import areas
from ..session import scratch_path
from ..sources.files import read_table
from ..streaming.scoring import read_sink, run_to_parquet, score_stream
from . import lineitem as li
from . import oracle as sql
from .queries import (CELL_PARAMS, FM_EXACT, METRIC_DIGITS, PRED_DIGITS, _fitted, _predict, _score,
                      _split, persisted)

#: The linear model's settings that the reference names.
LINEAR = {"maxIter": 10, "regParam": 0.3}
#: A penalty as large as the label's deviation, so that it shows in the coefficients.
RIDGE = 20_000.0
#: Saturated models have a finite optimum wherever both kinds of rows occur in a group.
SATURATED = {"regParam": 0.0, "maxIter": 200, "tol": 1e-12}
SHARE_DIGITS = 5


# ------------------------------------------------------------------ scalers and one-hot

def q_standard_scale(spark, sf_dir):
    """Numerics of the full feature set to the training rows' mean 0 and deviation 1."""
    spec = li.FeatureSpec(label=li.LABEL, numeric=li.FULL_SPEC.numeric, scaler="standard")
    train, _ = _split(spark, sf_dir, spec)
    rows = li.pruned(li.prepared_frame(spark, sf_dir), spec)
    df = fit_encoders(train, spec).transform(rows)
    return df.select(*li.KEY, *vector_columns(df, NORM_VEC, "n", len(spec.numeric), METRIC_DIGITS))


def q_one_hot(spark, sf_dir):
    """One slot for each label of three columns but the rarest of each."""
    spec = li.ONE_HOT_SPEC
    train, _ = _split(spark, sf_dir, spec)
    with persisted(train) as t:
        model = fit_encoders(t, spec)
    names = fitted_slot_names(spec, model)
    sizes = [sum(n.startswith(f"{c}=") for n in names) for c in spec.one_hot]
    df = model.transform(li.pruned(li.prepared_frame(spark, sf_dir), spec))
    return df.select(*li.KEY, *[x for c, n in zip(spec.one_hot, sizes)
                                for x in vector_columns(df, c + HOT_SUFFIX, c, n)])


# ------------------------------------------------------------------ linear models

q_linreg_predict = _predict("linreg_predict", "linreg", li.STANDARD_SPEC, LINEAR)
q_linreg_groups = _predict("linreg_groups", "linreg", li.GROUP_SPEC, {"regParam": 0.0, "solver": "normal"})


def q_linreg_coefficients(spark, sf_dir):
    """Coefficients of a ridge regression on standardised numerics, by slot, and the intercept."""
    model, _ = _fitted(spark, sf_dir, "linreg", li.STANDARD_SPEC, {"regParam": RIDGE})
    names = [*fitted_slot_names(li.STANDARD_SPEC, model), "intercept"]
    values = [*model.stages[-1].coefficients.toArray().tolist(), float(model.stages[-1].intercept)]
    schema = StructType([StructField("slot", StringType(), False), StructField("coefficient", DoubleType(), False)])
    # a row per feature
    return spark.createDataFrame(list(zip(names, values)), schema) \
        .select("slot", F.round("coefficient", PRED_DIGITS).alias("coefficient"))


# ------------------------------------------------------------------ classification

def _class_scores(spark, sf_dir, kind: str, spec, params: dict, digits: int) -> DataFrame:
    model, test = _fitted(spark, sf_dir, kind, spec, params)
    scored = model.transform(test)
    return scored.select(*li.KEY, F.round(vector_to_array("probability")[1], digits).alias("probability"),
                         F.col("prediction"), F.col(spec.label).alias("trueLabel"))


def q_logreg_predict(spark, sf_dir):
    """The flag's probability by cell: a saturated logistic model."""
    return _class_scores(spark, sf_dir, "logreg", li.FLAG_CELL_SPEC, SATURATED, SHARE_DIGITS)


def q_tree_classifier_stump(spark, sf_dir):
    """One Gini split; the leaves' shares of flagged rows."""
    return _class_scores(spark, sf_dir, "dtc", li.MIDDLE_SPEC, {"maxDepth": 1, "maxBins": 64}, METRIC_DIGITS)


def q_tree_classifier_predict(spark, sf_dir):
    """Gini splits to depth 2; a split whose leaves predict the same class is taken back."""
    return _class_scores(spark, sf_dir, "dtc", li.MIDDLE_SPEC, {"maxDepth": 2, "maxBins": 64}, METRIC_DIGITS)


def q_binary_auc(spark, sf_dir):
    """Areas under both curves of three scores for the flag over the test rows: a logistic
    model's probability (a value per cell), a numeric of 50 values and one of many."""
    model, test = _fitted(spark, sf_dir, "logreg", li.FLAG_CELL_SPEC, SATURATED)
    by_model = model.transform(test).select(
        li.FLAG, F.round(vector_to_array("probability")[1], SHARE_DIGITS).alias("score"))
    _, rows = sp.hash_split(li.prepared_frame(spark, sf_dir), li.KEY, 0.7)
    frames = {"logreg": by_model, **{c: rows.select(li.FLAG, F.col(c).alias("score"))
                                     for c in ("l_quantity", "l_extendedprice")}}
    out = None
    for name, frame in frames.items():
        one = areas(frame, li.FLAG, "score").select(
            F.lit(name).alias("score_name"), F.round("area_roc", METRIC_DIGITS).alias("area_roc"),
            F.round("area_pr", METRIC_DIGITS).alias("area_pr"), "n_pos", "n_neg")
        out = one if out is None else out.unionByName(one)
    return out


# ------------------------------------------------------------------ factorization machine

#: Two full-batch steps from factors of deviation 1, small enough that both parts move.
FM_FACTORS = {"solver": "gd", "stepSize": 1e-5, "factorSize": 2, **FM_EXACT, "initStd": 1.0}
q_fm_factor_predict = _predict("fm_factor_predict", "fm", li.SMALL_SPEC, FM_FACTORS)


# ------------------------------------------------------------------ recommendation

RANK1_REG = 0.1


def _ratings(spark, sf_dir) -> DataFrame:
    """Customers x parts. The tables hold no ratings; this one depends on the part: its size,
    in tens, less the discount at which the customer bought it."""
    items = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_discount")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = read_table(spark, sf_dir, "part").select("p_partkey", "p_size")
    rows = items.join(orders, items.l_orderkey == orders.o_orderkey).join(parts, items.l_partkey == parts.p_partkey)
    return rec.one_rating(rows, "o_custkey", "l_partkey", F.col("p_size") * (1 - F.col("l_discount")) / 10)


def q_als_step(spark, sf_dir):
    """Customers' factors of rank 1 after one half step from fixed factors of the parts."""
    ratings = _ratings(spark, sf_dir)
    fixed = ratings.select("item").distinct().withColumn("factor", 0.5 + F.col("item") % 7 / 10)
    return rec.half_step(ratings, fixed, RANK1_REG) \
        .select(F.col("user").alias("o_custkey"), F.round("factor", METRIC_DIGITS).alias("factor"))


def q_als_predict(spark, sf_dir):
    """ALS on a part of the ratings, its error on the held-out ones against the mean's. Joins and
    means make the ratings once: the fit, the mean and the held-out part read them from the cache."""
    with persisted(_ratings(spark, sf_dir)) as ratings:
        train, test = sp.hash_split(ratings, ("user", "item"), 0.8)
        error = rec.held_out_error(rec.fit_als(train), train, test)
        return spark.createDataFrame(error.collect(), error.schema)  # one row


# ------------------------------------------------------------------ stored models

def _stored(spark, sf_dir, name: str):
    """Boosted trees on the cells, written to the shared folder and loaded by another session."""
    model, test = _fitted(spark, sf_dir, "gbt", li.CELL_SPEC, CELL_PARAMS["gbt"])
    path = save_model(model, scratch_path(spark, name))
    return load_model(spark.newSession(), path, GBTRegressionModel), test


def q_saved_model_score(spark, sf_dir):
    return _score(*_stored(spark, sf_dir, "saved_model"))


def q_saved_model_stream(spark, sf_dir):
    """The stored pipeline on a file stream."""
    model, _ = _stored(spark, sf_dir, "saved_model")
    _, rows = sp.hash_split(li.prepared_stream(spark, sf_dir), li.KEY, 0.7)
    scored = score_stream(model, rows, li.KEY, li.LABEL)
    base = scratch_path(spark, "saved_model_stream")
    out = read_sink(spark, run_to_parquet(scored, f"{base}/out", f"{base}/_checkpoint"), scored.schema)
    return out.select(*li.KEY, F.round("prediction", PRED_DIGITS).alias("prediction"), "trueLabel")


QUERIES = {
    "standard_scale": q_standard_scale,
    "one_hot": q_one_hot,
    "linreg_predict": q_linreg_predict,
    "linreg_groups": q_linreg_groups,
    "linreg_coefficients": q_linreg_coefficients,
    "logreg_predict": q_logreg_predict,
    "tree_classifier_stump": q_tree_classifier_stump,
    "tree_classifier_predict": q_tree_classifier_predict,
    "binary_auc": q_binary_auc,
    "fm_factor_predict": q_fm_factor_predict,
    "als_step": q_als_step,
    "als_predict": q_als_predict,
    "saved_model_score": q_saved_model_score,
    "saved_model_stream": q_saved_model_stream,
}


# ------------------------------------------------------------------ SQL

def _standard_scale_sql() -> str:
    cols = li.FULL_SPEC.numeric
    stats = ", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS s{i}" for i, c in enumerate(cols))
    slots = ", ".join(f"round(CASE WHEN s{i} = 0 THEN 0 ELSE (v.{c} - m{i}) / s{i} END, {METRIC_DIGITS}) AS n_{i}"
                      for i, c in enumerate(cols))
    return sql.with_prep(f", stats AS (SELECT {stats} FROM train)\nSELECT {sql.V_KEY}, {slots} FROM prep v CROSS JOIN stats")


def _one_hot_sql() -> str:
    cols = {"l_returnflag": 2, "l_linestatus": 1, "line_label": 6}
    ctes = ",\n".join(sql.string_index_cte(c) for c in cols)
    slots = ", ".join(f"CASE WHEN idx_{c}.ix = {i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {c}_{i}"
                      for c, n in cols.items() for i in range(n))
    joins = " ".join(f"LEFT JOIN idx_{c} ON idx_{c}.label = v.{c}" for c in cols)
    return sql.with_prep_ctes(ctes, f"SELECT {sql.V_KEY}, {slots} FROM prep v {joins}")


def _det3(columns: list[list[str]]) -> str:
    (a, d, g), (b, e, h), (c, f, i) = columns
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


def _ridge_ctes(penalty: float) -> str:
    """``fit``: the coefficients k0..k2 of three numerics in units of their population deviation,
    by Cramer's rule on (R + penalty / sd(y) * I) k = r, R their correlations and r those with
    the label; and the means and deviations."""
    cols = li.STANDARD_SPEC.numeric
    n = range(3)
    sums = ", ".join([f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}, corr({c}, price) AS r{i}" for i, c in enumerate(cols)]
                     + [f"corr({cols[i]}, {cols[j]}) AS c{i}{j}" for i in n for j in n if i < j])
    diagonal = f"(1 + {penalty} / sy)"
    matrix = [[diagonal if i == j else f"c{min(i, j)}{max(i, j)}" for j in n] for i in n]
    whole = _det3(matrix)  # symmetric: rows are columns
    solved = ", ".join(f"{_det3([[f'r{j}' for j in n] if i == k else matrix[i] for i in n])} / {whole} AS k{k}" for k in n)
    return f"""stats AS (SELECT count(*) AS n, avg(price) AS my, stddev_pop(price) AS sy, {sums} FROM train),
fit AS (SELECT *, {solved} FROM stats)"""


def _linreg_predict_sql() -> str:
    terms = " + ".join(f"k{i} * sy * (v.{c} - m{i}) / s{i}" for i, c in enumerate(li.STANDARD_SPEC.numeric))
    return sql.with_prep_ctes(_ridge_ctes(LINEAR["regParam"]), f"""SELECT {sql.V_KEY},
       round(my + {terms}, {PRED_DIGITS}) AS prediction, v.price AS trueLabel FROM test v CROSS JOIN fit""")


def _linreg_coefficients_sql() -> str:
    # the model's slots are in units of the sample deviation
    rows = "\nUNION ALL\n".join(
        [f"SELECT '{c}' AS slot, round(k{i} * sy * sqrt(n / (n - 1)), {PRED_DIGITS}) AS coefficient FROM fit"
         for i, c in enumerate(li.STANDARD_SPEC.numeric)] + [f"SELECT 'intercept', round(my, {PRED_DIGITS}) FROM fit"])
    return sql.with_prep_ctes(_ridge_ctes(RIDGE), rows)


def _group_means_sql() -> str:
    return sql.with_prep(f""", g AS (SELECT line_label, avg(price) AS p FROM train GROUP BY line_label)
SELECT {sql.V_KEY}, round(g.p, {PRED_DIGITS}) AS prediction, v.price AS trueLabel FROM test v JOIN g USING (line_label)""")


_CELL = "v.l_returnflag = g.l_returnflag AND v.l_linestatus = g.l_linestatus"
_SHARES = f"""g AS (SELECT l_returnflag, l_linestatus, avg({li.FLAG}) AS p FROM train
  GROUP BY l_returnflag, l_linestatus)"""


def _logreg_sql() -> str:
    return sql.with_prep_ctes(_SHARES, f"""SELECT {sql.V_KEY}, round(g.p, {SHARE_DIGITS}) AS probability,
       CAST(g.p > 0.5 AS DOUBLE) AS prediction, v.{li.FLAG} AS trueLabel FROM test v JOIN g ON {_CELL}""")


#: The train and test rows with the flag of ``lineitem.with_classes``.
_MIDDLE = f"""labelled AS (SELECT *, CAST((round(l_discount * 100) BETWEEN 3 AND 7) <> (l_quantity <= 10) AS INTEGER)
  AS {li.MIDDLE} FROM train),
whole AS (SELECT avg({li.MIDDLE}) AS share FROM labelled)"""


def _classifier_sql(depth: int) -> str:
    """Gini: per side (p^2 + q^2) / n with p + q = n, which is largest where p^2 / n is: the
    regression search with the flag as its label. Leaves of one split that predict the same
    class become one leaf, from the bottom up."""
    ctes, _ = (sql.stump_model if depth == 1 else sql.depth2_model)("p", "labelled", "l_discount", li.MIDDLE)

    def joined(low: str, high: str) -> str:
        return f"(({low} > 0.5) = ({high} > 0.5))"
    left, right, flat = "p.pl", "p.pr", joined("p.pl", "p.pr")
    if depth == 2:
        sides = [f"(p.{s}t IS NULL OR {joined(f'p.{s}l', f'p.{s}r')})" for s in "lg"]
        left, right = (f"CASE WHEN {side} THEN p.p{own} WHEN v.l_discount <= p.{s}t THEN p.{s}l ELSE p.{s}r END"
                       for side, own, s in zip(sides, "lr", "lg"))
        flat = f"({sides[0]} AND {sides[1]} AND {flat})"
    share = f"CASE WHEN {flat} THEN whole.share WHEN v.l_discount <= p.thr THEN {left} ELSE {right} END"
    return sql.with_prep_ctes(f"{_MIDDLE},\n{ctes}", f"""SELECT {sql.V_KEY}, round({share}, {METRIC_DIGITS}) AS probability,
       CAST({share} > 0.5 AS DOUBLE) AS prediction,
       CAST((round(v.l_discount * 100) BETWEEN 3 AND 7) <> (v.l_quantity <= 10) AS INTEGER) AS trueLabel
FROM test v CROSS JOIN p CROSS JOIN whole""")


def _auc_sql() -> str:
    scores = {"logreg": f"SELECT {li.FLAG} AS y, round(g.p, {SHARE_DIGITS}) AS s FROM test v JOIN g ON {_CELL}",
              **{c: f"SELECT {li.FLAG} AS y, {c} AS s FROM test" for c in ("l_quantity", "l_extendedprice")}}
    rows = "\nUNION ALL\n".join(f"SELECT '{n}' AS score_name, * FROM ({q})" for n, q in scores.items())
    return sql.with_prep_ctes(f"""{_SHARES},
rows AS ({rows}),
ranked AS (
  SELECT score_name, y, s, rank() OVER (PARTITION BY score_name ORDER BY s)
    + (count(*) OVER (PARTITION BY score_name, s) - 1) / 2 AS place FROM rows),
roc AS (
  SELECT score_name, sum(y) AS n_pos, sum(1 - y) AS n_neg,
         (sum(CASE WHEN y = 1 THEN place END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y)) AS area
  FROM ranked GROUP BY score_name),
points AS (
  SELECT score_name, s, sum(y) AS pos, sum(sum(y)) OVER w AS tp, sum(count(*)) OVER w AS n
  FROM rows GROUP BY score_name, s WINDOW w AS (PARTITION BY score_name ORDER BY s DESC)),
pr AS (
  SELECT score_name, sum(pos * (tp / n + coalesce(before, tp / n)) / 2) / sum(pos) AS area
  FROM (SELECT *, lag(tp / n) OVER (PARTITION BY score_name ORDER BY s DESC) AS before FROM points)
  GROUP BY score_name)""", f"""SELECT score_name, round(roc.area, {METRIC_DIGITS}) AS area_roc, round(pr.area, {METRIC_DIGITS}) AS area_pr,
       CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg FROM roc JOIN pr USING (score_name)""")


#: The factors that Spark draws for seed 5560, initStd 1, three features and
#: two factors (a fit with steps of zero length shows them), feature by feature.
FM_FIRST = [[-0.3760204431154879, -0.11065136343726596], [-0.6170450976227915, 1.3275408467543588],
            [0.6207790423822189, -0.23234189717951934]]


def _fm_factor_sql(step: float = FM_FACTORS["stepSize"]) -> str:
    """Two full-batch steps from ``FM_FIRST``. With e = prediction - y and s_f = sum_j v_jf x_j,
    a factor's gradient is avg(2 e x_i (s_f - v_if x_i)); the t-th step is step / sqrt(t)."""
    cols, factors = li.SMALL_SPEC.numeric, range(2)
    slots = range(len(cols))
    scaled = ", ".join(f"(x.{c} - m.mn{i}) / (m.mx{i} - m.mn{i}) AS x{i}" for i, c in enumerate(cols))
    bounds = ", ".join(f"min({c}) AS mn{i}, max({c}) AS mx{i}" for i, c in enumerate(cols))
    start = ", ".join(["0.0::DOUBLE AS b"] + [f"0.0::DOUBLE AS w{i}" for i in slots]
                      + [f"{FM_FIRST[i][f]!r}::DOUBLE AS v{i}_{f}" for i in slots for f in factors])

    def dot(f: int) -> str:
        return "(" + " + ".join(f"v{j}_{f} * x{j}" for j in slots) + ")"

    def prediction() -> str:
        linear = " + ".join(["b"] + [f"w{i} * x{i}" for i in slots])
        pairs = " + ".join(f"0.5 * ({dot(f)} * {dot(f)} - (" + " + ".join(
            f"v{j}_{f} * v{j}_{f} * x{j} * x{j}" for j in slots) + "))" for f in factors)
        return f"({linear} + {pairs})"

    def step_cte(name: str, before: str, t: int) -> str:
        e = f"2 * ({prediction()} - price)"
        grads = ", ".join([f"avg({e}) AS gb"] + [f"avg({e} * x{i}) AS gw{i}" for i in slots]
                          + [f"avg({e} * x{i} * ({dot(f)} - v{i}_{f} * x{i})) AS gv{i}_{f}" for i in slots for f in factors])
        rate = f"{step!r} / sqrt({t})"
        moved = ", ".join([f"b - {rate} * gb AS b"] + [f"w{i} - {rate} * gw{i} AS w{i}" for i in slots]
                          + [f"v{i}_{f} - {rate} * gv{i}_{f} AS v{i}_{f}" for i in slots for f in factors])
        return f"{name} AS (SELECT {moved} FROM {before} CROSS JOIN (SELECT {grads} FROM xs CROSS JOIN {before}))"
    ctes = f"""mm AS (SELECT {bounds} FROM train),
xs AS (SELECT x.price, {scaled} FROM train x CROSS JOIN mm m),
start AS (SELECT {start}),
{step_cte("one", "start", 1)},
{step_cte("two", "one", 2)},
rows AS (SELECT {', '.join('x.' + k for k in sql.KEYS)}, x.price, {scaled} FROM test x CROSS JOIN mm m)"""
    return sql.with_prep_ctes(ctes, f"""SELECT {sql.KEY}, round({prediction()}, {PRED_DIGITS}) AS prediction,
       price AS trueLabel FROM rows CROSS JOIN two""")


_ALS_STEP = f"""WITH ratings AS (
  SELECT o.o_custkey, l.l_partkey, avg(p.p_size * (1 - l.l_discount) / 10) AS r
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY o.o_custkey, l.l_partkey),
rows AS (SELECT o_custkey, r, 0.5 + l_partkey % 7 / 10 AS v FROM ratings)
SELECT o_custkey, round(sum(r * v) / (sum(v * v) + {RANK1_REG} * count(*)), {METRIC_DIGITS}) AS factor
FROM rows GROUP BY o_custkey"""


def oracle_queries() -> dict[str, str]:
    return {
        "standard_scale": _standard_scale_sql(),
        "one_hot": _one_hot_sql(),
        "linreg_predict": _linreg_predict_sql(),
        "linreg_groups": _group_means_sql(),
        "linreg_coefficients": _linreg_coefficients_sql(),
        "logreg_predict": _logreg_sql(),
        "tree_classifier_stump": _classifier_sql(1),
        "tree_classifier_predict": _classifier_sql(2),
        "binary_auc": _auc_sql(),
        "fm_factor_predict": _fm_factor_sql(),
        "als_step": _ALS_STEP,
        "saved_model_score": sql.predictions_sql(),
        "saved_model_stream": sql.predictions_sql(),
    }
