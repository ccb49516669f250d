"""DuckDB SQL that answers the same questions as the Spark queries, for the
driver's side-by-side check. Shared pieces (the prepared table, the hash split,
encoder maps, closed-form learner answers) are built once here as CTE text."""

from __future__ import annotations

from ..operators.splits import FOLD_LANE, HOLDOUT_LANE, SPLIT_LANE, hash_cut
from .lineitem import FULL_SPEC

#: The row key's columns in ``prep``; ship_epoch is computed there.
KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "ship_epoch")
KEY = ", ".join(KEYS)
V_KEY = ", ".join(f"v.{k}" for k in KEYS)
_EPOCH = "CAST(epoch(l_shipdate) AS BIGINT)"


def _hash(lane: int, seed: int | None = None) -> str:
    parts = [f"CAST({_EPOCH if k == 'ship_epoch' else k} AS VARCHAR)" for k in KEYS]
    text = " || '-' || ".join(parts)
    if seed is not None:
        text = f"'{seed}:' || " + text
    return f"CAST(('0x' || substr(md5({text}), {1 + 8 * lane}, 8)) AS BIGINT)"


PREP_COLS = ("l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, line_label, "
             "is_discounted, ship_date, l_quantity, l_extendedprice, l_discount, l_tax, ship_epoch, "
             "price, ship_month, ship_day, ship_year")

PREP_CTE = f"""prep AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
         CAST(l_linenumber AS VARCHAR) AS line_label,
         CAST(l_discount > 0.05 AS INTEGER) AS is_discounted,
         strftime(l_shipdate, '%-m/%-d/%Y') AS ship_date,
         l_quantity, l_extendedprice, l_discount, l_tax,
         {_EPOCH} AS ship_epoch,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS price,
         CAST(month(l_shipdate) AS INTEGER) AS ship_month,
         CAST(day(l_shipdate) AS INTEGER) AS ship_day,
         CAST(year(l_shipdate) AS INTEGER) AS ship_year,
         {_hash(SPLIT_LANE)} < {hash_cut(0.7)} AS in_train,
         {_hash(SPLIT_LANE, 42)} < {hash_cut(0.7)} AS drawn,
         CAST({_hash(FOLD_LANE)} % 3 AS INTEGER) AS fold,
         {_hash(HOLDOUT_LANE)} >= {hash_cut(0.8)} AS is_validation
  FROM lineitem
),
train AS (SELECT * FROM prep WHERE in_train),
test AS (SELECT * FROM prep WHERE NOT in_train)"""


def with_prep(body: str) -> str:
    return f"WITH {PREP_CTE}\n{body}"


def with_prep_ctes(ctes: str, body: str) -> str:
    return f"WITH {PREP_CTE},\n{ctes}\n{body}"


PREPARED = with_prep(f"SELECT {PREP_COLS} FROM prep")

# ---------------------------------------------------------------- encoders

def string_index_cte(col: str, source: str = "train", name: str | None = None) -> str:
    """Labels ranked by training frequency, ties alphabetical; index from 0."""
    name = name or f"idx_{col}"
    return (f"{name} AS (SELECT {col} AS label, CAST(row_number() OVER "
            f"(ORDER BY count(*) DESC, {col}) - 1 AS DOUBLE) AS ix "
            f"FROM {source} WHERE {col} IS NOT NULL GROUP BY {col})")


def vector_index_cte(expr: str, name: str, max_categories: int = 20) -> str:
    """Distinct training values ascending with 0 first, used only when the slot
    has at most ``max_categories`` values (else the value passes through)."""
    return (f"{name}_v AS (SELECT DISTINCT CAST({expr} AS DOUBLE) AS v FROM train_enc),\n"
            f"{name} AS (SELECT v, CAST(row_number() OVER (ORDER BY (v = 0) DESC, v) - 1 AS DOUBLE)"
            f" AS ix, (SELECT count(*) FROM {name}_v) <= {max_categories} AS is_cat FROM {name}_v)")


def minmax_expr(expr: str, stats: str, i: int) -> str:
    return (f"CASE WHEN {stats}.mx{i} = {stats}.mn{i} THEN 0.5 ELSE "
            f"({expr} - {stats}.mn{i}) / ({stats}.mx{i} - {stats}.mn{i}) END")


def encoded_frame_sql(digits: int = 8, parts: str = "all") -> str:
    """Key + the encoded slots of FULL_SPEC for every row, encoders fitted on train."""
    spec = FULL_SPEC
    ctes = [string_index_cte(c) for c in spec.categorical]
    # the categorical vector before VectorIndexer, per row
    enc_cols = []
    joins = []
    for c in spec.categorical:
        joins.append(f"LEFT JOIN idx_{c} ON idx_{c}.label = p.{c}")
    cat_exprs = ([f"CAST(p.{c} AS DOUBLE)" for c in spec.flags] +
                 [f"idx_{c}.ix" for c in spec.categorical] +
                 [f"CAST(p.{c} AS DOUBLE)" for c in spec.int_categorical])
    for i, e in enumerate(cat_exprs):
        enc_cols.append(f"{e} AS s{i}")
    ctes.append(f"enc AS (SELECT {', '.join('p.' + k for k in KEYS)}, p.in_train, "
                + ", ".join(enc_cols) + ", "
                + ", ".join(f"CAST(p.{c} AS DOUBLE) AS x{i}" for i, c in enumerate(spec.numeric))
                + " FROM prep p " + " ".join(joins) + ")")
    ctes.append("train_enc AS (SELECT * FROM enc WHERE in_train)")
    for i in range(len(cat_exprs)):
        ctes.append(vector_index_cte(f"s{i}", f"vi{i}"))
    ctes.append("mm AS (SELECT " + ", ".join(
        f"min(x{i}) AS mn{i}, max(x{i}) AS mx{i}" for i in range(len(spec.numeric)))
        + " FROM train_enc)")
    out = [f"e.{k}" for k in KEYS]
    joins = []
    cat_out = []
    for i in range(len(cat_exprs)):
        joins.append(f"LEFT JOIN vi{i} ON vi{i}.v = e.s{i}")
        cat_out.append(f"round(CASE WHEN vi{i}.is_cat THEN vi{i}.ix ELSE e.s{i} END, {digits})")
    num_out = [f"round({minmax_expr(f'e.x{i}', 'mm', i)}, {digits})"
               for i in range(len(spec.numeric))]
    if parts == "cat":
        out += [f"{x} AS c_{i}" for i, x in enumerate(cat_out)]
    elif parts == "num":
        out += [f"{x} AS n_{i}" for i, x in enumerate(num_out)]
    else:
        out += [f"{x} AS f_{i}" for i, x in enumerate(cat_out + num_out)]
    body = ("SELECT " + ", ".join(out) + " FROM enc e CROSS JOIN mm " + " ".join(joins))
    return with_prep_ctes(",\n".join(ctes), body)


# ---------------------------------------------------------------- closed-form learners

CELL_KEYS = ("l_returnflag", "l_linestatus")
_CK = ", ".join(CELL_KEYS)
_CK_JOIN = " AND ".join(f"c.{k} = v.{k}" for k in CELL_KEYS)


def predictions_sql(digits: int = 4) -> str:
    """Test rows scored with the train cell mean (tree fully splits the cells)."""
    return with_prep(f""", cell AS (SELECT {_CK}, avg(price) AS p FROM train GROUP BY {_CK})
SELECT {V_KEY}, round(c.p, {digits}) AS prediction,
       v.price AS trueLabel
FROM test v JOIN cell c ON {_CK_JOIN}""")


# ---------------------------------------------------------------- exact models
#
# Each function gives the CTEs that fit one model on the rows of ``src`` as a one-row table
# ``p``, and the prediction for a row ``v``.

Model = tuple[str, str]


def mean_model(p: str, src: str) -> Model:
    """The training mean: a tree that may not split."""
    return f"{p} AS (SELECT avg(price) AS m FROM {src})", f"{p}.m"


def _search_cte(p: str, src: str) -> str:
    """Best split of the (v, n, s) table ``src`` by variance reduction, over midpoints of
    neighbouring values: the largest sl^2/nl + sr^2/nr."""
    return f"""{p}_c AS (SELECT v, lead(v) OVER (ORDER BY v) AS nv,
       sum(n) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nl,
       sum(s) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sl FROM {src}),
{p}_t AS (SELECT sum(n) AS nt, sum(s) AS st FROM {src}),
{p} AS (SELECT (c.v + c.nv) / 2 AS thr, c.sl / c.nl AS pl, (t.st - c.sl) / (t.nt - c.nl) AS pr
  FROM {p}_c c CROSS JOIN {p}_t t WHERE c.nv IS NOT NULL
  ORDER BY c.sl * c.sl / c.nl + (t.st - c.sl) * (t.st - c.sl) / (t.nt - c.nl) DESC LIMIT 1)"""


def stump_model(p: str, src: str, col: str, label: str = "price") -> Model:
    """Depth-1 tree on one column."""
    return (f"{p}_v AS (SELECT {col} AS v, count(*) AS n, sum({label}) AS s FROM {src} GROUP BY {col}),\n"
            + _search_cte(p, f"{p}_v"),
            f"CASE WHEN v.{col} <= {p}.thr THEN {p}.pl ELSE {p}.pr END")


def depth2_model(p: str, src: str, col: str, label: str = "price") -> Model:
    """Depth-2 tree on one column: the search at the root, then again inside each side. A
    side with one distinct value stays a leaf."""
    root, _ = stump_model(f"{p}_r", src, col, label)
    sides = []
    for side, op in (("l", "<="), ("g", ">")):
        sides.append(f"{p}_{side}v AS (SELECT x.* FROM {p}_r_v x CROSS JOIN {p}_r r WHERE x.v {op} r.thr),\n"
                     + _search_cte(f"{p}_{side}", f"{p}_{side}v"))
    ctes = f"""{root},
{sides[0]},
{sides[1]},
{p} AS (SELECT r.thr, r.pl, r.pr, l.thr AS lt, l.pl AS ll, l.pr AS lr, g.thr AS gt, g.pl AS gl, g.pr AS gr
  FROM {p}_r r LEFT JOIN {p}_l l ON true LEFT JOIN {p}_g g ON true)"""
    return ctes, f"""CASE WHEN v.{col} <= {p}.thr
    THEN CASE WHEN {p}.lt IS NULL THEN {p}.pl WHEN v.{col} <= {p}.lt THEN {p}.ll ELSE {p}.lr END
    ELSE CASE WHEN {p}.gt IS NULL THEN {p}.pr WHEN v.{col} <= {p}.gt THEN {p}.gl ELSE {p}.gr END END"""


def boosted_model(p: str, src: str, col: str, step: float = 0.1) -> Model:
    """Two boosted depth-1 trees, squared loss: the first fits the label, the second the
    pseudo-residual 2 (y - f1) and weighs ``step``."""
    one, f1 = stump_model(f"{p}_a", src, col)
    f1_row = f1.replace("v.", "x.", 1).replace("v.", "x.")
    ctes = f"""{one},
{p}_b_v AS (SELECT x.{col} AS v, count(*) AS n, sum(2 * (x.price - {f1_row})) AS s
  FROM {src} x CROSS JOIN {p}_a GROUP BY x.{col}),
{_search_cte(f"{p}_b", f"{p}_b_v")},
{p} AS (SELECT a.thr AS t1, a.pl AS l1, a.pr AS r1, b.thr AS t2, b.pl AS l2, b.pr AS r2
  FROM {p}_a a CROSS JOIN {p}_b b)"""
    return ctes, (f"(CASE WHEN v.{col} <= {p}.t1 THEN {p}.l1 ELSE {p}.r1 END"
                  f" + {step} * CASE WHEN v.{col} <= {p}.t2 THEN {p}.l2 ELSE {p}.r2 END)")


def linear_steps_model(p: str, src: str, cols: tuple[str, ...], step: float, solver: str) -> Model:
    """Two full-batch steps of a factorization machine without factors, from zero, on scaled
    columns. The gradient is avg(2 (prediction - y) x), x0 = 1 for the intercept. ``gd``
    steps by step / sqrt(t) times it; ``adamW`` by step * m / (sqrt(v) + 1e-8) with the
    bias-corrected moments for rates 0.9 and 0.999."""
    n = range(len(cols) + 1)
    scaled = ", ".join(f"(x.{c} - m.mn{i}) / (m.mx{i} - m.mn{i}) AS x{i + 1}" for i, c in enumerate(cols))
    bounds = ", ".join(f"min({c}) AS mn{i}, max({c}) AS mx{i}" for i, c in enumerate(cols))

    def gradients(coefficients: str) -> str:
        dot = " + ".join(f"{coefficients}{i} * x{i}" for i in n) if coefficients else "0.0"
        return ", ".join(f"avg(2 * ({dot} - price) * x{i}) AS g{i}" for i in n)
    if solver == "gd":
        first = ", ".join(f"-{step} * g{i} AS w{i}" for i in n)
        second = ", ".join(f"a.w{i} - {step} / sqrt(2) * b.g{i} AS w{i}" for i in n)
    else:
        first = ", ".join(f"g{i} AS h{i}, -{step} * g{i} / (abs(g{i}) + 1e-8) AS w{i}" for i in n)
        second = ", ".join(
            f"a.w{i} - {step} * ((0.9 * 0.1 * a.h{i} + 0.1 * b.g{i}) / (1 - 0.9 * 0.9))"
            f" / (sqrt((0.999 * 0.001 * a.h{i} * a.h{i} + 0.001 * b.g{i} * b.g{i}) / (1 - 0.999 * 0.999))"
            f" + 1e-8) AS w{i}" for i in n)
    ctes = f"""{p}_m AS (SELECT {bounds} FROM {src}),
{p}_x AS (SELECT x.price, 1.0 AS x0, {scaled} FROM {src} x CROSS JOIN {p}_m m),
{p}_1 AS (SELECT {first} FROM (SELECT {gradients("")} FROM {p}_x)),
{p}_2 AS (SELECT {gradients("w")} FROM {p}_x CROSS JOIN {p}_1),
{p} AS (SELECT m.*, {second} FROM {p}_1 a CROSS JOIN {p}_2 b CROSS JOIN {p}_m m)"""
    return ctes, " + ".join([f"{p}.w0"] + [
        f"{p}.w{i + 1} * (v.{c} - {p}.mn{i}) / ({p}.mx{i} - {p}.mn{i})" for i, c in enumerate(cols)])


def model_predictions_sql(model: Model, digits: int = 4) -> str:
    """Test rows scored by a model named ``p``."""
    ctes, prediction = model
    return with_prep_ctes(ctes, f"""SELECT {V_KEY}, round({prediction}, {digits}) AS prediction,
       v.price AS trueLabel FROM test v CROSS JOIN p""")


# ---------------------------------------------------------------- searches

SEARCH_COL = "l_discount"
#: By learner: the grid's columns with the value of each map.
SEARCH_MAPS = {
    "dt": [("maxDepth", [1.0, 2.0])],
    "rf": [("minInfoGain", [0.0, 1e18])],
    "gbt": [("maxIter", [1.0, 2.0])],
    "fm": [("stepSize", [0.1, 0.5])],
}


def search_model(kind: str, map_id: int, p: str, src: str) -> Model:
    """The model that a learner's map gives on the rows of ``src``."""
    if kind == "fm":
        return linear_steps_model(p, src, (SEARCH_COL,), SEARCH_MAPS["fm"][0][1][map_id], "gd")
    if map_id == 0:
        return stump_model(p, src, SEARCH_COL)
    return {"dt": depth2_model, "gbt": boosted_model}[kind](p, src, SEARCH_COL) if kind != "rf" \
        else mean_model(p, src)


def _by_value(p: str, source: str, f: str) -> Model:
    """A value ``f`` for each of the ordered values of ``source``, told apart at their midpoints."""
    return (f"""{p}_o AS (SELECT v, {f} AS f, lead(v) OVER (ORDER BY v) AS nv FROM {source}),
{p} AS (SELECT list(f ORDER BY v) AS fs, list((v + nv) / 2 ORDER BY v) FILTER (WHERE nv IS NOT NULL) AS thrs FROM {p}_o)""",
            f"{p}.fs[1 + len([t FOR t IN {p}.thrs IF t < v.{SEARCH_COL}])]")


def values_model(p: str, src: str) -> Model:
    """A tree that tells all values apart: their training means."""
    ctes, prediction = _by_value(p, f"{p}_v", "s / n")
    return f"{p}_v AS (SELECT {SEARCH_COL} AS v, count(*) AS n, sum(price) AS s FROM {src} GROUP BY {SEARCH_COL}),\n" + ctes, \
        prediction


def boosted_stumps_model(p: str, src: str, iterations: int, step: float = 0.1) -> Model:
    """Boosted depth-1 trees, squared loss, all on sums by value: the first fits the label, the
    others the pseudo-residual 2 (y - f) with weight ``step``."""
    ctes = [f"{p}_v AS (SELECT {SEARCH_COL} AS v, count(*) AS n, sum(price) AS s, 0.0 AS f FROM {src} GROUP BY {SEARCH_COL})"]
    before = f"{p}_v"
    for i in range(iterations):
        ctes.append(f"{p}_r{i} AS (SELECT v, n, {'s' if i == 0 else '2 * (s - n * f) AS s'} FROM {before})")
        ctes.append(_search_cte(f"{p}_s{i}", f"{p}_r{i}"))
        ctes.append(f"{p}_f{i} AS (SELECT x.v, x.n, x.s, x.f + {step if i else 1.0} * CASE WHEN x.v <= t.thr THEN t.pl ELSE t.pr END AS f "
                    f"FROM {before} x CROSS JOIN {p}_s{i} t)")
        before = f"{p}_f{i}"
    last, prediction = _by_value(p, before, "f")
    return ",\n".join([*ctes, last]).replace(" AS (SELECT", " AS MATERIALIZED (SELECT"), prediction


def linear_descent_model(p: str, src: str, step: float, steps: int) -> Model:
    """Full-batch gradient steps of a linear model from zero on the scaled column, step / sqrt(t) each."""
    x = f"((r.{SEARCH_COL} - m.mn) / (m.mx - m.mn))"
    ctes = f"""{p}_m AS MATERIALIZED (SELECT min({SEARCH_COL}) AS mn, max({SEARCH_COL}) AS mx FROM {src}),
{p}_a AS MATERIALIZED (SELECT avg({x}) AS x, avg({x} * {x}) AS xx, avg(r.price) AS y, avg({x} * r.price) AS xy
  FROM {src} r CROSS JOIN {p}_m m),
{p}_w AS (SELECT 0 AS i, CAST(0 AS DOUBLE) AS w0, CAST(0 AS DOUBLE) AS w1 UNION ALL
  SELECT w.i + 1, w.w0 - {step} / sqrt(w.i + 1) * 2 * (w.w0 + w.w1 * a.x - a.y),
         w.w1 - {step} / sqrt(w.i + 1) * 2 * (w.w0 * a.x + w.w1 * a.xx - a.xy)
  FROM {p}_w w CROSS JOIN {p}_a a WHERE w.i < {steps}),
{p} AS (SELECT w.w0, w.w1, m.mn, m.mx FROM {p}_w w CROSS JOIN {p}_m m WHERE w.i = {steps})"""
    return ctes, f"{p}.w0 + {p}.w1 * (v.{SEARCH_COL} - {p}.mn) / ({p}.mx - {p}.mn)"


def compare_model(kind: str, map_id: int, p: str, src: str) -> Model:
    """The model that a learner's map of the comparison gives on the rows of ``src``: depths 2 and
    10, depths 1 and 10, 2 and 20 iterations, 100 steps of two sizes."""
    if kind == "fm":
        return linear_descent_model(p, src, (0.1, 0.5)[map_id], 100)
    if kind == "gbt":
        return boosted_stumps_model(p, src, (2, 20)[map_id])
    if map_id == 1:
        return values_model(p, src)
    return (depth2_model if kind == "dt" else stump_model)(p, src, SEARCH_COL)


def _scores(kind: str, tag: str, src: str, rows: str, model_of=search_model) -> tuple[list[str], list[str]]:
    """CTEs of a learner's two maps fitted on ``src``, and their metrics on ``rows``."""
    ctes, selects = [], []
    for i in (0, 1):
        p = f"{tag}_{kind}{i}"
        cte, prediction = model_of(kind, i, p, src)
        ctes.append(cte)
        selects.append(f"SELECT '{kind}' AS learner, {i} AS map_id, '{tag}' AS tag, "
                       f"1 - avg(power(v.price - ({prediction}), 2)) / var_pop(v.price) AS r2, "
                       f"sqrt(avg(power(v.price - ({prediction}), 2))) AS rmse "
                       f"FROM {rows} v CROSS JOIN {p}")
    return ctes, selects


def search_ctes(kinds: tuple[str, ...], method: str, model_of=search_model) -> str:
    """``scores``: (learner, map_id, score, std, rmse) of a search over the training rows."""
    if method == "cv":
        parts = [(f"f{k}", f"fit{k}", f"eval{k}") for k in range(3)]
        sources = [f"fit{k} AS (SELECT * FROM train WHERE fold <> {k}),\n"
                   f"eval{k} AS (SELECT * FROM train WHERE fold = {k})" for k in range(3)]
    else:
        parts = [("h", "fith", "evalh")]
        sources = ["fith AS (SELECT * FROM train WHERE NOT is_validation),\n"
                   "evalh AS (SELECT * FROM train WHERE is_validation)"]
    ctes, selects = list(sources), []
    for tag, src, rows in parts:
        for kind in kinds:
            more, parts_sql = _scores(kind, tag, src, rows, model_of)
            ctes += more
            selects += parts_sql
    name = f"scores_{method}"
    ctes.append(f"{name}_all AS (" + "\nUNION ALL\n".join(selects) + ")")
    ctes.append(f"{name} AS (SELECT learner, map_id, avg(r2) AS score, stddev_pop(r2) AS std, "
                f"avg(rmse) AS rmse FROM {name}_all GROUP BY learner, map_id)")
    return ",\n".join(ctes)


def _param_columns(kind: str) -> str:
    return ", ".join(f"CASE map_id WHEN 0 THEN CAST({v[0]!r} AS DOUBLE) ELSE CAST({v[1]!r} AS DOUBLE) END "
                     f"AS {name}" for name, v in SEARCH_MAPS[kind])


def search_table_sql(kind: str, method: str) -> str:
    metrics = ("round(score, 8) AS avg_r2, round(std, 8) AS std_r2, round(rmse, 4) AS avg_rmse"
               if method == "cv" else "round(score, 8) AS valid_r2, round(rmse, 4) AS valid_rmse")
    return with_prep_ctes(search_ctes((kind,), method),
                          f"SELECT map_id, {_param_columns(kind)}, {metrics} FROM scores_{method}")


def best_params_sql() -> str:
    return with_prep_ctes(search_ctes(("dt",), "cv"),
                          f"SELECT map_id, {_param_columns('dt')}, round(score, 8) AS avg_r2 FROM scores_cv "
                          "ORDER BY score DESC, map_id LIMIT 1")


def model_compare_sql() -> str:
    kinds = tuple(SEARCH_MAPS)
    ctes = [search_ctes(kinds, "cv", compare_model), search_ctes(kinds, "holdout", compare_model)]
    selects = []
    for kind in kinds:
        more, parts = _scores(kind, "t", "train", "test", compare_model)
        ctes += more
        selects += parts
    ctes.append("final AS (" + "\nUNION ALL\n".join(selects) + ")")
    chosen = " UNION ALL ".join(
        f"SELECT learner, '{m}' AS selection, map_id, row_number() OVER (PARTITION BY learner "
        f"ORDER BY score DESC, map_id) AS place FROM scores_{m}" for m in ("cv", "holdout"))
    # the solver's steps are a recursion
    return with_prep_ctes(",\n".join(ctes), f"""SELECT c.learner, c.selection, c.map_id AS best_map,
       round(f.r2, 8) AS test_r2, round(f.rmse, 4) AS test_rmse
FROM ({chosen}) c JOIN final f ON f.learner = c.learner AND f.map_id = c.map_id WHERE c.place = 1""").replace("WITH ", "WITH RECURSIVE ", 1)


def tree_importance_sql(cols: tuple[str, ...] = ("l_quantity", "l_discount", "l_tax")) -> str:
    """A depth-2 tree over several columns: at the root and in each side the best split over
    all of them; a split's importance is its gain times its rows,
    sl^2/nl + sr^2/nr - s^2/n for the variance."""
    def search(p: str, src: str, sides: bool) -> str:
        side = "side, " if sides else ""
        values = "\nUNION ALL\n".join(
            f"SELECT {side}'{c}' AS f, {c} AS v, count(*) AS n, sum(price) AS s FROM {src} GROUP BY {side}{c}"
            for c in cols)
        over = f"PARTITION BY {side}f ORDER BY v"
        return f"""{p}_v AS ({values}),
{p}_c AS (SELECT {side}f, v, lead(v) OVER ({over}) AS nv,
       sum(n) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nl,
       sum(s) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sl,
       sum(n) OVER (PARTITION BY {side}f) AS nt, sum(s) OVER (PARTITION BY {side}f) AS st FROM {p}_v),
{p}_g AS (SELECT {side}f, (v + nv) / 2 AS thr,
       sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt AS gain FROM {p}_c WHERE nv IS NOT NULL),
{p} AS (SELECT * FROM (SELECT *, row_number() OVER ({'PARTITION BY side ' if sides else ''}ORDER BY gain DESC)
       AS place FROM {p}_g) WHERE place = 1 AND gain > 0)"""
    value = "CASE r.f " + " ".join(f"WHEN '{c}' THEN x.{c}" for c in cols) + " END"
    ctes = f"""{search("root", "train", False)},
sided AS (SELECT x.*, {value} <= r.thr AS side FROM train x CROSS JOIN root r),
{search("child", "sided", True)},
gains AS (SELECT f, gain FROM root UNION ALL SELECT f, gain FROM child)"""
    names = ", ".join(f"('{c}')" for c in cols)
    return with_prep_ctes(ctes, f"""SELECT t.f AS feature,
       round(coalesce(sum(g.gain), 0) / (SELECT sum(gain) FROM gains), 8) AS importance
FROM (VALUES {names}) t(f) LEFT JOIN gains g ON g.f = t.f GROUP BY t.f""")


def eval_metrics_sql() -> str:
    """R² and RMSE of the cells' training means over the test rows."""
    cell = f"cell AS (SELECT {_CK}, avg(price) AS p FROM train GROUP BY {_CK})"
    return with_prep_ctes(cell, f"""SELECT round(1 - avg(power(v.price - c.p, 2)) / var_pop(v.price), 8) AS r2,
       round(sqrt(avg(power(v.price - c.p, 2))), 4) AS rmse, count(*) AS n FROM test v JOIN cell c ON {_CK_JOIN}""")


# ---------------------------------------------------------------- registry

def _schema_report_sql() -> str:
    types = [("l_orderkey", "bigint"), ("l_linenumber", "int"), ("l_partkey", "bigint"),
             ("l_suppkey", "bigint"), ("l_returnflag", "string"),
             ("l_linestatus", "string"), ("line_label", "string"), ("is_discounted", "int"),
             ("ship_date", "string"), ("l_quantity", "double"), ("l_extendedprice", "double"),
             ("l_discount", "double"), ("l_tax", "double"), ("ship_epoch", "bigint"),
             ("price", "double"), ("ship_month", "int"), ("ship_day", "int"), ("ship_year", "int")]
    parts = [f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, "
             f"count({c}) AS non_null, count(*) AS n_rows FROM prep"
             for i, (c, t) in enumerate(types)]
    return with_prep("\nUNION ALL\n".join(parts))


def _string_index_sql() -> str:
    cols = ("l_returnflag", "l_linestatus", "line_label")
    ctes = ",\n".join(string_index_cte(c) for c in cols)
    sel = ", ".join(f"idx_{c}.ix AS {c}_idx" for c in cols)
    joins = " ".join(f"LEFT JOIN idx_{c} ON idx_{c}.label = p.{c}" for c in cols)
    return with_prep_ctes(ctes, f"SELECT {', '.join('p.' + k for k in KEYS)}, {sel} FROM prep p {joins}")


def _brand_index_sql() -> str:
    cols = ("p_brand", "p_type")
    ctes = ",\n".join(string_index_cte(c, source="part") for c in cols)
    sel = ", ".join(f"idx_{c}.ix AS {c}_idx" for c in cols)
    joins = " ".join(f"LEFT JOIN idx_{c} ON idx_{c}.label = p.{c}" for c in cols)
    return f"WITH {ctes}\nSELECT p.p_partkey, {sel} FROM part p {joins}"


def _scored_rows_sql() -> str:
    ctes = ",\n".join(string_index_cte(c) for c in CELL_KEYS)
    body = f"""SELECT {V_KEY}, idx_l_returnflag.ix AS f_0,
       idx_l_linestatus.ix AS f_1, round(c.p, 4) AS prediction, v.price AS trueLabel
FROM test v JOIN cell c ON {_CK_JOIN}
LEFT JOIN idx_l_returnflag ON idx_l_returnflag.label = v.l_returnflag
LEFT JOIN idx_l_linestatus ON idx_l_linestatus.label = v.l_linestatus"""
    return with_prep_ctes(ctes + f",\ncell AS (SELECT {_CK}, avg(price) AS p FROM train GROUP BY {_CK})",
                          body)


def _two_dates_sql() -> str:
    parts = ", ".join(f"CAST({unit}({date}) AS INTEGER) AS {name}_{unit}" for name, date in
                      (("order", "o.o_orderdate"), ("ship", "l.l_shipdate")) for unit in ("month", "day", "year"))
    return f"""SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
       CAST(epoch(l.l_shipdate) AS BIGINT) AS ship_epoch,
       CAST(l.l_discount > 0.05 AS INTEGER) AS is_discounted,
       CAST(o.o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) AS is_urgent, {parts}
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""


def oracle_queries() -> dict[str, str]:
    small = ("l_quantity", "l_discount", "l_tax")
    out = {
        "csv_scan": PREPARED,
        "schema_scan": PREPARED,
        "view_sql": PREPARED,
        "parquet_sink": PREPARED,
        "project_cast": with_prep(
            f"SELECT {KEY}, l_returnflag, l_linestatus, line_label, "
            "is_discounted, l_quantity, l_extendedprice, l_discount, l_tax, "
            "price AS trueLabel FROM prep"),
        "date_parts": with_prep(f"SELECT {KEY}, ship_date, ship_month, ship_day, ship_year FROM prep"),
        "two_dates": _two_dates_sql(),
        "hash_split": with_prep(f"SELECT {KEY}, CASE WHEN in_train "
                                "THEN 'train' ELSE 'test' END AS split FROM prep"),
        "random_split": with_prep(f"SELECT {KEY}, CASE WHEN drawn "
                                  "THEN 'train' ELSE 'test' END AS split FROM prep"),
        "split_counts": with_prep("SELECT CASE WHEN in_train THEN 'train' ELSE 'test' "
                                  "END AS split, count(*) AS n_rows FROM prep GROUP BY 1"),
        "fold_assign": with_prep(f"SELECT {KEY}, fold FROM train"),
        "holdout_assign": with_prep(f"SELECT {KEY}, is_validation FROM train"),
        "preview": with_prep(f"SELECT {PREP_COLS} FROM prep ORDER BY {KEY} LIMIT 20"),
        "schema_report": _schema_report_sql(),
        "row_count": with_prep("SELECT count(*) AS n_rows FROM prep"),
        "scored_rows": _scored_rows_sql(),
        "string_index": _string_index_sql(),
        "brand_index": _brand_index_sql(),
        "vector_index": encoded_frame_sql(parts="cat"),
        "minmax_scale": encoded_frame_sql(parts="num"),
        "assemble_features": encoded_frame_sql(parts="all"),
        "dt_predict": predictions_sql(),
        "rf_predict": predictions_sql(),
        "gbt_predict": predictions_sql(),
        "gbt_plain": predictions_sql(),
        "stream_score": predictions_sql(),
        "stump_predict": model_predictions_sql(stump_model("p", "train", "l_quantity")),
        "depth2_predict": model_predictions_sql(depth2_model("p", "train", "l_quantity")),
        "gbt_stumps_predict": model_predictions_sql(boosted_model("p", "train", "l_quantity")),
        "fm_gd_predict": model_predictions_sql(linear_steps_model("p", "train", small, 0.5, "gd")),
        "fm_adamw_predict": model_predictions_sql(linear_steps_model("p", "train", small, 1.0, "adamW")),
        "fm_identity": with_prep(f"SELECT {KEY}, CAST(0 AS DOUBLE) AS error FROM test"),
        "best_params": best_params_sql(),
        "eval_metrics": eval_metrics_sql(),
        "tree_importance": tree_importance_sql(),
        "model_compare": model_compare_sql(),
    }
    for kind in SEARCH_MAPS:
        for method in ("cv", "holdout"):
            out[f"{kind}_{method}"] = search_table_sql(kind, method)
    return out
