"""Plan-shape regression tests: the scale claims in the README, as assertions."""
import os
import re

import pytest
from pyspark import StorageLevel

from pricewise.operators import evaluate as ev
from pricewise.operators import tuning as tu
from pricewise.operators.learners import make_learner
from pricewise.plans import lineitem as li
from pricewise.plans import queries as Q


def _plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "4000")
    return df._jdf.queryExecution().executedPlan().toString()


def _read_columns(plan: str) -> set[str]:
    cols = set()
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        cols |= {field.split(":")[0] for field in schema.split(",") if field}
    return cols


KEY_COLUMNS = {"l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"}


def test_split_reads_only_the_key(spark, sf_small):
    plan = _plan(Q.q_hash_split(spark, sf_small))
    assert _read_columns(plan) == KEY_COLUMNS
    assert "Exchange" not in plan


def test_cached_training_rows_hold_key_inputs_and_label(spark, sf_small, monkeypatch):
    """What ``eval_metrics`` caches before its fit."""
    cached = []
    real = Q.persisted

    def spy(df):
        cached.append(df.columns)
        return real(df)
    monkeypatch.setattr(Q, "persisted", spy)
    Q.q_eval_metrics(spark, sf_small).collect()
    assert cached == [[*li.KEY, "l_returnflag", "l_linestatus", "price"]]


def test_rows_for_encoders_are_not_spread(spark, sf_small, monkeypatch):
    """Encoders need no order: what is cached for them has their inputs only and no shuffle."""
    cached = []
    real = Q.persisted

    def spy(df):
        cached.append((df.columns, _plan(df)))
        return real(df)
    monkeypatch.setattr(Q, "persisted", spy)
    Q.q_assemble_features(spark, sf_small)
    (columns, plan), = cached
    assert columns == list(li.FULL_SPEC.input_columns)
    assert "Exchange" not in plan and "Sort" not in plan


def test_scoring_and_metrics_plan(spark, sf_small):
    train, test = Q._split(spark, sf_small, li.CELL_SPEC)
    model = tu.plain_fit(train, li.CELL_SPEC, make_learner("dt", li.LABEL, maxDepth=5))
    plan = _plan(ev.regression_metrics(model.transform(test), li.LABEL))
    # unused columns never leave the file
    assert not _read_columns(plan) & {"l_quantity", "l_comment"}
    # test rows are not moved to be scored: one small exchange for the global aggregate
    assert re.findall(r"Exchange (\w+)", plan) == ["SinglePartition"]
    assert "partial_" in plan


def test_preview_is_a_top_k(spark, sf_small):
    plan = _plan(Q.q_preview(spark, sf_small))
    assert "TakeOrderedAndProject" in plan


def test_a_failed_search_leaves_nothing_cached(spark, sf_small):
    train, _ = Q._split(spark, sf_small, li.CELL_SPEC)
    est = make_learner("dt", li.LABEL, maxDepth=2)
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    with pytest.raises(ValueError, match="empty"):
        tu.cross_validate(spark, train.selectExpr("*", "0 as fold"), li.CELL_SPEC, est, [{}], li.KEY, 2)
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == before
    assert StorageLevel.NONE == train.storageLevel


def test_entry_without_a_package_of_the_corpus_part():
    """A missing package of the optional part leaves the rest, with a warning that names it."""
    import subprocess
    import sys
    code = ("import sys, warnings; sys.modules['zstandard'] = None\n"
            "with warnings.catch_warnings(record=True) as w:\n"
            "    warnings.simplefilter('always'); import __spark_entry__ as e\n"
            "assert 'linreg_predict' in e.queries() and 'op1_warc' not in e.queries()\n"
            "assert not any('op' == k[:2] and k[2].isdigit() for k in e.oracle_sql())\n"
            "import os\n"
            "assert not os.path.isdir('pricewise/llm') or any('zstandard' in str(x.message) for x in w)\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_comparison_lets_every_learner_work(spark, monkeypatch):
    """Half of the forest's maps could not split and the machine took two steps from factors of zero."""
    groups = Q._search_groups(Q.COMPARE_PARAMS, Q.COMPARE_GRIDS)
    ests = {k: [est.copy(pm) for pm in maps] for k, (est, maps) in groups.items()}
    assert set(ests) == {"dt", "rf", "gbt", "fm"}
    assert all(e.getMinInfoGain() == 0.0 for k in ("dt", "rf", "gbt") for e in ests[k])
    assert {e.getMaxIter() for e in ests["fm"]} == {100} and all(e.getInitStd() > 1e-3 for e in ests["fm"])
    assert max(e.getMaxIter() for e in ests["gbt"]) == 20 and max(e.getMaxDepth() for e in ests["dt"] + ests["rf"]) == 10
    used, real = [], Q._search_groups

    def stop(*a):
        used.append(real(*a))
        raise InterruptedError
    monkeypatch.setattr(Q, "_search_groups", stop)
    monkeypatch.setattr(Q, "_split", lambda *a: (None, None))
    with pytest.raises(InterruptedError):
        Q.q_model_compare(None, "")
    assert {k: [str(sorted((p.name, v) for p, v in pm.items())) for pm in maps] for k, (_, maps) in used[0].items()} == \
        {k: [str(sorted((p.name, v) for p, v in pm.items())) for pm in maps] for k, (_, maps) in groups.items()}
