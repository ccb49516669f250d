import pytest
from pyspark.sql import functions as F

from pricewise.operators import splits as sp
from pricewise.plans import lineitem as li


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_the_key_is_unique(spark, sf):
    df = li.prepared_frame(spark, f"/root/testdata/sf{sf}").select(*li.KEY)
    assert df.count() == df.distinct().count()


@pytest.mark.parametrize("ratio", [0.7, 0.705, 1 / 3])
def test_hash_split_disjoint_complete_stable(spark, sf_small, ratio):
    df = li.prepared_frame(spark, sf_small)
    train, test = sp.hash_split(df, li.KEY, ratio)
    n, a, b = df.count(), train.count(), test.count()
    assert a + b == n
    assert train.join(test, list(li.KEY), "inner").count() == 0
    assert abs(a / n - ratio) < 0.03
    train2, _ = sp.hash_split(df.repartition(7), li.KEY, ratio)
    assert train2.select(*li.KEY).exceptAll(train.select(*li.KEY)).count() == 0


def test_folds_and_holdout_flags(spark, sf_small):
    df = li.prepared_frame(spark, sf_small)
    folds = sp.with_folds(df, li.KEY, 3).groupBy(sp.FOLD_COL).count().collect()
    assert sorted(r[0] for r in folds) == [0, 1, 2]
    flagged = sp.with_holdout_flag(df, li.KEY, 0.8)
    share = flagged.filter(F.col(sp.HOLDOUT_COL)).count() / flagged.count()
    assert 0.15 < share < 0.25


def test_hot_order_key_does_not_tip_the_splits(spark, sf_small):
    """A third of the rows share an order key: their rows are still dealt out one by one."""
    df = li.prepared_frame(spark, sf_small)
    hot = F.when(F.pmod(F.xxhash64(*li.KEY), F.lit(3)) == 0, F.lit(1)).otherwise(F.col("l_orderkey"))
    df = df.withColumn("l_orderkey", hot.cast("long")).cache()
    n = df.count()
    assert df.filter("l_orderkey = 1").count() > 0.3 * n
    train, _ = sp.hash_split(df, li.KEY, 0.7)
    assert abs(train.count() / n - 0.7) < 0.02
    for r in sp.with_folds(df, li.KEY, 3).groupBy(sp.FOLD_COL).count().collect():
        assert abs(r["count"] / n - 1 / 3) < 0.02
    df.unpersist()


def test_split_counts_and_row_count(spark, sf_small):
    df = sp.with_hash_split(li.prepared_frame(spark, sf_small), li.KEY, 0.7)
    counts = {r["split"]: r["rows"] for r in sp.split_counts(df).collect()}
    assert sum(counts.values()) == sp.row_count(df).first()["rows"]


def test_random_split_does_not_depend_on_partitions(spark, sf_small):
    df = li.prepared_frame(spark, sf_small)
    pick = lambda d, seed: {tuple(r) for r in sp.with_random_split(d, li.KEY, 0.7, seed)
                            .filter("split = 'train'").select(*li.KEY).collect()}
    assert pick(df, 7) == pick(df.repartition(13), 7)
    assert len(pick(df, 7) ^ pick(df, 8)) > 1000


def test_bad_ratio_rejected():
    for ratio in (0.0, 1.0, -0.1):
        with pytest.raises(ValueError):
            sp.hash_cut(ratio)


def test_spread_depends_on_the_rows_only(spark, sf_small):
    df = li.pruned(li.prepared_frame(spark, sf_small), li.CELL_SPEC)
    parts = [[[tuple(r) for r in p] for p in sp.spread(d, li.KEY, 5).rdd.glom().collect()]
             for d in (df, df.repartition(11))]
    assert parts[0] == parts[1] and len(parts[0]) == 5
    assert sp.spread_partitions(10) == sp.SPREAD_PARTITIONS
    assert sp.spread_partitions(10**9) == 1000
