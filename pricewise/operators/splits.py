"""Row splitting (D1-D3) and row counts (A1, A2).

Every split is a pure function of the row key (md5), so it needs no shuffle, is
identical on every run, executor and number of cores, and can be written in SQL.
The key must be the row's own: rows that share one go to the same side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import HASH_RANGE, hash_value

SPLIT_COL = "split"
FOLD_COL = "fold"
HOLDOUT_COL = "is_validation"

# Independent digest lanes per use.
SPLIT_LANE = 0
FOLD_LANE = 1
HOLDOUT_LANE = 2

#: Partitions that training rows are spread over, and rows for which one more is added.
#: Both depend on the data only: learners that sample rows by partition give the same
#: model on any cluster.
SPREAD_PARTITIONS = 8
ROWS_PER_PARTITION = 1_000_000


def hash_cut(ratio: float) -> int:
    """Hash values below it make up ``ratio`` of the rows."""
    if not 0.0 < ratio < 1.0:
        raise ValueError(f"ratio must be in (0, 1), got {ratio}")
    return round(ratio * HASH_RANGE)


def with_hash_split(df: DataFrame, key_cols: Sequence[str], train_ratio: float = 0.7,
                    col: str = SPLIT_COL) -> DataFrame:
    """Add ``split`` = 'train' | 'test' from the key's hash."""
    first = hash_value(key_cols, SPLIT_LANE) < hash_cut(train_ratio)
    return df.withColumn(col, F.when(first, F.lit("train")).otherwise(F.lit("test")))


def hash_split(df: DataFrame, key_cols: Sequence[str], train_ratio: float = 0.7
               ) -> tuple[DataFrame, DataFrame]:
    """(train, test) by key hash. Both sides are filters over the same plan."""
    value, cut = hash_value(key_cols, SPLIT_LANE), hash_cut(train_ratio)
    return df.filter(value < cut), df.filter(value >= cut)


def with_random_split(df: DataFrame, key_cols: Sequence[str], train_ratio: float = 0.7,
                      seed: int = 42, col: str = SPLIT_COL) -> DataFrame:
    """One random draw per row (D1): another seed gives another, independent split. Drawn
    from the seed and the row key, so the order and the partitions of the rows don't
    matter."""
    draw = hash_value(key_cols, SPLIT_LANE, seed) < hash_cut(train_ratio)
    return df.withColumn(col, F.when(draw, F.lit("train")).otherwise(F.lit("test")))


def with_folds(df: DataFrame, key_cols: Sequence[str], num_folds: int = 3,
               col: str = FOLD_COL) -> DataFrame:
    """Fold id in ``[0, num_folds)`` from an independent digest lane."""
    if num_folds < 2:
        raise ValueError("num_folds must be >= 2")
    return df.withColumn(col, (hash_value(key_cols, FOLD_LANE) % num_folds).cast("int"))


def with_holdout_flag(df: DataFrame, key_cols: Sequence[str], train_ratio: float = 0.8,
                      col: str = HOLDOUT_COL) -> DataFrame:
    """Boolean validation flag for a hold-out search (D3): true for the ``1 - ratio`` part."""
    return df.withColumn(col, hash_value(key_cols, HOLDOUT_LANE) >= hash_cut(train_ratio))


def split_counts(df: DataFrame, col: str = SPLIT_COL) -> DataFrame:
    """Rows per split in one aggregate (A2): partial counts per task, tiny shuffle."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("rows"))


def row_count(df: DataFrame) -> DataFrame:
    """Row count of a frame as a one-row DataFrame (A1)."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def spread_partitions(n_rows: int) -> int:
    """Partitions for ``n_rows`` training rows."""
    return max(SPREAD_PARTITIONS, -(-n_rows // ROWS_PER_PARTITION))


def spread(df: DataFrame, key_cols: Sequence[str], partitions: int) -> DataFrame:
    """Training rows dealt by the hash of the row key into ``partitions`` partitions, in
    order of that hash. Always applied, whatever the scan's partitions and the cluster's
    cores are: which rows a learner samples, and in which order it reads them, then depends
    on the data and ``partitions`` only. Apply it to pruned rows."""
    order = F.xxhash64(*key_cols)
    return df.repartition(partitions, *key_cols).sortWithinPartitions(order, *key_cols)
