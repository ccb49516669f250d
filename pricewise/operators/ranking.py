"""Areas under the ROC and the precision-recall curve of a score, exact with ties.

Equal scores are counted together first (partial aggregation), so a score that a third of
all rows share is one row. The distinct scores are sorted by range partitions; a partition's
running counts start from the totals of the partitions before it, so no window spans all
rows. Both areas are trapezoids over the points of the distinct scores; the PR curve
begins at recall 0 with the precision of the highest score, as MLlib's does."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def running_counts(scored: DataFrame, label: str, score: str, partitions: int | None = None) -> DataFrame:
    """One row per distinct score: pos, neg, and the sums ``above_pos``, ``above_neg`` of all
    higher scores. Rows with a null label or score are left out; NaN is the highest score."""
    spark = scored.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    positive = F.col(label).cast("double") > 0.5
    groups = scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull()) \
        .groupBy(F.col(score).cast("double").alias("score")) \
        .agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    # range bounds are sampled: the partition of a row is written down once
    ensure_checkpoint_dir(spark)
    dealt = groups.repartitionByRange(n, F.desc("score")) \
        .withColumn("part", F.spark_partition_id()).checkpoint()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("part").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")) \
        .select("part", F.coalesce(F.sum("p").over(before), F.lit(0)).alias("p"),
                F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"))  # a row per partition
    within = Window.partitionBy("part").orderBy(F.desc("score")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    return dealt.join(F.broadcast(starts), "part").select(
        "score", "pos", "neg", (F.col("p") + F.coalesce(F.sum("pos").over(within), F.lit(0))).alias("above_pos"),
        (F.col("n") + F.coalesce(F.sum("neg").over(within), F.lit(0))).alias("above_neg"))


def areas(scored: DataFrame, label: str, score: str, partitions: int | None = None) -> DataFrame:
    """One row: area_roc, area_pr, n_pos, n_neg. An area is null where its axes have no rows:
    without positives both, without negatives the ROC's."""
    rows = running_counts(scored, label, score, partitions)
    pos, neg, above_pos, above_neg = map(F.col, ("pos", "neg", "above_pos", "above_neg"))
    precision = (above_pos + pos) / (above_pos + pos + above_neg + neg)
    higher = above_pos + above_neg
    last = F.when(higher > 0, above_pos / higher).otherwise(precision)
    sums = rows.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"), F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"),
                    F.sum(neg * (above_pos + pos / 2)).alias("roc"), F.sum(pos * (precision + last) / 2).alias("pr"))
    return sums.select(F.try_divide(F.col("roc"), F.col("n_pos") * F.col("n_neg")).alias("area_roc"),
                       F.try_divide("pr", "n_pos").alias("area_pr"), "n_pos", "n_neg")
