"""Alternating least squares over (user, item, rating) rows.

Fits are MLlib's ALS: ratings are dealt into user and item blocks once, and each half step
ships only the factors that a block needs. ``half_step`` is the same least-squares step for
rank 1 as one aggregate: with the items' factors held, a user's factor is
sum(r * v) / (sum(v * v) + reg * n), n the user's ratings (MLlib scales its penalty so)."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .learners import DEFAULT_SEED

#: What an unknown user or item gets: ``drop`` its rows, or a ``nan`` prediction.
COLD_START = ("drop", "nan")


def one_rating(rows: DataFrame, user: str, item: str, rating: Column | str) -> DataFrame:
    """(user, item, rating): the mean rating of every pair. Rows with a null are left out."""
    r = F.col(rating) if isinstance(rating, str) else rating
    return rows.select(F.col(user).alias("user"), F.col(item).alias("item"), r.cast("double").alias("rating")) \
        .dropna().groupBy("user", "item").agg(F.avg("rating").alias("rating"))


def fit_als(ratings: DataFrame, rank: int = 4, reg: float = 0.1, iterations: int = 10,
            cold_start: str = "drop", seed: int = DEFAULT_SEED, blocks: int = 10) -> ALSModel:
    """Factors of (user, item, rating); ids are integers. Lineage is cut every second step."""
    if cold_start not in COLD_START:
        raise ValueError(f"cold_start must be one of {COLD_START}")
    ensure_checkpoint_dir(ratings.sparkSession)
    return ALS(rank=rank, regParam=reg, maxIter=iterations, userCol="user", itemCol="item", ratingCol="rating",
               coldStartStrategy=cold_start, seed=seed, checkpointInterval=2,
               numUserBlocks=blocks, numItemBlocks=blocks).fit(ratings)


def half_step(ratings: DataFrame, factors: DataFrame, reg: float) -> DataFrame:
    """(user, factor) of rank 1 from ``factors`` (item, factor). Ratings of items without a
    factor don't count; a user without any has no row."""
    v = F.col("factor")
    return ratings.join(factors, "item").groupBy("user").agg(
        (F.sum(F.col("rating") * v) / (F.sum(v * v) + reg * F.count(F.lit(1)))).alias("factor"))


def held_out_error(model: ALSModel, train: DataFrame, test: DataFrame) -> DataFrame:
    """One row: RMSE of the model and of the mean training rating over the test pairs that the
    model scores, and how many of the test pairs these are."""
    mean = train.agg(F.avg("rating")).first()[0]
    scored = model.transform(test).filter(~F.isnan("prediction"))
    return scored.agg(F.sqrt(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2))).alias("rmse"),
                      F.sqrt(F.avg(F.pow(F.col("rating") - F.lit(mean), 2))).alias("rmse_of_mean"),
                      F.count(F.lit(1)).alias("n_scored"))
