"""Deterministic hold-out splits, balanced split and stratified folds.

The shuffle of a seeded random permutation is replaced by an md5 order:
``split_hash = md5(symbol|bar_no|seed)``; the test set is the first
ceil(test_size * n) rows of each symbol by that hash. Ranks come from
``ranking.hash_rank`` (bounded buckets), so counts are exact and independent
of partitioning, and the same hash orders the folds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricetrend.operators.keyed import join_series
from pricetrend.operators.ranking import hash_rank, md5_key


def with_split_hash(df: DataFrame, seed: int = 42) -> DataFrame:
    return df.withColumn("split_hash", md5_key("symbol", "bar_no", salt=str(seed)))


def holdout_split(df: DataFrame, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """add ``is_test`` (exactly ceil(test_size * n) rows per symbol) and ``split_rank``."""
    h = hash_rank(with_split_hash(df, seed), ["symbol"], "split_hash", "split_rank", "group_size")
    n_test = F.ceil(F.col("group_size") * F.lit(test_size))
    return (h.withColumn("is_test", F.col("split_rank") <= n_test)
            .withColumn("is_train", ~F.col("is_test"))
            .drop("group_size"))


def ntile_of(rank: str, size: str, k: int):
    """ntile(k) for a 1-based rank in a group of ``size`` rows, 0-based result."""
    n, i = F.col(size), F.col(rank)
    q = F.floor(n / k)
    r = n - q * k
    big = r * (q + 1)
    return (F.when(i <= big, F.floor((i - 1) / (q + 1)))
            .otherwise(r + F.floor((i - 1 - big) / F.greatest(q, F.lit(1))))).cast("int")


def stratified_folds(df: DataFrame, k: int = 5, label: str = "movement",
                     train_col: str = "is_train") -> DataFrame:
    """F8: ``fold`` in 0..k-1 for training rows, by class, contiguous in hash order.

    Every class of every symbol is cut into k runs of near-equal size
    (ntile), so each fold keeps the class ratio. Test rows get fold -1.
    """
    train = df.where(F.col(train_col))
    ranked = hash_rank(train.select("symbol", "bar_no", label, "split_hash"),
                       ["symbol", label], "split_hash", "_crank", "_csize")
    folds = ranked.select("symbol", "bar_no", ntile_of("_crank", "_csize", k).alias("fold"))
    return (df.join(folds, ["symbol", "bar_no"], "left")
            .withColumn("fold", F.coalesce("fold", F.lit(-1))))


def balanced_split(df: DataFrame, tune_fraction: float = 0.2, label: str = "movement",
                   seed: int = 42) -> DataFrame:
    """equal class counts; ``role`` in {tune, eval, surplus}, no row dropped.

    m = the smaller class count of the symbol. In each class the first m rows
    by hash are balanced; the first ceil(tune_fraction * m) of them tune the
    parameters, the rest evaluate. Rows past m are marked ``surplus``.
    """
    h = with_split_hash(df, seed)
    ranked = hash_rank(h, ["symbol", label], "split_hash", "_crank", "_csize")
    m = ranked.groupBy("symbol").agg(
        F.when(F.count_distinct(label) >= 2, F.min("_csize")).otherwise(F.lit(0)).alias("_m"))
    out = join_series(ranked, m)
    n_tune = F.ceil(F.col("_m") * F.lit(tune_fraction))
    role = (F.when(F.col("_crank") <= n_tune, F.lit("tune"))
            .when(F.col("_crank") <= F.col("_m"), F.lit("eval"))
            .otherwise(F.lit("surplus")))
    return out.withColumn("role", role).drop("_crank", "_csize", "_m")
