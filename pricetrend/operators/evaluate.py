"""A1-A10 metrics, the probability threshold M11, and the top-k selection rules G5-G8."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def correct(label: str = "movement", prediction: str = "prediction") -> Column:
    """1.0 or 0.0; a missing prediction is wrong."""
    return F.coalesce((F.col(prediction) == F.col(label)).cast("double"), F.lit(0.0))


def by_threshold(probability: str | Column, threshold: float = 0.5) -> Column:
    """Class 1 iff the probability is above the threshold (a missing one is class 0)."""
    p = F.col(probability) if isinstance(probability, str) else probability
    return F.when(p > threshold, F.lit(1)).otherwise(F.lit(0))


def accuracy_by(df: DataFrame, keys: list[str], label: str = "movement",
                prediction: str = "prediction") -> DataFrame:
    """A1: accuracy (and row count) per group."""
    return df.groupBy(*keys).agg(F.avg(correct(label, prediction)).alias("accuracy"),
                                 F.count(F.lit(1)).alias("n"))


def f1_by(df: DataFrame, keys: list[str], label: str = "movement",
          prediction: str = "prediction") -> DataFrame:
    """A10: F1 of the positive class per group."""
    y, p = F.col(label), F.col(prediction)
    tp = F.sum(((y == 1) & (p == 1)).cast("double"))
    fp = F.sum(((y == 0) & (p == 1)).cast("double"))
    fn = F.sum(((y == 1) & (p == 0)).cast("double"))
    return df.groupBy(*keys).agg(
        F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1"))


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int = 3,
          rank_col: str = "rank") -> DataFrame:
    """The first k rows per group under ``order`` (a report, so k is the feature)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def top3_value_then_larger(df: DataFrame, keys: list[str], value: str, param: str) -> DataFrame:
    """Sort (value, param) descending as tuples and keep three."""
    return top_k(df, keys, [F.desc(value), F.desc(param)], 3)


def top3_value_then_earlier(df: DataFrame, keys: list[str], value: str,
                            grid_index: str = "grid_index") -> DataFrame:
    """Strict-improvement insertion: equal values keep the earlier grid point;
    only values above zero enter the three slots."""
    return top_k(df.where(F.col(value) > 0), keys, [F.desc(value), F.asc(grid_index)], 3)


def first_k(df: DataFrame, k: int = 3, grid_index: str = "grid_index") -> DataFrame:
    """The first k grid points, whatever their score."""
    return df.where(F.col(grid_index) < k)
