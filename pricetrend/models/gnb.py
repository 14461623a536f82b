"""M6/M7: Gaussian naive Bayes as grouped aggregates, all series in one job.

Fit: per (symbol, class) count, mean and population variance of every
feature; every variance is increased by ``var_smoothing`` times the largest
feature variance of the symbol's training rows; log prior = log(n_c / n).
Predict: joint log-likelihood per class
    log prior - 0.5 * sum log(2*pi*var) - 0.5 * sum (x - mean)^2 / var
and the larger one wins (ties go to class 0). Labels are 0/1.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricetrend.operators.keyed import join_series

# Fixed value: default variance smoothing of the Gaussian naive Bayes model.
VAR_SMOOTHING = 1e-9
CLASSES = (0, 1)


def gnb_stats(train: DataFrame, features: list[str], label: str = "movement",
              var_smoothing: float = VAR_SMOOTHING) -> DataFrame:
    """One row per (symbol, class): n, log_prior, mean_<f>, var_<f> (smoothed)."""
    per_class = train.groupBy("symbol", label).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(f).alias(f"mean_{f}") for f in features],
        *[F.var_pop(f).alias(f"var_{f}") for f in features])
    eps = train.groupBy("symbol").agg(
        (F.greatest(*[F.var_pop(f) for f in features], F.lit(0.0))
         * F.lit(var_smoothing)).alias("_eps"))
    total = F.sum("n").over(Window.partitionBy("symbol"))  # <= 2 rows per symbol
    return (per_class.join(eps, "symbol")
            .select("symbol", F.col(label).cast("int").alias(label), "n",
                    F.log(F.col("n") / total).alias("log_prior"),
                    *[F.col(f"mean_{f}") for f in features],
                    *[(F.col(f"var_{f}") + F.col("_eps")).alias(f"var_{f}") for f in features]))


def gnb_wide(stats: DataFrame, features: list[str], label: str = "movement") -> DataFrame:
    """One row per symbol with the class statistics side by side."""
    aggs = []
    for k in CLASSES:
        is_k = F.col(label) == k
        aggs.append(F.max(F.when(is_k, F.col("log_prior"))).alias(f"lp{k}"))
        for f in features:
            aggs.append(F.max(F.when(is_k, F.col(f"mean_{f}"))).alias(f"m{k}_{f}"))
            aggs.append(F.max(F.when(is_k, F.col(f"var_{f}"))).alias(f"v{k}_{f}"))
    return stats.groupBy("symbol").agg(*aggs)


def _jll(k: int, features: list[str]) -> Column:
    two_pi = F.lit(2.0 * math.pi)
    norm = sum((F.log(two_pi * F.col(f"v{k}_{f}")) for f in features), F.lit(0.0))
    dist = sum((F.try_divide(F.pow(F.col(f) - F.col(f"m{k}_{f}"), 2), F.col(f"v{k}_{f}")) for f in features),
               F.lit(0.0))
    return F.col(f"lp{k}") - F.lit(0.5) * norm - F.lit(0.5) * dist


def gnb_predict(df: DataFrame, stats: DataFrame, features: list[str],
                label: str = "movement") -> DataFrame:
    """Add ``jll0``, ``jll1`` and ``prediction`` (INT) to every row of ``df``."""
    wide = gnb_wide(stats, features, label)
    j = join_series(df, wide)
    j = j.withColumn("jll0", _jll(0, features)).withColumn("jll1", _jll(1, features))
    # Without a likelihood for either class (every feature of the series is constant) the
    # prior decides; a series without training rows has none and its prediction is NULL.
    prior = F.when(F.col("lp0").isNull() & F.col("lp1").isNull(), F.lit(None)).when(
        F.coalesce("lp1", F.lit(-math.inf)) > F.coalesce("lp0", F.lit(-math.inf)), F.lit(1)).otherwise(F.lit(0))
    pred = (F.when(F.col("jll0").isNull() & F.col("jll1").isNull(), prior)
            .when(F.col("jll0").isNull(), F.lit(1))
            .when(F.col("jll1").isNull(), F.lit(0))
            .when(F.col("jll1") > F.col("jll0"), F.lit(1)).otherwise(F.lit(0))).cast("int")
    return j.select(*df.columns, "jll0", "jll1", pred.alias("prediction"))


def with_probability(predicted: DataFrame) -> DataFrame:
    """Add ``p1``, the probability of class 1, from the joint log-likelihoods."""
    gap = F.least(F.greatest(F.col("jll0") - F.col("jll1"), F.lit(-700.0)), F.lit(700.0))
    return predicted.withColumn("p1", F.lit(1.0) / (F.lit(1.0) + F.exp(gap)))
