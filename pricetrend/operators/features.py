"""Feature selection, imputation and scaling per series.

Per-symbol statistics are grouped aggregates (partial, so a hot symbol is
combined map-side), joined back by ``keyed.join_series``, which never shuffles
data rows on the symbol alone. No window spans a whole series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from pricetrend.operators.indicators import INDICATORS, LAGGED
from pricetrend.operators.keyed import join_series
from pricetrend.operators.trend import TREND_COLUMNS

# Columns that are keys, label or target price, never features.
NON_FEATURES = {"bar_no", "close", "movement", "price_change", "blk", "pos",
                "split_hash", "split_rank", "group_size", "is_test", "fold", "role"}
LAG_COLUMNS = [f"{x}_lag" for x in LAGGED]


def numeric_columns(df: DataFrame, exclude: set[str] | None = None) -> list[str]:
    """Numeric columns in schema order, minus keys, label and close."""
    ex = NON_FEATURES | (exclude or set())
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in ex]


def feature_set(df: DataFrame, name: str) -> list[str]:
    """Named feature sets.

    continuous         other price columns + 10 indicators
    continuous_lagged  continuous + the 7 indicator lags
    trend_superset     continuous_lagged + the 10 trend signals
    trend_only         the 10 trend signals
    """
    nums = numeric_columns(df)
    extra = [c for c in nums if c not in INDICATORS and c not in LAG_COLUMNS
             and c not in TREND_COLUMNS]
    continuous = extra + [c for c in INDICATORS if c in nums]
    if name == "continuous":
        return continuous
    lagged = continuous + [c for c in LAG_COLUMNS if c in nums]
    if name == "continuous_lagged":
        return lagged
    if name == "trend_superset":
        return lagged + [c for c in TREND_COLUMNS if c in nums]
    if name == "trend_only":
        return [c for c in TREND_COLUMNS if c in nums]
    raise ValueError(f"unknown feature set {name}")


def impute_mean(df: DataFrame, cols: list[str], scope: str | None = None) -> DataFrame:
    """NULL -> mean of the column over the symbol's rows (or its ``scope`` rows).

    A column that is NULL for every row of a symbol becomes 0.0: for the
    scaled models this equals dropping the column, which is what a mean
    imputer does with an all-missing feature.
    """
    src = df.where(F.col(scope)) if scope else df
    stats = src.groupBy("symbol").agg(*[F.avg(c).alias(f"_m_{c}") for c in cols])
    out = join_series(df, stats)
    return out.select(*[F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}"), F.lit(0.0)).alias(c)
                        if c in cols else F.col(c) for c in df.columns])


def standard_scale(df: DataFrame, cols: list[str], fit_on: str | None = None) -> DataFrame:
    """(x - mean) / population std per symbol; a constant column becomes 0.

    ``fit_on`` names a boolean column selecting the rows the statistics come
    from (F2: the training rows); ``None`` fits on all rows (F3).
    """
    src = df.where(F.col(fit_on)) if fit_on else df
    stats = src.groupBy("symbol").agg(
        *[F.avg(c).alias(f"_m_{c}") for c in cols],
        *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    out = join_series(df, stats)

    def z(c):
        s = F.col(f"_s_{c}")
        return F.coalesce(F.try_divide(F.col(c) - F.col(f"_m_{c}"),
                                       F.when(s > 0, s)), F.lit(0.0))
    return out.select(*[z(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def impute_and_scale(df: DataFrame, cols: list[str], fit_on: str | None = None) -> DataFrame:
    """F1 followed by F2/F3 from a single pass of statistics and a single join.

    Imputing puts the overall mean m in place of each NULL. Of n fitted rows of
    which k have a value (mean a, variance v), the imputed column then has mean
    ``(k*a + (n-k)*m) / n`` and variance
    ``(k*(v + (a-mean)^2) + (n-k)*(m-mean)^2) / n``.
    """
    return _filled_and_scaled(df, cols, scaling(df, cols, fit_on))


def impute_and_minmax(df: DataFrame, cols: list[str]) -> DataFrame:
    """F1 followed by F4 onto [-1, 1] from a single pass of statistics and a single join."""
    return _filled_and_scaled(df, cols, minmax_scaling(df, cols))


def _filled_and_scaled(df: DataFrame, cols: list[str], stats: DataFrame) -> DataFrame:
    joined = join_series(df, stats)

    def z(c):
        s, x = F.col(f"_s_{c}"), F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}"))
        return F.coalesce(F.try_divide(x - F.col(f"_c_{c}"), F.when(s > 0, s)), F.lit(0.0))
    return joined.select(*[z(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def scaling(df: DataFrame, cols: list[str], fit_on: str | None = None) -> DataFrame:
    """Per symbol, for each column c: what fills a NULL (_m_c) and the centre (_c_c) and
    deviation (_s_c) of the filled column over the fitted rows (see ``impute_and_scale``)."""
    fit = F.col(fit_on) if fit_on else F.lit(True)
    aggs = [F.count(F.when(fit, 1)).alias("_n")]
    for c in cols:
        x = F.when(fit, F.col(c).cast("double"))
        aggs += [F.avg(c).alias(f"_m_{c}"), F.count(x).alias(f"_k_{c}"), F.avg(x).alias(f"_a_{c}"), F.var_pop(x).alias(f"_v_{c}")]
    raw = df.groupBy("symbol").agg(*aggs)
    out = [F.col("symbol")]
    for c in cols:
        n, k = F.col("_n"), F.col(f"_k_{c}")
        m, a, v = (F.coalesce(F.col(f"_{x}_{c}"), F.lit(0.0)) for x in "mav")
        mean = F.try_divide(k * a + (n - k) * m, n)
        var = F.try_divide(k * (v + (a - mean) * (a - mean)) + (n - k) * (m - mean) * (m - mean), n)
        out += [m.alias(f"_m_{c}"), mean.alias(f"_c_{c}"), F.sqrt(var).alias(f"_s_{c}")]
    return raw.select(*out)


def minmax_scaling(df: DataFrame, cols: list[str]) -> DataFrame:
    """What ``scaling`` gives, for F4 onto [-1, 1]: centre and half of each column's range. A mean
    in place of a NULL widens no range. A constant column gets -1, by half a range of 1."""
    raw = df.groupBy("symbol").agg(*[a for c in cols for x in (F.col(c).cast("double"),)
                                     for a in (F.avg(x).alias(f"_a_{c}"), F.min(x).alias(f"_lo_{c}"), F.max(x).alias(f"_hi_{c}"))])
    out = [F.col("symbol")]
    for c in cols:
        mean, lo, hi = (F.coalesce(F.col(f"_{x}_{c}"), F.lit(0.0)) for x in ("a", "lo", "hi"))
        out += [mean.alias(f"_m_{c}"), F.when(hi > lo, (lo + hi) / 2).otherwise(lo + 1).alias(f"_c_{c}"),
                F.when(hi > lo, (hi - lo) / 2).otherwise(F.lit(1.0)).alias(f"_s_{c}")]
    return raw.select(*out)


def minmax_scale(df: DataFrame, cols: list[str], lo: float = -1.0, hi: float = 1.0,
                 fit_on: str | None = None) -> DataFrame:
    """map [min, max] of each column per symbol onto [lo, hi]; zero range -> lo."""
    src = df.where(F.col(fit_on)) if fit_on else df
    stats = src.groupBy("symbol").agg(*[F.min(c).alias(f"_lo_{c}") for c in cols],
                                      *[F.max(c).alias(f"_hi_{c}") for c in cols])
    out = join_series(df, stats)

    def mm(c):
        rng = F.col(f"_hi_{c}") - F.col(f"_lo_{c}")
        unit = F.coalesce(F.try_divide(F.col(c) - F.col(f"_lo_{c}"), F.when(rng > 0, rng)),
                          F.lit(0.0))
        return unit * F.lit(hi - lo) + F.lit(lo)
    return out.select(*[mm(c).alias(c) if c in cols else F.col(c) for c in df.columns])
