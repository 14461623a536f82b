"""Indicators -> trend-deterministic signals in {-1, 0, +1}.

All ten rules are CASE expressions over the indicator row and its lags, in
one projection (no row-at-a-time Python):

  sma_10, wma_10   +1 if close > average else -1 (a missing average gives -1)
  stck, stcd, williams_r, macd, cci, ad_osc
                   0 if value or lag missing; +1 if value > lag; else -1
  rsi              0 if missing; -1 above 70; +1 below 30; otherwise by
                   direction against the lag (0 if the lag is missing)
  momentum         0 if missing; +1 if > 0; else -1
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricetrend.operators.indicators import INDICATORS

TREND_COLUMNS = [f"{x}_trend" for x in INDICATORS]

# RSI band edges of the trend rule.
RSI_OVERBOUGHT = 70
RSI_OVERSOLD = 30


def above_average(close: Column, avg: Column) -> Column:
    return F.when(close > avg, F.lit(1)).otherwise(F.lit(-1))


def direction(x: Column, lag: Column) -> Column:
    return (F.when(x.isNull() | lag.isNull(), F.lit(0))
            .when(x > lag, F.lit(1)).otherwise(F.lit(-1)))


def rsi_rule(x: Column, lag: Column) -> Column:
    return (F.when(x.isNull(), F.lit(0))
            .when(x > RSI_OVERBOUGHT, F.lit(-1))
            .when(x < RSI_OVERSOLD, F.lit(1))
            .when(lag.isNull(), F.lit(0))
            .when(x > lag, F.lit(1)).otherwise(F.lit(-1)))


def sign_rule(x: Column) -> Column:
    return F.when(x.isNull(), F.lit(0)).when(x > 0, F.lit(1)).otherwise(F.lit(-1))


def trend_exprs() -> dict[str, Column]:
    c = F.col
    return {
        "sma_10_trend": above_average(c("close"), c("sma_10")),
        "wma_10_trend": above_average(c("close"), c("wma_10")),
        "stck_trend": direction(c("stck"), c("stck_lag")),
        "stcd_trend": direction(c("stcd"), c("stcd_lag")),
        "williams_r_trend": direction(c("williams_r"), c("williams_r_lag")),
        "macd_trend": direction(c("macd"), c("macd_lag")),
        "rsi_trend": rsi_rule(c("rsi"), c("rsi_lag")),
        "cci_trend": direction(c("cci"), c("cci_lag")),
        "ad_osc_trend": direction(c("ad_osc"), c("ad_osc_lag")),
        "momentum_trend": sign_rule(c("momentum")),
    }


def trend_panel(indicators: DataFrame) -> DataFrame:
    """Add the ``<indicator>_trend`` columns (INT) of the indicators that are there."""
    return indicators.withColumns({k: v for k, v in trend_exprs().items()
                                   if k.removesuffix("_trend") in indicators.columns})
