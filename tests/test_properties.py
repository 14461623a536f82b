import datetime as dt

import numpy as np
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import SF_MAIN
from pricetrend.operators.indicators import INDICATORS
from pricetrend.operators.trend import TREND_COLUMNS
from pricetrend.plans.panels import indicators_from_bars, trends_from_bars
from pricetrend.sources.bars import lineitem_bars


def test_prefix_stability(spark):
    """Appending bars never changes earlier rows (cut inside an EMA block)."""
    bars = lineitem_bars(spark, SF_MAIN, "day")
    cut = dt.datetime(1999, 3, 15)   # about 1,500 bars in: inside an EMA block of each series
    full = indicators_from_bars(bars, "day").where(F.col("bar_ts") <= cut)
    part = indicators_from_bars(bars.where(F.col("bar_ts") <= cut), "day")
    cols = ["symbol", "bar_no"] + INDICATORS
    a = full.select(cols).toPandas().sort_values(["symbol", "bar_no"]).reset_index(drop=True)
    b = part.select(cols).toPandas().sort_values(["symbol", "bar_no"]).reset_index(drop=True)
    assert len(a) == len(b)
    for c in INDICATORS:
        x, y = a[c].to_numpy(float), b[c].to_numpy(float)
        assert np.array_equal(np.isnan(x), np.isnan(y)), c
        assert np.allclose(x[~np.isnan(x)], y[~np.isnan(y)], rtol=1e-12, atol=1e-9), c


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000), st.floats(-0.5, 0.5), st.integers(520, 700))
def test_ranges_on_random_walks(spark, seed, drift, n):
    rng = np.random.default_rng(seed)
    close = 100 + np.cumsum(drift + rng.normal(0, 1, n))
    spread = np.abs(rng.normal(0, 1, len(close)))
    t0 = dt.datetime(2024, 1, 1)
    rows = [("W", t0 + dt.timedelta(hours=i), float(c), float(c + s), float(c - s), float(c))
            for i, (c, s) in enumerate(zip(close, spread))]
    bars = spark.createDataFrame(rows, "symbol string, bar_ts timestamp_ntz, open double, "
                                       "high double, low double, close double")
    p = trends_from_bars(bars, "hour").toPandas()
    assert len(p) == len(rows)
    for c in ("stck", "rsi"):
        v = p[c].dropna()
        assert ((v >= -1e-9) & (v <= 100 + 1e-9)).all(), c
    for c in TREND_COLUMNS:
        assert set(p[c].unique()) <= {-1, 0, 1}, c
