from pyspark.sql import functions as F

from conftest import SF_MAIN, micro_bars
from pricetrend.operators.trend import TREND_COLUMNS
from pricetrend.plans.panels import fixture_trends, trends_from_bars


def test_trend_domain_and_identity(spark):
    t = fixture_trends(spark, SF_MAIN, "events_hour")
    for c in TREND_COLUMNS:
        vals = {r[0] for r in t.select(c).distinct().collect()}
        assert vals <= {-1, 0, 1}, c
    # %R = %K - 100, so the two trends agree except where rounding splits an exact tie
    differ = t.where((F.col("stck_trend") != F.col("williams_r_trend"))
                     & (F.abs(F.col("stck") - F.col("stck_lag")) > 1e-9))
    assert differ.count() == 0


def test_zero_range_bar_gives_zero_ad_trend_twice(spark):
    vals = [(10.0 + i % 3, 8.0 - i % 2, 9.0 + (i % 5) / 10) for i in range(30)]
    vals[20] = (9.5, 9.5, 9.5)
    t = trends_from_bars(micro_bars(spark, {"Z": vals}), "hour").toPandas().sort_values("bar_no")
    t = t.reset_index(drop=True)
    assert t.ad_osc.isna()[20]
    assert t.ad_osc_trend[20] == 0 and t.ad_osc_trend[21] == 0
    assert set(t.ad_osc_trend[2:20]) <= {-1, 1}


def test_rsi_bands_win_over_lag(spark):
    down = [(100.0 - t, 100.0 - t, 100.0 - t) for t in range(1, 40)]
    t = trends_from_bars(micro_bars(spark, {"D": down}), "hour").toPandas().sort_values("bar_no")
    assert (t.rsi_trend.iloc[13:] == 1).all()
