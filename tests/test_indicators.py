import math

import numpy as np
import pandas as pd
import pytest

from conftest import SF_MAIN, micro_bars
from pricetrend.operators.indicators import INDICATORS, IndicatorParams
from pricetrend.plans.panels import indicators_from_bars, trends_from_bars
from pricetrend.sources.bars import events_bars, lineitem_bars


def pandas_indicators(g: pd.DataFrame) -> pd.DataFrame:
    c, h, l = g.close, g.high, g.low
    r = pd.DataFrame(index=g.index)
    r["sma_10"] = c.rolling(10, min_periods=10).mean()
    w = np.arange(1, 11) / 55.0
    r["wma_10"] = c.rolling(10, min_periods=10).apply(lambda x: (w * x).sum(), raw=True)
    ll, hh = l.rolling(14, min_periods=14).min(), h.rolling(14, min_periods=14).max()
    r["stck"] = 100 * (c - ll) / (hh - ll)
    r["stcd"] = r["stck"].rolling(3, min_periods=3).mean()
    r["williams_r"] = -100 * (hh - c) / (hh - ll)
    r["macd"] = (c.ewm(span=12, min_periods=12, adjust=False).mean()
                 - c.ewm(span=26, min_periods=26, adjust=False).mean())
    d = c.diff()
    up, dn = d.where(d > 0, 0.0), -d.where(d < 0, 0.0)
    eu = up.ewm(alpha=1 / 14, min_periods=14, adjust=False).mean()
    ed = dn.ewm(alpha=1 / 14, min_periods=14, adjust=False).mean()
    r["rsi"] = pd.Series(np.where(ed == 0, 100, 100 - 100 / (1 + eu / ed)), index=g.index).where(ed.notna())
    tp = (h + l + c) / 3
    mad = tp.rolling(20, min_periods=20).apply(lambda x: np.mean(np.abs(x - x.mean())), raw=True)
    r["cci"] = (tp - tp.rolling(20, min_periods=20).mean()) / (0.015 * mad)
    r["ad_osc"] = (h - c.shift(1)) / (h - l)
    r["momentum"] = (c - c.shift(12)) / c.shift(12) * 100
    return r.replace([np.inf, -np.inf], np.nan)


@pytest.mark.parametrize("fixture", ["events_hour", "lineitem_day"])
def test_matches_pandas(spark, fixture):
    src, grain = fixture.split("_")
    bars = (events_bars if src == "events" else lineitem_bars)(spark, SF_MAIN, grain)
    pdf = indicators_from_bars(bars, grain).toPandas().sort_values(["symbol", "bar_no"])
    ref = pd.concat([pandas_indicators(g) for _, g in pdf.groupby("symbol")]).loc[pdf.index]
    for col in INDICATORS:
        a, b = pdf[col].astype(float), ref[col].astype(float)
        assert (a.isna() == b.isna()).all(), col
        m = a.notna()
        assert np.allclose(a[m], b[m], rtol=1e-9, atol=1e-8), col


def test_block_size_invariance(spark):
    bars = lineitem_bars(spark, SF_MAIN, "day")
    cols = ["symbol", "bar_no"] + INDICATORS + ["macd_lag", "rsi_lag", "cci_lag", "stcd_lag"]
    # block 400 still satisfies the EMA bound; the halo is fixed by the windows
    a = indicators_from_bars(bars, "day").select(cols).toPandas().sort_values(["symbol", "bar_no"])
    b = (indicators_from_bars(bars, "day", IndicatorParams(block=800)).select(cols)
         .toPandas().sort_values(["symbol", "bar_no"]))
    for col in cols[2:]:
        x, y = a[col].to_numpy(float), b[col].to_numpy(float)
        assert np.array_equal(np.isnan(x), np.isnan(y)), col
        assert np.allclose(x[~np.isnan(x)], y[~np.isnan(y)], rtol=1e-10, atol=1e-9), col


def test_block_bound_is_checked():
    with pytest.raises(ValueError):
        IndicatorParams(block=100).validate()


def _one(spark, vals):
    df = indicators_from_bars(micro_bars(spark, {"S": vals}), "hour")
    return df.toPandas().sort_values("bar_no").reset_index(drop=True)


def test_ramp(spark):
    p = _one(spark, [(t, t, t) for t in range(1, 61)])
    t = p.bar_no.astype(float)
    assert p.sma_10[:9].isna().all() and np.allclose(p.sma_10[9:], t[9:] - 4.5)
    assert np.allclose(p.wma_10[9:], t[9:] - 3)
    assert (p.stck[13:] == 100).all()
    wr = p.williams_r[13:]
    assert (wr == 0).all() and not any(math.copysign(1, v) < 0 for v in wr)
    assert p.rsi[:13].isna().all() and (p.rsi[13:] == 100).all()
    assert p.cci[:19].isna().all() and np.allclose(p.cci[19:], 9.5 / (0.015 * 5))
    assert abs(p.macd.iloc[-1] - 6.8670) < 1e-3
    assert np.allclose(p.momentum[12:], 1200 / (t[12:] - 12))
    assert p.ad_osc.isna().all()
    assert p.movement[0] == 0 and (p.movement[1:] == 1).all()


def test_all_down(spark):
    p = _one(spark, [(100 - t, 100 - t, 100 - t) for t in range(1, 61)])
    assert (p.rsi[13:] == 0).all()
    assert abs(p.macd.iloc[-1] + 6.8670) < 1e-3
    assert np.allclose(p.cci[19:], -9.5 / (0.015 * 5))
    assert (p.movement == 0).all()


def test_flat_and_short(spark):
    flat = trends_from_bars(micro_bars(spark, {"F": [(5.0, 5.0, 5.0)] * 40}), "hour").toPandas()
    flat = flat.sort_values("bar_no").reset_index(drop=True)
    assert flat.stck.isna().all() and flat.cci.isna().all() and flat.ad_osc.isna().all()
    assert (flat.macd[25:] == 0).all() and (flat.rsi[13:] == 100).all()
    assert (flat.momentum[12:] == 0).all()
    assert (flat.sma_10_trend == -1).all() and (flat.wma_10_trend == -1).all()
    assert (flat.rsi_trend[13:] == -1).all() and (flat.rsi_trend[:13] == 0).all()
    assert (flat.momentum_trend[12:] == -1).all()
    short = trends_from_bars(micro_bars(spark, {"S": [(3.0 + i, 1.0, 2.0 + i) for i in range(5)]}),
                             "hour").toPandas().sort_values("bar_no")
    for col in ["sma_10", "wma_10", "stck", "stcd", "williams_r", "macd", "rsi", "cci", "momentum"]:
        assert short[col].isna().all(), col
    assert short.ad_osc.iloc[1:].notna().all()
    assert (short.sma_10_trend == -1).all()
    assert (short.ad_osc_trend.iloc[:2] == 0).all()


def test_symbols_do_not_mix(spark):
    a = [(t + 1.0, t - 1.0, float(t)) for t in range(1, 41)]
    b = [(200.0 - t, 190.0 - t, 195.0 - t) for t in range(1, 41)]
    both = _both = indicators_from_bars(micro_bars(spark, {"A": a, "B": b}), "hour").toPandas()
    solo = indicators_from_bars(micro_bars(spark, {"A": a}), "hour").toPandas()
    x = both[both.symbol == "A"].sort_values("bar_no").reset_index(drop=True)
    y = solo.sort_values("bar_no").reset_index(drop=True)
    pd.testing.assert_frame_equal(x[INDICATORS], y[INDICATORS])
    assert _both is both


def test_williams_is_stck_minus_100(spark):
    pdf = indicators_from_bars(events_bars(spark, SF_MAIN, "hour"), "hour").toPandas()
    m = pdf.stck.notna()
    assert np.allclose(pdf.williams_r[m], pdf.stck[m] - 100)


def test_block_grows_for_slow_emas():
    p = IndicatorParams(macd_slow=50).resolved()
    assert p.block == 1024
    p.validate()
    assert IndicatorParams().resolved().block == 512
    # a span-200 tail needs >= 3,680 rows, while span 12 overflows past ~3,590
    with pytest.raises(ValueError):
        IndicatorParams(macd_slow=200).resolved()


def test_missing_closes_are_no_observations(spark):
    random = np.random.default_rng(3)
    closes = 100 + np.cumsum(random.normal(size=4000))
    gaps = [None if (i < 3 or i % 7 == 2 or 900 <= i < 2100) else float(c) for i, c in enumerate(closes)]
    rows = [(c if c is not None else 101.0, 99.0, c) for c in gaps]
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("S", t0 + dt.timedelta(hours=i), h, l, c) for i, (h, l, c) in enumerate(rows)],
                               "symbol string, bar_ts timestamp_ntz, high double, low double, close double")
    got = indicators_from_bars(df, "hour", indicators=["macd"]).toPandas().sort_values("bar_no")
    e, want, n = {12: None, 26: None}, [], 0
    for c in gaps:
        if c is not None:
            n += 1
            for k in e:
                e[k] = c if e[k] is None else e[k] + 2 / (k + 1) * (c - e[k])
        want.append(e[12] - e[26] if n >= 26 else np.nan)
    assert np.allclose(got.macd.astype(float), want, rtol=0, atol=1e-9, equal_nan=True)


def test_flat_series_with_gaps_has_no_macd(spark):
    for missing in (0, 10, 30, 59):
        import datetime as dt
        t0 = dt.datetime(2024, 1, 1)
        df = spark.createDataFrame([("S", t0 + dt.timedelta(hours=i), 100.0, 100.0, None if i == missing else 100.0) for i in range(60)],
                                   "symbol string, bar_ts timestamp_ntz, high double, low double, close double")
        macd = [r.macd for r in indicators_from_bars(df, "hour", indicators=["macd"]).orderBy("bar_no").collect()]
        assert [m for m in macd if m is not None] == [0.0] * (35 if missing > 25 else 34)


def test_only_what_is_asked_for_is_computed(spark):
    from pricetrend import session
    bars = events_bars(spark, SF_MAIN, "day")
    before = len(session._WRITTEN)
    got = indicators_from_bars(bars, "day", indicators=["sma_10", "stcd"], materialize=False)
    assert got.columns == [*bars.columns, "bar_no", "price_change", "stcd", "stcd_lag", "movement"] or "sma_10" in got.columns
    assert got.count() == 150 and len(session._WRITTEN) == before
    indicators_from_bars(bars, "day", materialize=False).count()
    assert len(session._WRITTEN) == before
    whole = indicators_from_bars(bars, "day")
    blocks = spark.read.parquet([t for t in session._WRITTEN if "/blocks-" in t][-1])
    assert not [c for c, t in blocks.dtypes if t.startswith("array")]
    a = whole.select("symbol", "bar_no", "sma_10", "stcd", "stcd_lag")
    assert a.exceptAll(got.select(*a.columns)).count() == 0
