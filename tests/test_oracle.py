"""Spark plans vs the independent DuckDB formulations (exact after rounding)."""

import math

import duckdb
import pandas as pd
import pytest

from conftest import SF_SMALL
import __spark_entry__ as entry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SAMPLE = ["ohlc_bars_6h", "ohlc_bars_lineitem_daily", "chronological_index",
          "movement_label_horizon1", "macd", "rsi_14", "indicator_panel", "trend_panel",
          "split_70_30", "stratified_folds", "balanced_split", "gnb_accuracy", "csv_daily_bars",
          "macd_with_gaps", "cci_20", "impute_mean", "standard_scale_train", "minmax_scale",
          "trend_sink", "gnb_threshold", "param_grid", "signal_overall", "signal_report",
          "signal_top3_earlier", "rf_trend_stumps", "rf_trend_cv",
          "balanced_features", "gnb_balanced_accuracy", "gnb_balanced_trend_accuracy"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(df: pd.DataFrame):
    df = df[sorted(df.columns)]
    out = []
    for rec in df.itertuples(index=False):
        out.append(tuple(None if v is None or (isinstance(v, float) and math.isnan(v))
                         else (pd.Timestamp(v).isoformat() if hasattr(v, "year") else v)
                         for v in rec))
    return sorted(out, key=repr)


def test_every_query_has_a_callable():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert all(callable(f) for f in q.values())


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_duckdb(spark, con, name):
    s = entry.queries()[name](spark, SF_SMALL).toPandas()
    d = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert _norm(s) == _norm(d)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 150
