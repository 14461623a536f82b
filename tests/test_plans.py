"""Plan-shape checks: bounded window partitions, no tick re-scan, no cross joins."""

import re

from pyspark.sql import functions as F

from conftest import SF_MAIN
from pricetrend.operators.sequence import number_bars
from pricetrend.plans.panels import fixture_trends
from pricetrend.sources.bars import events_bars


def _executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_panel_windows_are_partitioned_by_block(spark):
    plan = _executed(fixture_trends(spark, SF_MAIN, "events_hour"))
    specs = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", plan)
    assert specs, plan
    # Bar rows are only ever windowed inside (symbol, blk); windows without blk run on
    # the table of block ends, which has one row per block.
    for spec in specs:
        assert "symbol" in spec, spec
    for m in re.finditer(r"Window (\[.*?\]), \[([^\]]*)\], \[", plan):
        if "blk" not in m[2] and "_super" not in m[2]:
            assert "_group" in m[2], m[0]
    assert "events.parquet" not in plan          # ticks were aggregated once, upstream
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_numbering_windows_are_bounded(spark):
    plan = _executed(number_bars(events_bars(spark, SF_MAIN, "hour"), grain="hour"))
    specs = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", plan)
    # row numbers run inside (symbol, chunk), sums over chunks inside (symbol, group of chunks)
    assert any("_chunk" in s for s in specs) and any("_group" in s for s in specs)
    assert all("," in s for s in specs), specs


def test_no_window_is_partitioned_by_the_symbol_alone(spark):
    for name in ("macd_hourly", "rsi_14_hourly", "indicator_panel", "trend_panel"):
        import __spark_entry__
        plan = _executed(__spark_entry__.queries()[name](spark, SF_MAIN))
        specs = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", plan)
        assert specs and all("," in s for s in specs), (name, specs)


def _scaled(spark, monkeypatch, broadcast_rows):
    """NB and SVM features with auto-broadcast off, as a large size estimate would have it."""
    from pricetrend.operators import features, keyed
    from pricetrend.session import cut_lineage
    panel = cut_lineage(fixture_trends(spark, SF_MAIN, "events_hour"), "panel")
    cols = features.feature_set(panel, "continuous")
    base = panel.select("symbol", "bar_no", (F.col("bar_no") % 5 > 0).alias("is_train"), *cols)
    monkeypatch.setattr(features, "join_series", lambda df, s: keyed.join_series(df, s, broadcast_rows=broadcast_rows, salts=8))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = features.impute_and_scale(base, cols, "is_train")
        two = features.standard_scale(features.impute_mean(base, cols), cols, "is_train")
        return _executed(out), out.toPandas(), two.toPandas(), cols
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_data_rows_are_not_shuffled_on_the_symbol_alone(spark, monkeypatch):
    import numpy as np
    plan, one, two, cols = _scaled(spark, monkeypatch, 100)
    assert "hashpartitioning(symbol" not in plan and plan.count("panel-") <= 1 + plan.count("Location")
    key = ["symbol", "bar_no"]
    a, b = (d.sort_values(key)[cols].to_numpy(float) for d in (one, two))
    assert np.allclose(a, b, atol=1e-9)
    plan, salted, _, _ = _scaled(spark, monkeypatch, 0)
    dealt = [line for line in plan.splitlines() if "hashpartitioning(" in line]
    assert dealt and all("salt" in line for line in dealt), dealt
    assert np.allclose(salted.sort_values(key)[cols].to_numpy(float), a, atol=1e-12)
