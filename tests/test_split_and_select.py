import math

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_MAIN
from pricetrend.operators.evaluate import top3_value_then_earlier, top3_value_then_larger
from pricetrend.operators.ranking import hash_rank, md5_key
from pricetrend.operators.split import balanced_split, holdout_split, stratified_folds
from pricetrend.plans.panels import fixture_indicators


def _panel(spark):
    return fixture_indicators(spark, SF_MAIN, "events_hour").select("symbol", "bar_no", "movement")


def test_hash_rank_equals_row_number(spark):
    df = _panel(spark).withColumn("h", md5_key("symbol", "bar_no"))
    got = hash_rank(df, ["symbol"], "h").toPandas()
    pdf = df.toPandas().sort_values(["symbol", "h"])
    pdf["exp"] = pdf.groupby("symbol").cumcount() + 1
    m = got.merge(pdf, on=["symbol", "bar_no"])
    assert (m.hash_rank == m.exp).all() and len(m) == len(pdf)


def test_holdout_exact_counts(spark):
    for ts in (0.2, 0.3):
        s = holdout_split(_panel(spark), ts).groupBy("symbol").agg(
            F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect()
        for r in s:
            assert r.t == math.ceil(r.n * ts)


def test_folds_are_stratified(spark):
    x = stratified_folds(holdout_split(_panel(spark), 0.3), 5).toPandas()
    assert (x[~x.is_train].fold == -1).all()
    tr = x[x.is_train]
    sizes = tr.groupby(["symbol", "movement", "fold"]).size().unstack()
    assert ((sizes.max(axis=1) - sizes.min(axis=1)) <= 1).all()


def test_balanced_split_roles(spark):
    x = balanced_split(_panel(spark)).toPandas()
    bal = x[x.role != "surplus"].groupby(["symbol", "movement"]).size().unstack()
    assert (bal[0] == bal[1]).all()
    assert len(x) == _panel(spark).count()


def _grid(spark):
    rows = [("s", 0, 10, .8), ("s", 1, 20, .9), ("s", 2, 30, .9), ("s", 3, 40, .7), ("s", 4, 50, .8)]
    return spark.createDataFrame(rows, "symbol string, grid_index int, ntrees int, value double")


def test_top3_ties_prefer_larger_ntrees(spark):
    got = top3_value_then_larger(_grid(spark), ["symbol"], "value", "ntrees").orderBy("rank")
    assert [r.ntrees for r in got.collect()] == [30, 20, 50]


def test_top3_ties_prefer_earlier_grid_point(spark):
    got = top3_value_then_earlier(_grid(spark), ["symbol"], "value").orderBy("rank")
    assert [r.grid_index for r in got.collect()] == [1, 2, 0]


def test_forward_label_horizon(spark):
    from pricetrend.plans.panels import fixture_trends
    from pricetrend.plans.prepare import prepare
    t = fixture_trends(spark, SF_MAIN, "events_hour")
    x0, _ = prepare(t, "nb", "trend")
    x1, _ = prepare(t, "nb", "trend", horizon=1)
    a = {(r.symbol, r.bar_no): r.movement for r in x0.select("symbol", "bar_no", "movement").collect()}
    b = {(r.symbol, r.bar_no): r.movement for r in x1.select("symbol", "bar_no", "movement").collect()}
    n_sym = len({k[0] for k in a})
    assert len(b) == len(a) - n_sym
    assert all(b[(s, n)] == a[(s, n + 1)] for (s, n) in b)
