"""F4 and F7 inside the model plans: the balanced protocol."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricetrend.models import mlp, svm
from pricetrend.operators.features import impute_and_minmax, impute_mean, minmax_scale
from pricetrend.plans import experiments as X
from pricetrend.plans.panels import fixture_trends
from pricetrend.plans.prepare import PROTOCOLS, prepare
from pricetrend.session import cut_lineage

CFG = X.GridConfig(svm=svm.poly_grid([1], [1]) + svm.rbf_grid([0.5], [1]), rf_counts=[10, 20, 30],
                   mlp=mlp.mlp_grid(mlp.MLP_GRID | {"n_neurons": [10], "epochs": [10], "momentum": [0.2]}), protocol="balanced")


@pytest.fixture(scope="module")
def panel(spark):
    return cut_lineage(fixture_trends(spark, SF_SMALL, "events_hour").where("symbol IN ('click', 'view')"), "panel")


def test_one_pass_equals_imputing_then_scaling(spark):
    rows = [("a", 1, 1.0, 5.0, None), ("a", 2, None, 5.0, None), ("a", 3, 4.0, None, None),
            (None, 1, 2.0, 1.0, 1.0), (None, 2, 3.0, 2.0, None), ("c", 1, None, 0.0, -1.0)]
    df = spark.createDataFrame(rows, "symbol string, bar_no long, x double, y double, z double")
    cols = ["x", "y", "z"]
    key = lambda r: (str(r["symbol"]), r["bar_no"])
    one = sorted(impute_and_minmax(df, cols).collect(), key=key)
    two = sorted(minmax_scale(impute_mean(df, cols), cols).collect(), key=key)
    assert np.allclose([[r[c] for c in cols] for r in one], [[r[c] for c in cols] for r in two])
    assert impute_and_minmax(df.limit(0), cols).count() == 0


@pytest.mark.parametrize("family", ["svm", "rf_cv", "nb"])
def test_sets_are_balanced(panel, family):
    x, cols = prepare(panel, family, "continuous", protocol="balanced")
    p = x.toPandas()
    assert (p.is_train ^ p.is_test).all()
    for _, g in p.groupby("symbol"):
        for part in (g[g.is_train], g[g.is_test]):
            assert (part.movement == 1).sum() == (part.movement == 0).sum()
        assert g.is_train.sum() == 2 * np.ceil(0.2 * len(g) / 2)
        assert g[cols].min().min() >= -1 - 1e-12 and g[cols].max().max() <= 1 + 1e-12
        if PROTOCOLS["balanced"][family].folds:
            assert set(g[g.is_train].fold) == {0, 1, 2, 3, 4} and set(g[g.is_test].fold) == {-1}
    counts = panel.groupBy("symbol").pivot("movement", [0, 1]).count().toPandas()
    assert len(p) == 2 * counts[["0", "1"]].min(axis=1).sum()


def test_a_series_of_one_class_has_no_rows(panel):
    one = panel.withColumn("movement", F.when(F.col("symbol") == "click", F.lit(1)).otherwise(F.col("movement")))
    x, _ = prepare(one, "nb", "continuous", protocol="balanced")
    assert [r.symbol for r in x.select("symbol").distinct().collect()] == ["view"]


def test_every_family_and_its_stored_models(panel):
    """Accuracies taken from the stored models' predictions on the evaluation set equal the report."""
    for family, rep in (("svm", "continuous"), ("nb", "continuous"), ("rf_cv", "trend"), ("mlp", "trend")):
        fit = X.fitted(panel, family, rep, CFG)
        said = X.test_predictions(panel, fit.store, family, rep, "balanced").toPandas()
        sizes = prepare(panel, family, rep, protocol="balanced")[0].where("is_test").groupBy("symbol").count().toPandas()
        acc = said.assign(ok=said.prediction == said.movement).groupby(["symbol", "member"]).ok.agg(["mean", "size"]).reset_index()
        assert (acc.merge(sizes, on="symbol").eval("size == count")).all()
        res = fit.results.where("metric = 'test_accuracy'").toPandas()
        for r in acc.itertuples():
            same = res[(res.symbol == r.symbol)]
            if family != "rf_cv":  # the stumps are chosen and reported by their folds only
                assert np.isclose(same.value, r.mean).any(), (family, r)
            if family != "mlp":  # ten epochs of some forty bars are no training
                assert r.mean > 0.5, (family, r)
