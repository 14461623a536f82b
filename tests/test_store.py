"""Kept models and predictions from them."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricetrend.models import forest, mlp, store, svm
from pricetrend.plans import experiments as X
from pricetrend.plans.panels import fixture_trends
from pricetrend.session import cut_lineage, scratch_path

CFG = X.GridConfig(svm=[p for p in svm.poly_grid([1, 2], [1, 5]) + svm.rbf_grid([0.5], [1])], rf_counts=[10, 20, 30],
                   mlp=mlp.mlp_grid(mlp.MLP_GRID | {"n_neurons": [10], "epochs": [10, 20], "momentum": [0.2]}))


@pytest.fixture(scope="module")
def panel(spark):
    # two series keep the forests' fits short
    return cut_lineage(fixture_trends(spark, SF_SMALL, "events_hour").where("symbol IN ('click', 'view')"), "panel")


@pytest.fixture(scope="module")
def fits(panel):
    return {(f, rep): X.fitted(panel, f, rep, CFG) for rep in ("continuous", "trend") for f in X.families(rep)}


def test_predictions_from_the_store_give_the_reported_accuracies(spark, panel, fits):
    """Written, read again and applied to raw bars; the accuracy is taken in DuckDB."""
    path = scratch_path(spark, "store")
    whole = None
    for fit in fits.values():
        whole = fit.store if whole is None else whole.unionByName(fit.store)
    whole.write.parquet(path)
    rows = spark.read.parquet(path)
    assert [f.simpleString() for f in rows.schema] == [f.strip().replace(" ", ":", 1) for f in store.STORE.split(", ")]
    said = None
    for family, rep in fits:
        part = X.test_predictions(panel, rows, family, rep)
        said = part if said is None else said.unionByName(part)
    said = said.toPandas()
    acc = {r[:4]: r[4] for r in duckdb.sql("SELECT symbol, representation, model, member, avg(CAST(prediction = movement AS DOUBLE)) FROM said GROUP BY ALL").fetchall()}
    results = None
    for fit in fits.values():
        results = fit.results if results is None else results.unionByName(fit.results)
    report = {(r.symbol, r.representation, r.model): r.accuracy for r in X.per_series(results).collect()}
    symbols = {k[0] for k in report}
    for s in symbols:
        for rep in ("continuous", "trend"):
            for family in ("nb", "mlp"):
                assert acc[s, rep, family, ""] == pytest.approx(report[s, rep, family], abs=1e-12)
        assert np.mean([acc[s, "continuous", "rf", str(i)] for i in (1, 2, 3)]) == pytest.approx(report[s, "continuous", "rf"], abs=1e-12)
    # The report has an SVM's CV score; its test accuracy is among the results.
    tests = {(r.symbol, r.representation, r.grid_index): r.value for r in results.where("model = 'svm' AND metric = 'test_accuracy'").collect()}
    for r in rows.where("model = 'svm'").collect():
        assert acc[r.symbol, r.representation, "svm", r.member] == pytest.approx(tests[r.symbol, r.representation, r.grid_index], abs=1e-12)
    assert len(acc) == len(symbols) * (2 * 2 + 2 + 2 + 3 + 1) == rows.count()
    n = {k: len(v) for k, v in said.groupby(["symbol", "representation", "model", "member"])}
    of = {(s, f): panel.where(F.col("symbol") == s).count() for s in symbols for f in ("nb",)}
    assert all(n[s, "trend", "nb", ""] == int(np.ceil(0.2 * of[s, "nb"])) for s in symbols)


def test_the_best_points_are_kept(fits):
    for rep in ("continuous", "trend"):
        best = {(r.symbol, r.kernel): (r.grid_index, r.value) for r in X.best_points(fits["svm", rep].results).collect()}
        kept = {(r.symbol, r.member): (r.grid_index, r.score) for r in fits["svm", rep].store.collect()}
        assert kept == best


def test_stumps_from_the_store_vote_as_fitted(spark, panel, fits):
    from pricetrend.models import stumps
    x, cols = X.prepared(panel, "rf_cv", "trend")
    kept = {r.symbol: int(r.params["ntrees"]) for r in fits["rf_cv", "trend"].store.collect()}
    trees = stumps.stumps_fit(x, cols, 30)
    voted = stumps.with_votes(x.where("is_test"), trees, cols, F.lit(stumps.ALL))
    want = {(r.symbol, r.bar_no): int(2 * sum(r.votes[:kept[r.symbol]]) > kept[r.symbol] * stumps.UNIT) for r in voted.collect()}
    got = {(r.symbol, r.bar_no): r.prediction for r in X.test_predictions(panel, fits["rf_cv", "trend"].store, "rf_cv", "trend").collect()}
    assert got == want


def test_saved_trees_are_the_fitted_ones(spark, panel):
    """Shares of class 1 by the stored nodes against Spark's own model."""
    from pyspark.ml.functions import vector_to_array
    from pricetrend.models.common import assemble
    x, cols = X.prepared(panel, "rf", "continuous")
    one = x.where("symbol = 'view'")
    keep = scratch_path(spark, "forest")
    forest.rf_sweep(one, cols, [10, 20], keep=keep).collect()
    trees = {r.tree: r.nodes for r in forest.saved_trees(spark, keep).collect()}
    assert sorted(trees) == list(range(20))
    data = assemble(one, cols).withColumn("label", F.col("movement").cast("double"))
    model = forest._forest(10, forest.MAX_DEPTH_UNLIMITED, 43).fit(data.where("is_train"))
    rows = model.transform(data.where("is_test")).select(*cols, vector_to_array("rawPrediction")[1].alias("raw")).collect()
    flat = []
    for t in range(10, 20):
        flat.append(len(trees[t]))
        for n in trees[t]:
            flat += [n.feature, n.threshold, n.left, n.right, n.p]
    got = store.forest_share(np.array([[r[c] for c in cols] for r in rows]), np.array(flat, float)) * 10
    assert np.allclose(got, [r.raw for r in rows])


def test_odd_bars(spark, fits):
    rows = fits["nb", "continuous"].store
    features = rows.first().features
    schema = "symbol string, bar_no long, " + ", ".join(f"{c} double" for c in features) + ", model string"
    bars = [("view", 1, *[None] * len(features), "x"), ("unknown", 1, *[1.0] * len(features), "x"), (None, 2, *[1.0] * len(features), "x")]
    df = spark.createDataFrame(bars, schema)
    got = store.predict(df.drop("model"), rows).collect()
    assert [(r.symbol, r.bar_no) for r in got] == [("view", 1)] and got[0].prediction in (0, 1)
    assert store.predict(df.drop("model").limit(0), rows).count() == 0 and store.predict(df.drop("model"), rows.limit(0)).count() == 0
