import math

import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.sql import functions as F

from conftest import SF_MAIN, SF_SMALL
from pricetrend.models import forest, mlp, svm
from pricetrend.models.common import assemble
from pricetrend.models.gnb import gnb_predict, gnb_stats
from pricetrend.operators.evaluate import accuracy_by
from pricetrend.plans import experiments as X
from pricetrend.plans.panels import fixture_trends
from pricetrend.plans.prepare import prepare
from pricetrend.session import cut_lineage


@pytest.fixture(scope="module")
def panel(spark):
    return cut_lineage(fixture_trends(spark, SF_SMALL, "events_hour"), "panel")


def majority(prep):
    """Test accuracy of always saying the more frequent class of the training rows."""
    rows = prep.groupBy("symbol").agg(F.avg(F.when(F.col("is_train"), F.col("movement"))).alias("p"),
                                      F.avg(F.when(F.col("is_test"), F.col("movement"))).alias("q")).collect()
    return {r.symbol: r.q if r.p > 0.5 else 1 - r.q for r in rows}


def test_sql_gnb_equals_spark_naive_bayes(spark):
    x, cols = prepare(fixture_trends(spark, SF_MAIN, "events_hour"), "nb", "continuous")
    x = cut_lineage(x)
    ours = gnb_predict(x.where("is_test"), gnb_stats(x.where("is_train"), cols), cols)
    ours = {(r.symbol, r.bar_no): r.prediction for r in ours.select("symbol", "bar_no", "prediction").collect()}
    v = assemble(x, cols).withColumn("label", F.col("movement").cast("double"))
    disagree = 0
    for sym in sorted({k[0] for k in ours}):
        s = v.where(F.col("symbol") == sym)
        m = NaiveBayes(modelType="gaussian").fit(s.where("is_train"))
        for r in m.transform(s.where("is_test")).select("bar_no", "prediction").collect():
            disagree += int(ours[(sym, r.bar_no)] != int(r.prediction))
    assert disagree == 0


def test_gnb_of_constant_features_takes_the_larger_prior(spark):
    rows = [("flat", i, 1.0, int(i % 3 > 0)) for i in range(30)] + [("ok", i, float(i % 2), i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, "symbol string, bar_no long, x double, movement int")
    got = gnb_predict(df, gnb_stats(df, ["x"]), ["x"])
    assert {r.prediction for r in got.where("symbol = 'flat'").collect()} == {1}
    acc = {r.symbol: (r.accuracy, r.n) for r in accuracy_by(got, ["symbol"]).collect()}
    assert acc == {"flat": (20 / 30, 30), "ok": (1.0, 30)}
    lost = got.withColumn("prediction", F.lit(None).cast("int"))
    assert {r.accuracy for r in accuracy_by(lost, ["symbol"]).collect()} == {0.0}


def _fixed_results(spark):
    rows = []
    def add(sym, rep, model, params, gi, metric, value):
        rows.append((sym, rep, model, params, gi, metric, value))
    for sym, poly, rbf in [("a", [.7, .8, .8], [.6, .9]), ("b", [.5, .6, .4], [.7, .7])]:
        for i, v in enumerate(poly):
            add(sym, "continuous", "svm", {"kernel": "poly"}, i, "cv_accuracy", v)
        for i, v in enumerate(rbf):
            add(sym, "continuous", "svm", {"kernel": "rbf"}, 10 + i, "cv_accuracy", v)
        for i, (n, v) in enumerate([(10, .8), (20, .9), (30, .9), (40, .7), (50, .8)]):
            add(sym, "continuous", "rf", {"ntrees": str(n)}, i, "test_accuracy", v)
        add(sym, "continuous", "nb", {}, 0, "test_accuracy", .6 if sym == "a" else .8)
        for i, v in enumerate([.5, .75, .7]):
            add(sym, "continuous", "mlp", {}, i, "test_accuracy", v)
    return spark.createDataFrame(rows, "symbol string, representation string, model string, "
                                       "params map<string,string>, grid_index int, metric string, value double")


def test_rollups_follow_the_study_arithmetic(spark):
    res = _fixed_results(spark)
    per = {(r.symbol, r.model): r.accuracy for r in X.per_series(res).collect()}
    assert abs(per[("a", "svm")] - (0.8 + 0.9) / 2) < 1e-12      # best poly, best rbf, averaged
    assert abs(per[("b", "svm")] - (0.6 + 0.7) / 2) < 1e-12
    assert abs(per[("a", "rf")] - (0.9 + 0.9 + 0.8) / 3) < 1e-12  # mean of the top three
    assert abs(per[("a", "mlp")] - 0.75) < 1e-12                  # per-series max
    over = {r.model: r.accuracy for r in X.overall(res).collect()}
    assert abs(over["nb"] - 0.7) < 1e-12
    top = X.rf_top3(res).where("symbol = 'a'").orderBy("rank").collect()
    assert [r.params["ntrees"] for r in top] == ["30", "20", "50"]


def test_report_names_the_chosen_parameters(spark):
    per = {(r.symbol, r.model): r.best_params for r in X.per_series(_fixed_results(spark)).collect()}
    assert per[("a", "rf")] == "ntrees=30; ntrees=20; ntrees=50"
    assert per[("a", "svm")] == "kernel=poly; kernel=rbf"


def test_the_full_grids_are_the_default():
    g = X.REFERENCE_GRIDS
    assert (len(g.svm), g.rf_counts, len(g.mlp)) == (64, list(range(10, 201, 10)), 48)


# ------------------------------------------------------------------ SVM
def test_poly_map_equals_the_homogeneous_kernel():
    x = np.random.default_rng(0).normal(size=(20, 5))
    for d in svm.POLY_DEGREES:
        phi = svm.FeatureMap(5, ("poly", d), svm.SvmParams())(x)[:, :-1]
        assert np.allclose(phi @ phi.T, (x @ x.T / 5) ** d)


def test_fourier_map_approximates_the_rbf_kernel():
    x = np.random.default_rng(0).normal(size=(30, 4))
    phi = svm.FeatureMap(4, ("rbf", 0.5), svm.SvmParams(n_components=20000))(x)[:, :-1]
    want = np.exp(-0.5 * ((x[:, None] - x[None]) ** 2).sum(2))
    assert np.abs(phi @ phi.T - want).max() < 0.05


def test_a_tensor_sketch_approximates_the_polynomial_kernel():
    x = np.random.default_rng(0).normal(size=(40, 30))
    exact = (x @ x.T / 30) ** 4
    errors = {}
    for width in (256, 2048, 16384):
        m = svm.FeatureMap(30, ("poly", 4), svm.SvmParams(sketch_width=width))
        phi = m(x)[:, :-1]
        errors[width] = np.linalg.norm(phi @ phi.T - exact) / np.linalg.norm(exact)
        assert m.components == width == phi.shape[1] and np.allclose(m.misses(x), [((phi @ phi.T - exact) ** 2).sum(), (exact ** 2).sum()])
    assert errors[2048] < 0.25 and errors[16384] < errors[2048] < errors[256]
    assert svm.FeatureMap(30, ("poly", 3), svm.SvmParams()).components is None     # 4,960 monomials: exact


def test_the_superset_has_all_its_points(spark, panel):
    x, cols = X.prepared(panel, "svm", "trend", "trend_superset")
    grid = [p for p in svm.poly_grid() + svm.rbf_grid() if p["C"] == 1]
    got = svm.svm_cv(x, cols, grid, params=svm.SvmParams(max_passes=40)).collect()
    assert len(cols) == 30 and len(got) == 5 * 15
    assert all((r.kernel_error is None) == (r.n_components is None) == (r.kernel == "poly" and r.degree < 4) for r in got)
    base = np.mean(list(majority(x).values()))
    assert np.mean([r.test_accuracy for r in got if r.degree == 4]) > base + 0.05
    assert all(0 < r.kernel_error < 0.3 for r in got if r.degree == 4)


def _one_svm(prep, cols, grid, **kw):
    return {(r.symbol, r.grid_index): (r.cv_accuracy, r.test_accuracy, r.converged, r.passes)
            for r in svm.svm_cv(prep, cols, grid, params=svm.SvmParams(**kw)).collect()}


def test_svm_of_a_series_does_not_depend_on_the_others(spark, panel):
    x, cols = X.prepared(panel, "svm", "continuous")
    grid = svm.poly_grid([1, 2], [1, 10]) + svm.rbf_grid([0.5], [1])
    together = _one_svm(x, cols, grid)
    alone = _one_svm(x.where("symbol = 'view'"), cols, grid)
    assert alone == {k: v for k, v in together.items() if k[0] == "view"}


def test_svm_of_wide_series_gives_the_same(spark, panel):
    """Series of several shards, one of them left whole: state table and partial sums against one task."""
    x, cols = X.prepared(panel, "svm", "trend")
    grid = svm.poly_grid([1, 2], [1]) + svm.rbf_grid([0.5], [1])
    whole = _one_svm(x, cols, grid, max_passes=25)
    wide = _one_svm(x, cols, grid, max_passes=25, per_shard=60, mapped_bytes=0)
    assert set(whole) == set(wide)
    for k in whole:
        assert wide[k][2:] == whole[k][2:] and wide[k][:2] == pytest.approx(whole[k][:2], abs=0.02)


def test_closed_series_are_not_read_again(spark, panel):
    from pricetrend.models.shards import BUCKETS, by_bucket, deal, of_open
    x, cols = X.prepared(panel, "svm", "trend")
    table = by_bucket(deal(x.select("symbol", "bar_no", "movement"), 60))
    live = table.where("symbol = 'view'").select("symbol").limit(1)
    seen = of_open(table, live)
    assert {r.symbol for r in seen.select("symbol").distinct().collect()} == {"view"}
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0] and BUCKETS == 256


def test_svm_state_survives_packing():
    q = svm.Problems(3, 4, svm.SvmParams(memory=2))
    rng = np.random.default_rng(0)
    for _ in range(4):
        q.learn(rng.random(3), rng.normal(size=(3, 4)))
    back = svm.Problems.unpack(3, 4, svm.SvmParams(memory=2), q.pack())
    for name in svm.Problems.FIELDS:
        assert np.array_equal(getattr(back, name), getattr(q, name)) and getattr(back, name).dtype == getattr(q, name).dtype


def test_svm_converges_and_beats_the_majority(spark, panel):
    x, cols = X.prepared(panel, "svm", "trend")
    got = _one_svm(x, cols, svm.poly_grid([1], [1]))
    base = majority(x)
    assert all(v[2] for v in got.values()) and np.mean([v[1] for v in got.values()]) > np.mean(list(base.values())) + 0.1
    assert _one_svm(x, cols, svm.poly_grid([1], [1]), max_passes=2).popitem()[1][2] is False


def test_svm_solution_is_the_minimum(spark):
    """One linear problem against a long plain descent on the same objective."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    y = (x @ [1.0, -2.0, 0.5] + 0.3 * rng.normal(size=300) + 0.2 > 0).astype(int)
    p = svm.SvmParams(tolerance=1e-7, gain=0.0, max_passes=400)
    q = svm.Problems(1, 4, p)
    phi, sign, c = np.c_[x, np.ones(300)], np.where(y == 1, 1.0, -1.0), 2.0

    def value(w):
        z = 1 - sign * (phi @ w)
        loss = np.where(z <= 0, 0, np.where(z < p.smooth, z * z / (2 * p.smooth), z - p.smooth / 2))
        ridge = np.r_[w[:3], 0.0]
        return loss.mean() + ridge @ ridge / (2 * c * 300), -(np.clip(z / p.smooth, 0, 1) * sign) @ phi / 300 + ridge / (c * 300)

    while q.active.any() and q.passes.max() < p.max_passes:
        f, g = value(q.point()[0])
        q.learn(np.array([f]), g[None])
    assert q.converged.all() and np.abs(value(q.w[0])[1]).max() <= 1e-7


# ------------------------------------------------------------------ forests
def test_forests_beat_the_majority_and_repeat(spark, panel):
    x, cols = X.prepared(panel, "rf", "continuous")
    run = lambda: {(r.symbol, r.ntrees): r.accuracy for r in forest.rf_sweep(x, cols, [10, 20], max_depth=5).collect()}
    first = run()
    base = majority(x)
    assert first == run() and len(first) == 2 * len(base)
    assert np.mean([v for (_, n), v in first.items() if n == 20]) > np.mean(list(base.values())) + 0.05
