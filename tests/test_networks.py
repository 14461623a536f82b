"""Networks trained in mini-batches."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MAIN, SF_SMALL
from pricetrend.models import mlp
from pricetrend.models.mlp import MlpParams, Networks, Training
from pricetrend.plans import experiments as X
from pricetrend.plans.panels import fixture_trends
from pricetrend.session import cut_lineage
from test_models import majority

GRID = mlp.MLP_GRID | {"n_neurons": [10, 20], "epochs": [10, 30], "momentum": [0.2]}


@pytest.fixture(scope="module")
def panel(spark):
    return cut_lineage(fixture_trends(spark, SF_SMALL, "events_hour"), "panel")


@pytest.fixture(scope="module")
def trend(panel):
    return X.prepared(panel, "mlp", "trend")


def _scores(prep, cols, grid, **kw):
    return {(r.symbol, r.grid_index): r for r in mlp.mlp_scores(prep, cols, grid, MlpParams(**kw)).collect()}


def test_networks_of_forty_epochs_beat_the_majority(spark):
    grid = mlp.mlp_grid(mlp.MLP_GRID | {"epochs": [40]})     # every setting, at the study's rate
    main = cut_lineage(fixture_trends(spark, SF_MAIN, "events_hour"), "panel")
    for rep in ("continuous", "trend"):
        x, cols = X.prepared(main, "mlp", rep)
        base = np.mean(list(majority(x).values()))
        got = _scores(x, cols, grid)
        for i in range(len(grid)):
            mean = np.mean([r.accuracy for (_, g), r in got.items() if g == i])
            assert mean > base + 0.05, (rep, grid[i], mean, base)


def test_a_seed_fixes_the_networks_whatever_else_is_in_the_grid(spark, trend):
    x, cols = trend
    grid = mlp.mlp_grid(GRID)
    first = _scores(x, cols, grid)
    assert first == _scores(x.repartition(3), cols, grid)
    alone = _scores(x.where("symbol = 'view'"), cols, [grid[3]])
    assert alone["view", 0].accuracy == first["view", 3].accuracy and alone["view", 0].train_loss == pytest.approx(first["view", 3].train_loss)
    other = _scores(x, cols, grid, seed=7)
    assert {k: r.train_loss for k, r in other.items()} != {k: r.train_loss for k, r in first.items()}
    means = [np.mean([r.accuracy for r in s.values()]) for s in (first, other)]
    assert abs(means[0] - means[1]) < 0.1


def test_a_shorter_run_is_the_start_of_a_longer_one():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(80, 3)), rng.integers(0, 2, 80).astype(float)
    nets = Networks(mlp.mlp_grid(GRID), 3, MlpParams(patience=100))
    t = Training(nets, nets.start("a"))
    for e in range(1, 31):
        t.learn(e, nets.epoch(t.w, t.v, t.open > 0, x, y, "a", e, 0) / 80)
        if e == 10:
            at_ten = t.seen[0].copy()
    assert (t.seen[0] == at_ten).all() and t.seen[1][:, nets.k].tolist() == [30, 30] and not t.open.any()


def test_units_that_fill_up_stay_out():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(70, 4)), rng.integers(0, 2, 70).astype(float)
    both = Networks(mlp.mlp_grid(GRID), 4, MlpParams())
    one = Networks([p for p in mlp.mlp_grid(GRID) if p["n_neurons"] == 10], 4, MlpParams())
    a, b = Training(both, both.start("s")), Training(one, one.start("s"))
    for e in (1, 2, 3):
        a.learn(e, both.epoch(a.w, a.v, a.open > 0, x, y, "s", e, 0) / 70)
        b.learn(e, one.epoch(b.w, b.v, b.open > 0, x, y, "s", e, 0) / 70)
    assert np.allclose(mlp.unpack(a.w, 4, 20)[0][0, :, :10], mlp.unpack(b.w, 4, 10)[0][0])
    assert (mlp.unpack(a.w, 4, 20)[0][0, :, 10:] == 0).all() and a.best_loss[0] == pytest.approx(b.best_loss[0])


def test_steps_follow_the_gradient_of_the_cross_entropy():
    """Without dropout and momentum one step on one batch is the numerical gradient times the rate."""
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(32, 3)), rng.integers(0, 2, 32).astype(float)
    nets = Networks([{"n_neurons": 5, "epochs": 1, "lr": 0.1, "momentum": 0.0, "dropout_rate": 0.0}], 3, MlpParams())
    w = nets.start("s")
    w += 0.1 * rng.normal(size=w.shape)

    def loss(w):
        p = mlp.probability(x, w, 5)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    want = np.array([(loss(w[0] + d) - loss(w[0] - d)) / 2e-6 for d in 1e-6 * np.eye(nets.k)])
    after = w.copy()
    got = nets.epoch(after, np.zeros_like(w), np.array([True]), x, y, "s", 1, 0)
    assert np.allclose((w - after)[0] / 0.1, want, atol=1e-6) and got[0] / 32 == pytest.approx(loss(w[0]))


def test_a_rising_loss_stops_after_three_epochs_and_restores_the_best():
    nets = Networks(mlp.mlp_grid(mlp.MLP_GRID | {"n_neurons": [10, 20], "momentum": [0.1], "epochs": [5, 40]}), 2, MlpParams())
    t = Training(nets, nets.start("a"))
    losses = np.array([[1.0, 0.9, 0.5, 0.6, 0.5, 0.7, 0.1, 0.1], [1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3]])
    for e, loss in enumerate(losses.T, start=1):
        t.w += 1.0
        t.learn(e, loss)
        assert (t.open > 0).tolist() == [e < 6, True]
    m = {(r["n_neurons"], r["epochs"]): r for r in t.models("a", 1).to_pylist()}
    start = nets.start("a")
    # three epochs without a lower loss than the third's (an equal one is no gain)
    assert (m[10, 40]["epochs_used"], m[10, 40]["best_epoch"], m[10, 40]["train_loss"]) == (6, 3, 0.5)
    assert np.allclose(m[10, 40]["weights"][:20], start[0].reshape(-1)[:nets.d * nets.h].reshape(2, 20)[:, :10].ravel() + 3)
    assert (m[10, 5]["epochs_used"], m[10, 5]["best_epoch"]) == (5, 3)
    assert (m[20, 5]["epochs_used"], m[20, 5]["best_epoch"], m[20, 40]["best_epoch"]) == (5, 5, 8)


def test_state_survives_packing():
    nets = Networks(mlp.mlp_grid(GRID), 2, MlpParams())
    t = Training(nets, nets.start("a"))
    t.learn(1, np.array([0.5, 0.4]))
    back = Training.unpack(nets, t.pack())
    for name in ("w", "v", "best_w", "seen", *Training.FIELDS):
        assert (getattr(back, name) == getattr(t, name)).all()


def test_wide_series_average_their_shards(spark, trend):
    x, cols = trend
    grid = mlp.mlp_grid(mlp.MLP_GRID | {"n_neurons": [20], "epochs": [4], "momentum": [0.1], "lr": [0.1]})
    got = _scores(x, cols, grid, per_shard=60)      # three or four shards a series
    base = majority(x)
    assert set(k for k, _ in got) == set(base) and all(r.epochs_used == 4 for r in got.values())
    assert np.mean([r.accuracy for r in got.values()]) > np.mean(list(base.values())) + 0.05
    assert got == _scores(x.repartition(2), cols, grid, per_shard=60)


def test_the_average_of_two_shards_by_hand(spark):
    rng = np.random.default_rng(5)
    rows = [("s", i, int(v[0] > 0), True, False, *map(float, v)) for i, v in enumerate(rng.normal(size=(50, 2)))]
    df = spark.createDataFrame(rows, "symbol string, bar_no long, movement int, is_train boolean, is_test boolean, a double, b double")
    grid, params = mlp.mlp_grid(mlp.MLP_GRID | {"n_neurons": [4], "epochs": [2], "momentum": [0.3]}), MlpParams(per_shard=30)
    from pricetrend.models.shards import deal
    dealt = deal(df, 30)
    got = mlp.mlp_fit(dealt, ["a", "b"], grid, params).first()
    where = {r.bar_no: r.shard for r in dealt.collect()}
    nets = Networks(grid, 2, params)
    t = Training(nets, nets.start("s"))
    for e in (1, 2):
        w = v = loss = 0
        for shard in (0, 1):
            mine = [r for r in rows if where[r[1]] == shard]
            x, y = np.array([r[5:] for r in mine]), np.array([r[2] for r in mine], float)
            a, b = t.w.copy(), t.v.copy()
            loss += nets.epoch(a, b, t.open > 0, x, y, "s", e, shard)
            w, v = w + len(mine) * a, v + len(mine) * b
        t.w, t.v = w / 50, v / 50
        t.learn(e, loss / 50)
    assert np.allclose(got.weights, t.models("s", 2).to_pylist()[0]["weights"]) and got.shards == 2


def test_top_three_are_three_points(spark, panel):
    res = X.mlp_results(panel, "trend", X.GridConfig(mlp=mlp.mlp_grid(GRID)))
    for symbol in {r.symbol for r in res.select("symbol").distinct().collect()}:
        top = X.mlp_top3(res).where(F.col("symbol") == symbol).collect()
        assert len({r.grid_index for r in top}) == len(top) == 3 and all(int(r.params["epochs_used"]) <= int(r.params["epochs"]) for r in top)


def test_odd_rows(spark):
    rows = [("s", i, i % 2, True, False, float(i % 2), None) for i in range(40)] + [("s", 40 + i, i % 2, False, True, float(i % 2), None) for i in range(10)]
    rows += [("only_test", 1, 1, False, True, 1.0, 1.0), (None, 1, 1, True, False, 1.0, 1.0), (None, 2, 1, False, True, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, bar_no long, movement int, is_train boolean, is_test boolean, a double, b double")
    grid = mlp.mlp_grid(mlp.MLP_GRID | {"n_neurons": [10], "epochs": [40], "momentum": [0.3], "lr": [0.1]})
    got = _scores(df, ["a", "b"], grid)
    assert {k for k, _ in got} == {"s", None} and got["s", 0].accuracy == 1.0 and got[None, 0].accuracy == 1.0
    assert mlp.mlp_scores(df.limit(0), ["a", "b"], grid).count() == 0
