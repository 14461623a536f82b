"""M5, G1: forests of stumps against a plain version."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricetrend.models import stumps
from pricetrend.plans import experiments as X
from pricetrend.plans.panels import fixture_trends
from pricetrend.session import cut_lineage


def md5(*parts):
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


def weight(symbol, bar, tree, seed=42):
    u = int(md5(symbol, bar, tree // 8, seed)[4 * (tree % 8):4 * (tree % 8) + 4], 16)
    return sum(u >= t for t in stumps.poisson_thresholds())


def plain_tree(rows, names, symbol, tree, seed=42):
    """(feature, cut, low vote, high vote) of the best stump on weighted rows (weight, y, signals)."""
    vote = lambda part: math.floor(sum(w * y for w, y, _ in part) / sum(w for w, _, _ in part) * 10 ** 9 + 0.5) if part else 0
    able = []
    for i, name in enumerate(names):
        cuts = []
        for j, cut in enumerate(stumps.CUTS):
            low, high = [r for r in rows if r[2][i] <= cut], [r for r in rows if r[2][i] > cut]
            if low and high:
                score = sum((sum(w * y for w, y, _ in p) ** 2 + sum(w * (1 - y) for w, y, _ in p) ** 2) / sum(w for w, _, _ in p) for p in (low, high))
                cuts.append((score, -i, -j, vote(low), vote(high)))
        if cuts:
            able.append((md5(symbol, tree, name, seed), cuts))
    looked = [c for _, cuts in sorted(able)[:math.isqrt(len(names))] for c in cuts]
    if not looked:
        return 0, stumps.CUTS[0], vote(rows), vote(rows)
    _, i, j, a, b = max(looked)
    return -i, stumps.CUTS[-j], a, b


@pytest.fixture(scope="module")
def prep(spark):
    rng = np.random.default_rng(4)
    rows = []
    for s, n in (("a", 60), ("b", 25), ("tiny", 3)):
        for i in range(n):
            x = rng.integers(-1, 2, 4)
            rows.append((s, i, int(x[1] + x[2] + rng.normal() > 0), i % 4 != 3, i % 3, float(x[0]), float(x[1]), float(x[2]), 1.0))
    return spark.createDataFrame(rows, "symbol string, bar_no long, movement int, is_train boolean, fold int, w double, x double, y double, const double")


NAMES = ["w", "x", "y", "const"]


def test_thresholds_are_the_poisson_distribution():
    t = stumps.poisson_thresholds()
    assert t[:3] == [24110, 48219, 60274] and sorted(set(t)) == t and t[-1] <= 65535
    u = np.arange(65536)
    w = sum((u >= x).astype(int) for x in t)
    assert abs(w.mean() - 1) < 1e-3 and abs(w.var() - 1) < 1e-2


def test_trees_equal_the_plain_ones(spark, prep):
    got = {(r.symbol, r.fold, r.tree): (r.feature, r.cut, r.low, r.high) for r in stumps.stumps_fit(prep.repartition(3), NAMES, 16).collect()}
    data = defaultdict(list)
    for r in prep.where("is_train").collect():
        data[r.symbol].append(r)
    for (symbol, fold, tree), have in got.items():
        rows = [(weight(symbol, r.bar_no, tree), r.movement, [r[c] for c in NAMES]) for r in data[symbol] if r.fold != fold]
        assert have == plain_tree([r for r in rows if r[0]], NAMES, symbol, tree), (symbol, fold, tree)
    assert {k[0] for k in got} == {"a", "b", "tiny"} and {k[1] for k in got if k[0] == "a"} == {-1, 0, 1, 2}


def test_accuracy_is_the_mean_over_folds(spark, prep):
    counts = [8, 16]
    got = {(r.symbol, r.ntrees): r.cv_accuracy for r in stumps.stumps_cv(prep.where("symbol <> 'tiny'"), NAMES, counts).collect()}
    trees = {(r.symbol, r.fold, r.tree): r for r in stumps.stumps_fit(prep, NAMES, 16).collect()}
    for symbol in ("a", "b"):
        for k in counts:
            folds = defaultdict(list)
            for r in prep.where(f"is_train AND symbol = '{symbol}'").collect():
                votes = [trees[symbol, r.fold, t] for t in range(k)]
                total = sum(t.low if r[NAMES[t.feature]] <= t.cut else t.high for t in votes)
                folds[r.fold].append(int(2 * total > k * 10 ** 9) == r.movement)
            assert got[symbol, k] == pytest.approx(np.mean([np.mean(v) for v in folds.values()]), abs=1e-9)


def test_stumps_of_the_trend_signals_beat_the_majority(spark):
    panel = cut_lineage(fixture_trends(spark, SF_SMALL, "events_hour"), "panel")
    x, cols = X.prepared(panel, "rf_cv", "trend")
    got = stumps.stumps_cv(x, cols, [10, 50]).collect()
    rows = x.where("is_train").groupBy("symbol").agg(F.avg("movement").alias("p")).collect()
    base = {r.symbol: max(r.p, 1 - r.p) for r in rows}
    assert len(got) == 2 * len(base) and np.mean([r.cv_accuracy for r in got]) > np.mean(list(base.values())) + 0.05


def test_empty_and_null_symbols(spark, prep):
    assert stumps.stumps_cv(prep.limit(0), NAMES, [8]).count() == 0
    nameless = prep.where("symbol = 'a'").withColumn("symbol", F.lit(None).cast("string"))
    assert stumps.stumps_cv(nameless, NAMES, [8]).first().cv_accuracy > 0.5
