"""M4: what the fits of a forest read, and that long series' forests depend on their bars only."""

import numpy as np
import pytest

from conftest import SF_SMALL
from pricetrend.models import forest
from pricetrend.plans import catalog

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def prep(spark):
    x = np.random.default_rng(3).normal(size=(2, 240, 3))
    rows = [(s, i, int(x[k, i, 0] + x[k, i, 1] > 0), i % 5 > 0, i % 5 == 0, *map(float, x[k, i])) for k, s in enumerate("pq") for i in range(240)]
    return spark.createDataFrame(rows, "symbol string, bar_no long, movement int, is_train boolean, is_test boolean, a double, b double, c double")


def test_a_long_series_does_not_depend_on_the_layout(prep, monkeypatch):
    monkeypatch.setattr(forest, "LONG_SERIES", 1)
    run = lambda df: {(r.symbol, r.ntrees): r.accuracy for r in forest.rf_sweep(df, COLS, [2, 4, 6], max_depth=4).collect()}
    got = run(prep.repartition(7))
    assert len(got) == 6 and got == run(prep.repartition(3)) and got == run(prep.where("symbol = 'p'").coalesce(1)) | {k: v for k, v in got.items() if k[0] == "q"}


def test_a_long_series_has_the_partitions_that_its_rows_need(prep, monkeypatch):
    many = prep.repartition(9)
    assert forest._of_series(many, COLS, "p", forest.LONG_SERIES).rdd.getNumPartitions() == 1
    monkeypatch.setattr(forest, "PER_PARTITION", forest.LONG_SERIES // 2)
    two = forest._of_series(many, COLS, "p", forest.LONG_SERIES)
    assert two.rdd.getNumPartitions() == 2 and two.count() == 240
    assert forest._of_series(many, COLS, "p", 10 ** 9).rdd.getNumPartitions() <= prep.sparkSession.sparkContext.defaultParallelism


def test_trees_keep_the_nodes_of_rows_and_stay_the_same(prep):
    x = forest._labelled(prep.where("symbol = 'p'").coalesce(1), COLS)
    kept = forest._forest(3, 6, 1)
    assert kept.getCacheNodeIds()
    assert kept.fit(x).toDebugString.split("\n")[1:] == kept.copy().setCacheNodeIds(False).fit(x).toDebugString.split("\n")[1:]


def test_repeated_bars_count_each(spark, prep):
    """Two test rows of one bar are two rows, and no series is no result."""
    twice = prep.unionByName(prep.where("is_test"))
    once, both = ({(r.symbol, r.ntrees): r.accuracy for r in forest.rf_sweep(df.coalesce(1), COLS, [2, 4], max_depth=3).collect()} for df in (prep, twice))
    assert once == both
    assert forest.rf_sweep(prep.limit(0), COLS, [2, 4]).count() == 0


def test_families_share_one_panel(spark):
    first, again = (catalog._kept_panel(spark, SF_SMALL).inputFiles() for _ in range(2))
    assert sorted(first) == sorted(again)
