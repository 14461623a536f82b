"""Scans in two levels against plain ones."""

import random

import pytest
from pyspark.sql import functions as F

from pricetrend.operators.scan import previous, sums_before


def series(spark, gaps):
    rng = random.Random(3)
    rows = []
    for s, n in (("a", 70), ("b", 1), (None, 33)):
        numbers = sorted(rng.sample(range(64 if n > 64 else 60), n)) if gaps and n <= 60 else list(range(min(n, 64)))
        rows += [(s, i, rng.randint(0, 9), float(rng.randint(0, 99))) for i in numbers]
    return rows, spark.createDataFrame(rows, "symbol string, blk long, n long, x double").repartition(5)


@pytest.mark.parametrize("gaps", [False, True])
def test_sums_before(spark, gaps):
    rows, df = series(spark, gaps)
    got = {(r.symbol, r.blk): (r.before, r.past) for r in sums_before(df, "symbol", "blk", {"n": "before", "x": "past"}, group=8).collect()}
    assert got == {(s, i): (sum(r[2] for r in rows if r[0] == s and r[1] < i), sum(r[3] for r in rows if r[0] == s and r[1] < i)) for s, i, _, _ in rows}


def test_previous_crosses_the_groups(spark):
    rows, df = series(spark, False)
    of = {(s, i): x for s, i, _, x in rows}
    got = {(r.symbol, r.blk): r.was for r in previous(df, "symbol", "blk", {"x": "was"}, group=8).collect()}
    assert got == {(s, i): of.get((s, i - 1)) for s, i in of}


def test_numbers_beyond_two_levels_fail(spark):
    df = spark.createDataFrame([("a", 64, 1)], "symbol string, blk long, n long")
    with pytest.raises(Exception, match="two levels"):
        sums_before(df, "symbol", "blk", {"n": "b"}, group=8).collect()
    assert sums_before(df.limit(0), "symbol", "blk", {"n": "b"}, group=8).count() == 0
    assert previous(df.withColumn("blk", F.lit(63)), "symbol", "blk", {"n": "b"}, group=8).first().b is None
