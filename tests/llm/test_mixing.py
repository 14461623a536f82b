import math
import random

import pytest
from pyspark.sql import functions as F

from pricetrend.llm import mixing
from pricetrend.llm.common import words_in


def targets_by_hand(sizes):
    """Share by weight, cap, share the excess again until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed, open_ = sum(sizes.values()), {}, list(order)
    while True:
        rest, w = total - sum(fixed.values()), sum(weight[s] for s in open_)
        over = [s for s in open_ if rest * weight[s] / w > 3 * sizes[s]]
        if not over:
            return fixed | {s: rest * weight[s] / w for s in open_}
        for s in over:
            fixed[s] = 3 * sizes[s]
            open_.remove(s)


def rate_by_hand(sizes, target, most=3):
    """Bisection on the same dual."""
    mean = sum(sizes) / len(sizes)
    if target >= most * sum(sizes):
        return [float(most) if x else 1.0 for x in sizes]
    lo, hi = -500.0, 500.0
    for _ in range(300):
        lam = (lo + hi) / 2
        got = sum(x * min(most, math.exp(min(lam * x / mean, 2))) for x in sizes)
        lo, hi = (lam, hi) if got < target else (lo, lam)
    return [min(most, math.exp(min(lam * x / mean, 2))) for x in sizes]


@pytest.fixture(scope="module")
def sized(spark):
    random.seed(6)
    rows = []
    for s, n in (("a", 1500), ("b", 700), ("é", 300), ("Z", 30), (None, 400), ("tiny", 1), ("none", 3)):
        rows += [(len(rows) + i, s, 0 if s == "none" else int(random.lognormvariate(5, 1))) for i in range(n)]
    rows += [rows[0]] * 40  # repeated rows
    return spark.createDataFrame(rows, "doc_id long, source string, size long").cache()


def test_targets(sized):
    rows = sized.groupBy("source").agg(F.sum("size").alias("n")).collect()
    want = targets_by_hand({r["source"]: r["n"] for r in rows})
    got = {r["source"]: r["target"] for r in mixing.source_targets(sized).collect()}
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s], rel=1e-9)


def test_rates_and_copies(sized):
    plan = mixing.plan(sized, "doc_id").cache()
    by = {}
    for r in plan.collect():
        by.setdefault(r["source"], []).append(r)
    for s, rows in by.items():
        flat = [x for r in rows for x in [r["size"]] * r["rows"]]
        want = rate_by_hand(flat, rows[0]["target"]) if sum(flat) else [1.0] * len(flat)
        got = [x for r in rows for x in [r["rate"]] * r["rows"]]
        assert got == pytest.approx(want, rel=1e-3, abs=1e-6)
        taken = sum(r["copies"] * r["size"] for r in rows)
        assert abs(taken - rows[0]["target"]) <= 2 * max(flat) * max(1, len(flat) // 512 + 1) ** 0.5 + 1e-4 * rows[0]["target"]
        assert all(0 <= r["copies"] <= 3 * r["rows"] for r in rows)
    again = mixing.plan(sized.repartition(7), "doc_id")
    assert again.exceptAll(plan).count() == 0 and plan.exceptAll(again).count() == 0
    rows = mixing.per_row(plan)
    assert rows.count() == sized.count()
    assert rows.agg(F.sum("row_copies")).first()[0] == plan.agg(F.sum("copies")).first()[0]
    assert rows.agg(F.max("row_copies")).first()[0] <= 3


def test_mix_repeats_whole_rows(spark):
    rows = [(i, "word " * (i % 9 + 1), "s%d" % (i % 4), "k", i) for i in range(200)] + [(None, None, None, None, None), (5, "", "s1", "k", 0)] + [
        (7, "same row", "s3", "k", 7)] * 6
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, key string, copies int")
    got = mixing.mix(df)
    assert got.schema.names == df.schema.names
    assert got.join(df.distinct(), ["doc_id", "source", "copies"], "left_anti").where("doc_id is not null").count() == 0
    words = got.groupBy("source").agg(F.sum(words_in(F.col("text"))).alias("n"))
    targets = mixing.source_targets(df.select("source", words_in(F.col("text")).alias("size")))
    for r in targets.join(words, targets.source.eqNullSafe(words.source)).collect():
        assert abs(r["n"] - r["target"]) <= 20
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.plan(df.limit(0).selectExpr("doc_id", "source", "0L AS size"), "doc_id").count() == 0


def test_words(spark):
    df = spark.createDataFrame([("a b\tc\x0bd\x0ce\rf\ng  h",), ("",), (None,), ("    x",), ("\x1c",)], "t string")
    assert [r[0] for r in df.select(words_in(F.col("t"))).collect()] == [8, 0, 0, 2, 1]
