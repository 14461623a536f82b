import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricetrend.llm import ann, topk
from pricetrend.llm.vectors import best_pairs

NAN, INF = float("nan"), float("inf")


def table(spark, x, odd=True):
    rows = [(i, [float(c) for c in v], i) for i, v in enumerate(x)]
    if odd:
        d = len(x[0])
        rows += [(10_000, None, 0), (10_100, [0.0] * d, 0), (10_200, [NAN] * d, 0), (10_300, [INF] + [0.0] * (d - 1), 0),
                 (10_400, [None] + [1.0] * (d - 1), 0), (10_500, [1.0], 0), (10_600, [], 0), (None, [1.0] * d, 0), rows[0], rows[0]]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")


def brute(x, ids, queries, k, product):
    out = []
    for q in queries:
        i = ids.index(q)
        ranked = sorted((-product(x[i], x[j]), ids[j]) for j in range(len(x)) if ids[j] != q)
        out += [(q, r + 1, v, -s) for r, (s, v) in enumerate(ranked[:k])]
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    x = np.concatenate([c + 0.5 * rng.normal(size=(150, 12)) for c in rng.normal(size=(6, 12))])
    x[300:340] = x[5]  # many ties
    return x


def whole(v):
    return [math.floor(1024 * float(c)) for c in v]


def test_topk_is_exact(spark, vectors):
    zero = [0.0] * 12
    got = topk.search(table(spark, vectors), F.col("id") % 100 == 0, topk.TopkParams(per_cell=200, queries_per_block=3, at_once=64))
    ids = [*range(len(vectors)), 10_100]
    want = brute([whole(v) for v in vectors] + [whole(zero)], ids, [i for i in ids if i % 100 == 0], 10, lambda a, b: sum(p * q for p, q in zip(a, b)))
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect()) == sorted(want)


def test_topk_of_huge_and_few(spark):
    x = [[1e30, 1.0], [1e30, -1.0], [-1e300, 2.0], [0.3, 0.4]]
    got = topk.search(table(spark, x, odd=False), F.col("id") == 0).collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(1, 2 ** 63 - 1), (3, 2 ** 63 - 1), (2, -2 ** 63)]
    empty = table(spark, x).limit(0)
    assert topk.search(empty, F.col("id") == 0).count() == 0 and ann.search(empty, F.col("id") == 0).count() == 0


def test_segment_statistics_bound_products(vectors):
    for n in (1, 4, 12):
        s = topk.statistics(vectors, n)
        assert (s @ s.T >= vectors @ vectors.T - 1e-9).all()


def test_ann_scores_and_recall(spark, vectors):
    params = ann.AnnParams(per_list=60, per_part=50, queries_per_part=7, columns=4)
    got = ann.search(table(spark, vectors * 3), F.col("id") % 20 == 0, params).collect()
    x = vectors * 3
    asked = [i for i in range(len(x)) if i % 20 == 0]
    want = brute(x, list(range(len(x))), asked, 20, lambda a, b: round(float(a @ b), 9))
    hit = {(q, v) for q, _, v, _ in want} & {(r["query_id"], r["vec_id"]) for r in got}
    assert len(hit) >= 0.9 * len(want) and len(got) == len(want)
    for r in got:
        assert r["score"] == pytest.approx(float(x[r["query_id"]] @ x[r["vec_id"]]), rel=1e-12)
    for q in asked:
        mine = [r for r in got if r["query_id"] == q]
        assert [r["rank"] for r in mine] == sorted(r["rank"] for r in mine) and all(
            (a["score"], -a["vec_id"]) >= (b["score"], -b["vec_id"]) for a, b in zip(mine, mine[1:]))


def test_queries_beside_tiny_lists_get_all_their_rows(spark):
    """Ten vectors far off the rest have lists of their own, with fewer than k members."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(2000, 8))
    x[::200] = 40 + 0.01 * rng.normal(size=(10, 8))
    df = table(spark, x, odd=False)
    got = ann.search(df, F.col("id") % 200 == 0, ann.AnnParams(per_list=25)).collect()
    for q in range(0, 2000, 200):
        mine = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == q)
        assert [r for r, _ in mine] == list(range(1, 21)) and {v for _, v in mine[:9]} == {i for i in range(0, 2000, 200) if i != q}


def test_a_row_of_few_vectors(spark):
    got = ann.search(table(spark, [[1.0, 0.0], [0.0, 2.0], [3.0, 3.0]], odd=False), F.col("id") == 0).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(1, 2, 3.0), (2, 1, 0.0)]


def test_best_pairs():
    q, s, v = np.array([1, 0, 1, 1, 0]), np.array([2.0, 1.0, 2.0, 3.0, 1.0]), np.array([9, 5, 4, 7, 2])
    assert best_pairs(q, s, v, 2).tolist() == [4, 1, 3, 2]
