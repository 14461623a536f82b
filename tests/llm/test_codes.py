import hashlib
import math

import numpy as np
import pytest

from pricetrend.llm import codes
from pricetrend.llm.codes import Balls, CodeParams, assign

NAN, INF = float("nan"), float("inf")


def plain(x, params):
    """The quantiser by the full search over all entries, in Python integers."""
    d = len(x[0]) // params.parts
    parts = [[r[k * d:(k + 1) * d] for r in x] for k in range(params.parts)]
    books = [p[:params.entries] for p in parts]
    near = lambda v, book: min((sum((a - b) ** 2 for a, b in zip(v, e)), j) for j, e in enumerate(book))
    for step in range(params.rounds + 1):
        found = [[near(v, book) for v in p] for p, book in zip(parts, books)]
        if step < params.rounds:
            for k, p in enumerate(parts):
                for j in range(len(books[k])):
                    mine = [v for v, (_, c) in zip(p, found[k]) if c == j]
                    if mine:
                        books[k] = [*books[k][:j], [sum(c) // len(mine) for c in zip(*mine)], *books[k][j + 1:]]
    return [[f[i][1] for f in found] for i in range(len(x))], [[f[i][0] for f in found] for i in range(len(x))], books


def whole(v, limit=2 ** 28):
    return [max(-limit, min(limit, math.floor(1024 * c))) for c in v]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(8)
    x = np.concatenate([c + 0.3 * rng.normal(size=(80, 8)) for c in rng.normal(size=(5, 8))])
    x[100:130] = x[3]       # one vector many times
    x[200:240] = np.round(x[200:240])   # equal distances
    return x


def test_equals_the_full_search(spark, vectors):
    rows = [(i, [float(c) for c in v], f"l{i % 3}" if i % 7 else None, "x", 1) for i, v in enumerate(vectors)]
    odd = [(900, None, "l0", "x", 1), (901, [NAN] + [0.0] * 7, "l0", "x", 1), (902, [None] + [0.0] * 7, None, "x", 1), (903, [INF] * 8, "l0", "x", 1),
           (904, [1.0], "l0", "x", 1), (905, [], "l0", "x", 1), (None, [0.25] * 8, "l1", "x", 1), rows[5], (907, [0.0] * 8, None, "x", 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label string, id string, code int").repartition(7)
    params = CodeParams(parts=4, entries=40, rounds=4, at_once=64)
    coded = codes.compress(df, params)
    kept = sorted([(i, v, lab) for i, v, lab, _, _ in [*rows, rows[5], odd[-1]]], key=lambda t: t[0]) + [(None, [0.25] * 8, "l1")]
    want_code, want_dist, books = plain([whole(v) for _, v, _ in kept], params)
    assert coded.books.tolist() == books
    assert coded.digest() == hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    got = codes.with_label_error(coded.rows).collect()
    key = lambda t: (t[0] is None, t[0] or 0)
    assert sorted(((r["id"], r["label"], r["code"], r["dist"]) for r in got), key=key) == [
        (i, lab, c, d) for (i, _, lab), c, d in zip(kept, want_code, want_dist)]
    total = {}
    for (_, _, lab), d in zip(kept, want_dist):
        total[lab] = total.get(lab, 0) + sum(d)
    assert all(r["error"] == sum(r["dist"]) and r["label_error"] == total[r["label"]] for r in got)


def test_rings_and_cores_lose_nothing():
    rng = np.random.default_rng(2)
    for spread in (2, 5, 400):   # from nearly all distances equal to well apart
        x = rng.integers(-spread, spread + 1, (600, 3))
        book = x[:30].copy()
        full = ((x[:, None] - book) ** 2).sum(2)
        code, dist = full.argmin(1), full.min(1)
        for _ in range(5):
            before, far = book.copy(), np.zeros(30, np.int64)
            np.maximum.at(far, code, dist)
            for j in range(30):
                if (code == j).any():
                    book[j] = x[code == j].sum(0) // (code == j).sum()
            balls = Balls(book, before, far)
            code, dist = assign(x, code, dist, book, balls)
            full = ((x[:, None] - book) ** 2).sum(2)
            assert (code == full.argmin(1)).all() and (dist == full.min(1)).all()


def test_a_still_book_is_settled_and_cores_are_stable():
    book = np.array([[0, 0], [100, 0], [0, 100]])
    still = Balls(book, book, np.array([9, 9, 9]))
    assert still.settled.all() and (still.near == 0).all()
    moved = Balls(book, book + [[0, 0], [90, 0], [0, 0]], np.array([9, 9, 9]))
    assert moved.settled.tolist() == [True, False, True]


def test_few_empty_uneven_and_huge(spark):
    schema = "vec_id long, embedding array<double>, label int"
    assert codes.compress(spark.createDataFrame([], schema)).rows.count() == 0
    assert codes.with_label_error(codes.compress(spark.createDataFrame([(1, None, 2)], schema)).rows).count() == 0
    rows = [(3, [1.0, 2.0, 3.0], 1), (1, [1e300, -1e300, 0.0], None), (2, [0.5, 0.5, -1.0], None)]
    coded = codes.compress(spark.createDataFrame(rows, schema), CodeParams(parts=2))
    got = {r["id"]: (r["code"], r["error"], r["label_error"]) for r in codes.with_label_error(coded.rows).collect()}
    assert got == {1: ([0, 0], 0, 0), 2: ([1, 1], 0, 0), 3: ([2, 2], 0, 0)}
    assert coded.books[0, 0].tolist() == [2 ** 29, -2 ** 29] and coded.books[1, 2].tolist() == [3072, 0]
