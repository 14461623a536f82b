import random
import zlib

import numpy as np

from pricetrend.llm import quality, toxicity


def tables(spark, n=900):
    random.seed(12)
    words = ["w%d" % i for i in range(500)]
    docs, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        body = [random.choice(words) for _ in range(random.randint(60, 200))] if good else [random.choice(words[:3]) + "!!" for _ in range(random.randint(5, 60))]
        text = " ".join(body)
        docs.append((i, text, "en", "good.org" if good and i % 3 else "mixed.org", len(text)))
        if i % 2:
            labels.append((i, int(good)))
        elif i % 8 == 0:
            labels.append((i, int(good)))
    docs += [(None, None, None, None, None), (n, "", None, "x", 0), (0, *docs[0][1:]), (n + 1, "long " * 50000, "en", "x", 250000)]
    labels += [(None, 1), (2, None), (6, 7), (0, 1)]
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS part", "'q' AS its_id"),
            spark.createDataFrame(labels, "doc_id long, quality int"))


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = tables(spark)
    rows = quality.features(docs, labels, learn_from=~toxicity.held_out())
    got = quality.score(rows, quality.fit(rows)).collect()
    assert len(got) == 904 and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["id"] is not None and r["id"] < 900 and zlib.crc32(str(r["id"]).encode()) % 4 == 2]
    right = [(r["score"] >= 0.5) == (r["id"] % 4 != 0) for r in held]
    assert len(held) > 100 and np.mean(right) > 0.95


def test_without_labels_or_documents(spark):
    docs, labels = tables(spark, 40)
    rows = quality.features(docs, labels.limit(0))
    assert {r["score"] for r in quality.score(rows, quality.fit(rows)).collect()} == {0.5}
    rows = quality.features(docs, labels.where("quality = 1"))
    assert {r["score"] for r in quality.score(rows, quality.fit(rows)).collect()} == {1.0}
    rows = quality.features(docs.limit(0), labels)
    assert quality.score(rows, quality.fit(rows)).count() == 0


def test_text_features_ignore_nothing_but_length():
    assert len(quality.text_features(None)) == quality.N_TEXT
    assert quality.text_features("a b c. " * 5)[:2] != quality.text_features("a b c. " * 50)[:2]


def test_calibration_is_monotone():
    rng = np.random.default_rng(1)
    edges = np.linspace(-8, 8, 33)
    total = rng.integers(0, 50, 32).astype(float)
    z, c = quality.calibrate(total, np.round(total * rng.random(32)), edges)
    assert (np.diff(z) > 0).all() and (np.diff(c) >= 0).all()
