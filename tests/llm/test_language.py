import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricetrend.llm import language as L
from pricetrend.llm.language import LanguageParams, Leader

PLAIN = {"it": "il lo la che per una gatto cane notte mare sole luna strada", "nl": "het een van dat niet voor kat hond nacht zee zon maan straat",
         "fi": "se ja ei on että kissa koira yö meri aurinko kuu katu"}


def rows(n=600):
    random.seed(5)
    out = []
    for i in range(n):
        lang = list(PLAIN)[i % 3]
        out.append((i, " ".join(random.choice(PLAIN[lang].split()) for _ in range(random.randint(2, 40))) + ".", lang))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    odd = [(None, "il gatto", "it"), (9001, None, "it"), (9002, "", "nl"), (9003, "123 ... !?", "fi"), (9004, "het een van", None),
           (9005, "İ ß Ǆ 日本", "it"), (9006, "kissa ja koira " * 60000, "fi"), (0, *rows()[0][1:]), (0, *rows()[0][1:])]
    df = spark.createDataFrame(rows() + odd, "doc_id long, text string, lang string")
    return df.selectExpr("*", "'x' AS utf8", "2 AS LANG_PRED", "3 AS id").repartition(5)


def test_held_out_languages(spark, docs):
    params = LanguageParams(per_lang=100, buckets_log2=14)
    model = L.fit(docs, ~L.held_out(), params)
    assert model.langs == ["fi", "it", "nl"] and 0 < model.nonzero < 0.5
    got = L.predict(docs, model)
    assert got.columns == ["doc_id", "text", "lang", "utf8", "id", "lang_pred", "score"]
    got = got.withColumn("held_out", L.held_out()).collect()
    assert len(got) == 609 and all(0 <= r["score"] <= 1 and r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    by = {r["doc_id"]: r for r in got}
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (9001, 9002, 9003))
    assert by[9004]["lang_pred"] == "nl" and by[9006]["lang_pred"] == "fi" and by[None]["lang_pred"] == "it"
    held = [r for r in got if r["held_out"] and r["doc_id"] < 600]
    assert len(held) > 150 and np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.98
    # A rerun on other partitions gives the same model; held-out languages have no say.
    other = docs.withColumn("lang", F.when(L.held_out(), F.lit("zz")).otherwise(F.col("lang"))).repartition(2)
    again = L.fit(other, ~L.held_out(), params)
    assert again.langs == model.langs and again.features.tolist() == model.features.tolist() and np.allclose(again.weights, model.weights) and again.heat == pytest.approx(model.heat)


def test_little_or_nothing_to_learn(spark, docs):
    nothing = L.fit(docs, F.lit(False))
    assert {(r["lang_pred"], r["score"]) for r in L.predict(docs, nothing).collect()} == {("und", 0.0)}
    one = L.fit(docs.where("lang = 'nl'"), ~L.held_out(), LanguageParams(buckets_log2=12))
    assert {(r["lang_pred"], r["score"]) for r in L.predict(docs.where("lang = 'fi' AND doc_id < 600"), one).collect()} == {("nl", 1.0)}
    blank = L.fit(docs.where("doc_id IN (9002, 9003)"), F.lit(True))
    assert blank.langs == ["fi", "nl"] and L.predict(docs.where("doc_id = 4"), blank).first()["score"] == 0.5
    empty = docs.limit(0)
    assert L.predict(empty, L.fit(empty, F.lit(True))).count() == 0


def plain_counts(text, params):
    """n-grams of the whole text one by one, hashed as the operator does."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    joined = " " + " ".join(letters.split()) + " "
    out = Counter()
    for n in range(params.orders):
        for i in range(len(joined) - n):
            h = 0
            for c in joined[i:i + n + 1]:
                h = (h * 0x9E3779B1 + ord(c)) & 0xFFFFFFFF
            h = ((h ^ (h >> 15)) * (0x85EBCA77 + 2 * n)) & 0xFFFFFFFF
            out[h >> (32 - params.buckets_log2)] += 1
    return out


@pytest.mark.parametrize("section", [1, 7, 1 << 18])
def test_sections_count_every_gram_once(section):
    params = LanguageParams(section=section)
    for text in ("Ein Satz, 3 Wörter!  Noch\neiner.", "a", "ab c", "x" * 50):
        f, n = L.counts(text, params)
        assert dict(zip(f.tolist(), n.tolist())) == dict(plain_counts(text, params))


def test_document_frequencies(spark):
    params = LanguageParams(buckets_log2=12)
    texts = [r[1] for r in rows(60)]
    n, df = L.frequencies(spark.createDataFrame([(t,) for t in texts] + [("",), (None,)], "t string").select(F.col("t").cast("binary").alias("t")).where("t IS NOT NULL").repartition(3), params)
    want = Counter(f for t in texts for f in plain_counts(t, params))
    assert n == 61 and {i: c for i, c in enumerate(df.tolist()) if c} == dict(want)


def test_leader_steps_like_the_formula():
    params = LanguageParams(buckets_log2=3, l1=0.4, l2=0.1, alpha=0.3)
    rng = np.random.default_rng(3)
    leader = Leader(np.zeros((8, 3)), np.zeros((8, 3)), params)
    z, n = np.zeros((8, 3)), np.zeros((8, 3))
    for _ in range(20):
        texts = [(np.sort(rng.choice(8, 4, replace=False)), rng.random(4)) for _ in range(5)]
        y = rng.integers(0, 3, 5)
        leader.learn(texts, y)
        w = np.zeros((8, 3))
        for i in range(8):
            for c in range(3):
                if abs(z[i, c]) > params.l1:
                    w[i, c] = -(z[i, c] - math.copysign(params.l1, z[i, c])) / ((params.beta + math.sqrt(n[i, c])) / params.alpha + params.l2)
        g = np.zeros((8, 3))
        for (f, x), lab in zip(texts, y):
            p = np.exp(sum(v * w[i] for i, v in zip(f, x)))
            p /= p.sum()
            p[lab] -= 1
            for i, v in zip(f, x):
                g[i] += v * p / 5
        z += g - (np.sqrt(n + g * g) - np.sqrt(n)) / params.alpha * w
        n += g * g
    assert np.allclose(leader.z, z) and np.allclose(leader.n, n)
    assert (leader.weights() == 0).any() and (leader.weights() != 0).any()


def test_temperature_is_the_likeliest():
    rng = np.random.default_rng(6)
    y = rng.integers(0, 3, 400)
    scores = 8.0 * (np.eye(3)[y] + rng.normal(size=(400, 3)))
    loss = lambda t: -np.log(L.softmax(scores / t)[np.arange(400), y]).mean()
    best = L.temperature(scores, y)
    assert loss(best) <= min(loss(t) for t in np.geomspace(0.05, 20, 200)) + 1e-6
    assert L.temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0
