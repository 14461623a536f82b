import random
import zlib

import numpy as np

from pricetrend.llm import toxicity


def test_index_is_exact():
    rng = np.random.default_rng(0)
    vectors = rng.random((500, 40)) * (rng.random((500, 40)) < 0.2)
    vectors[100:140] = vectors[99]  # ties
    norm = np.sqrt((vectors ** 2).sum(1, keepdims=True))
    vectors = np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)
    ids = rng.permutation(500)
    index = toxicity.BlockMaxIndex.build(ids, ids % 2, vectors)
    queries = np.concatenate([vectors[90:150], np.zeros((1, 40))])
    at, sim = index.nearest(queries, 7)
    # With the keys of the queries (here: the examples' ids) those examples have no say.
    keys = np.append(ids[90:150], -1)
    less_at, less_sim = index.nearest(queries, 7, keys)
    for q, a, s, key in zip(queries, less_at, less_sim, keys):
        cos = np.round(vectors @ q, 12)
        want = sorted((c, i) for c, i in zip(-cos, ids) if i != key and c < 0)[:7]
        assert [(-x, index.ids[p]) for x, p in zip(s, a) if p >= 0] == want
    for q, a, s in zip(queries, at, sim):
        cos = np.round(vectors @ q, 12)
        want = [(c, i) for c, i in sorted(zip(-cos, ids))[:7] if c < 0]
        assert [(-x, index.ids[p]) for x, p in zip(s, a) if p >= 0] == [(c, i) for c, i in want]


def test_calibration_is_monotone_and_handles_no_neighbours():
    votes = np.array([0.0, 0.1, 0.2, 0.5, 0.5, 0.9, 1.0, -1.0])
    fit = toxicity.Calibration.fit(votes, np.array([0, 1, 0, 0, 1, 1, 1, 0.0]), np.ones(8))
    got = fit(np.linspace(0, 1, 21))
    assert (np.diff(got) >= -1e-12).all() and 0 <= got[0] and got[-1] <= 1
    assert fit(np.array([-1.0]))[0] == fit.without < 0.5


def make(spark, n=400):
    random.seed(2)
    plain = ["word%d" % i for i in range(300)]
    bad = ["nastyish", "nastylike", "vile"]
    rows, labels = [], []
    for i in range(n):
        words = [random.choice(plain) for _ in range(60)]
        y = int(i % 5 == 0)
        if y:
            for _ in range(3):
                words[random.randrange(60)] = random.choice(bad)
        rows.append((i, " ".join(words), "extra"))
        labels.append((i, y))
    rows += [(None, None, None), (n, "", "x"), (0, rows[0][1], "extra"), (n + 1, "vile " * 20000, "long")]
    labels += [(0, 0), (None, 1), (3, None), (7, 5)]
    return (spark.createDataFrame(rows, "doc_id long, text string, toxicity_terms string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def run(docs, labels, **more):
    params = toxicity.ToxicityParams(per_class=100, **more)
    examples = toxicity.choose(docs, labels, params, learn_from=~toxicity.held_out())
    marked = toxicity.hits(docs, examples.terms)
    model = toxicity.fit(examples, marked, params)
    got = toxicity.score(marked, model).collect()
    once = toxicity.score_texts(docs, examples.terms, model)
    assert sorted(map(str, once.select(*toxicity.score(marked, model).columns).collect())) == sorted(map(str, got))
    return got, model


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = make(spark)
    got, model = run(docs, labels)
    assert len(got) == 404
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 400 and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(held) > 50 and all((r["toxicity_score"] >= 0.3) == (r["doc_id"] % 5 == 0) for r in held)
    by = {r["doc_id"]: r for r in got}
    assert by[None]["toxicity_score"] < 0.3 and by[None]["toxicity_vote"] is None and by[None]["toxicity_examples"] == []
    assert by[401]["toxicity_score"] >= 0.3 and len(by[401]["toxicity_examples"]) == 15
    # No text's own label, or that of its copy, votes on it.
    assert not [r for r in got if r["doc_id"] in r["toxicity_examples"]]
    # No label of a held-out id is an example.
    assert not [i for i in model.index.ids.tolist() if zlib.crc32(str(i).encode()) % 4 == 2]


def test_without_labels_or_documents(spark):
    docs, labels = make(spark, 40)
    got, _ = run(docs, labels.limit(0))
    assert len(got) == 44 and {r["toxicity_score"] for r in got} == {0.0}
    got, _ = run(docs, labels.where("toxic = 0"))
    assert {r["toxicity_score"] for r in got} == {0.0}
    assert run(docs.limit(0), labels)[0] == []


def test_wide_toxic_vocabulary(spark):
    """No toxic word is common: 100 of them without a common stem, two to a toxic text."""
    random.seed(5)
    name = lambda i, last: "".join(chr(97 + i // 10 ** k % 10) for k in (0, 1, 2)) + last
    plain, bad = [name(i, "plainword") for i in range(300)], [name(i, "zzvileword") for i in range(100)]
    rows, labels = [], []
    for i in range(2500):
        y = int(i % 5 == 0)
        words = random.choices(plain, k=40) + random.sample(bad, 2) * 2 * y
        rows.append((i, " ".join(words)))
        labels.append((i, y))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    params = toxicity.ToxicityParams()
    examples = toxicity.choose(docs, known, params, learn_from=~toxicity.held_out())
    model = toxicity.fit(examples, toxicity.hits(docs, examples.terms), params)
    got = {r["doc_id"]: r["toxicity_score"] >= 0.3 for r in toxicity.score_texts(docs, examples.terms, model).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    toxic = [i for i in held if i % 5 == 0]
    assert len(toxic) > 80 and sum(got[i] for i in toxic) >= 0.95 * len(toxic)
    assert sum(got[i] for i in held if i % 5) <= 0.05 * len(held)
    # Every plain and every toxic word that enough examples contain has a slot.
    assert len(examples.terms) >= 380
