import hashlib

import numpy as np

import corpus_pipeline as C
from conftest import SF_MAIN, SF_SMALL
from llm_fixtures import library, vocab  # noqa: F401
from pricetrend.llm import queries as Q
from pricetrend.llm.mixing import source_targets
from test_simhash import plain_components, plain_fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def odd(spark):
    same = "one two three four five six seven eight"
    rows = [(1, same, "en", "a", len(same), "x"), (2, same, "en", "b", len(same), "x"), (2, same, "en", "b", len(same), "x"),
            (None, same, None, None, None, None), (3, None, "en", "a", None, "x"), (4, "", "en", None, 0, "x"), (5, None, None, "a", None, None),
            (6, 'here is token = "0123456789abcdef0123" ok', "en", "b", 41, "x"), (7, "word " * 60000, "de", "b", 300000, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept_id string")


def test_stages_on_odd_rows_and_empty_tables(spark):
    names = [n for n, _ in C.STAGES]
    assert names == ["toxicity", "simhash", "secret_scan", "mixing", "bpe"]
    stage, docs = dict(C.STAGES), odd(spark)
    for name in names:
        out = stage[name](spark, docs.limit(0), SF_SMALL)
        assert out.count() == 0
        if name != "bpe":
            assert out.columns == docs.columns
    assert stage["toxicity"](spark, docs, SF_SMALL).count() == 9
    kept = stage["simhash"](spark, docs, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 3, 6, 7]     # null and empty texts are one group
    clean = {r["doc_id"]: r for r in stage["secret_scan"](spark, docs, SF_SMALL).collect()}
    assert clean[6]["text"] == 'here is [SECRET]" ok' and clean[6]["n_chars"] == 20 and clean[3]["text"] is None
    mixed = stage["mixing"](spark, docs, SF_SMALL).collect()
    assert {r["doc_id"] for r in mixed} <= {1, 2, 3, 4, 5, 6, 7, None}
    coded = stage["bpe"](spark, docs, SF_SMALL).collect()
    assert len(coded) == 9 and {r["n_tokens"] for r in coded if r["doc_id"] in (3, 4, 5)} == {0}


def test_run_against_the_queries_and_brute_force(spark, library):  # noqa: F811
    """Every stage of run(), recomputed from its own input."""
    docs = spark.read.parquet(f"{SF_MAIN}/documents.parquet").cache()
    data = {r["doc_id"]: r for r in docs.collect()}
    stage = dict(C.STAGES)
    calm = stage["toxicity"](spark, docs, SF_MAIN).cache()
    bad = {r["doc_id"] for r in Q.op1_toxicity(spark, SF_MAIN).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in calm.collect()} == set(data) - bad and bad
    single = stage["simhash"](spark, calm, SF_MAIN).cache()
    left = sorted(set(data) - bad)
    want = set(plain_components([(i, plain_fingerprint(data[i]["text"])) for i in left]))
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(want)
    clean = stage["secret_scan"](spark, single, SF_MAIN).cache()
    assert clean.count() == single.count() and clean.where("text rlike 'token = .[0-9a-f]{16}'").count() == 0
    mixed = stage["mixing"](spark, clean, SF_MAIN).cache()
    words = lambda t: len((t or "").encode().split())
    size: dict = {}
    for r in mixed.collect():
        size[r["source"]] = size.get(r["source"], 0) + words(r["text"])
    sized = spark.createDataFrame([(r["source"], words(r["text"])) for r in clean.collect()], "source string, size long")
    most = max(words(r["text"]) for r in clean.collect())
    for r in source_targets(sized).collect():
        assert abs(size[r["source"]] - r["target"]) <= most
    run = C.run(spark, SF_MAIN)
    assert C.ORACLE_SQL is None and run.columns[0] == "doc_id"
    got = sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in run.collect())
    again = []
    for r in mixed.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        again.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()))
    assert got == sorted(again)
