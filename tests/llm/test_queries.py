"""The registered queries against brute force on the smallest tables."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from conftest import SF_MAIN, SF_SMALL
from llm_fixtures import library, vocab  # noqa: F401
from pricetrend.llm import queries as Q
from test_conversations import by_conv, plain_damage, plain_repair
from test_mixing import rate_by_hand, targets_by_hand
from test_secret_scan import plain_base
from test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text, source FROM '{SF_SMALL}/documents.parquet' ORDER BY doc_id").fetchall()


def rows(spark, name, sf=SF_SMALL):
    return [r.asDict() for r in entry.queries()[name](spark, sf).collect()]


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES)
    assert numbers == list(range(1, len(numbers) + 1)) and set(Q.ORACLE) <= set(Q.QUERIES)
    assert set(Q.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_op1(spark, docs):
    got = {r["doc_id"]: r for r in rows(spark, "op1_toxicity", SF_MAIN)}
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{SF_MAIN}/labels.parquet'").fetchall()
    assert len(got) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [(t, got[i]["predicted"]) for i, t in labels if got[i]["held_out"]]
    assert np.mean([t == p for t, p in held]) > 0.88
    assert not [e for r in got.values() for e in r["examples"] if zlib.crc32(str(e).encode()) % 4 == 2]


def test_op2_and_op10(spark, docs, library):  # noqa: F811
    coded = {r["doc_id"]: r for r in rows(spark, "op2_bpe_round_trip")}
    counted = {r["doc_id"]: r for r in rows(spark, "op10_token_counts")}
    assert len(coded) == len(counted) == len(docs)
    for i, text, _ in docs:
        ids = library.encode(text, add_special_tokens=False).ids
        assert (coded[i]["n_tokens"], coded[i]["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert coded[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert counted[i] == {"doc_id": i, "n_bytes": len(text.encode()), "n_tokens": len(ids), "over_limit": len(ids) > 1024}


def test_op3(spark, docs):
    want = [(i, plain_fingerprint(t)) for i, t, _ in docs]
    got = sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows(spark, "op3_simhash"))
    assert got == [(i, f"{f:016x}", c) for (i, f), c in zip(want, plain_components(want))]


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    want = con.execute(Q.ORACLE[name])
    columns = [c[0] for c in want.description]
    got = sorted((tuple(r[c] for c in columns) for r in rows(spark, name)), key=repr)
    assert got == sorted(want.fetchall(), key=repr) and got


def test_op5(spark, docs):
    size = {i: len(t.encode().split()) for i, t, _ in docs}
    of = {i: s for i, _, s in docs}
    total = {s: sum(size[i] for i in of if of[i] == s) for s in set(of.values())}
    targets, got = targets_by_hand(total), rows(spark, "op5_mixing")
    assert len(got) == len(docs)
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == total[of[r["doc_id"]]]
        assert r["target"] == pytest.approx(targets[of[r["doc_id"]]]) and 0 <= r["taken"] <= 3 * r["size"]
    for s in total:
        mine = [r for r in got if of[r["doc_id"]] == s]
        assert [r["rate"] for r in mine] == pytest.approx(rate_by_hand([r["size"] for r in mine], targets[s]), rel=1e-3, abs=1e-6)
        assert abs(sum(r["taken"] for r in mine) - targets[s]) <= max(r["size"] for r in mine)


def test_op6(spark):
    got = {r["doc_id"]: r for r in rows(spark, "op6_quality", SF_MAIN)}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF_MAIN}/labels.parquet'").fetchall()
    assert len(got) == 1000 and all(r["keep"] == (r["score"] >= 0.5) for r in got.values())
    assert np.mean([got[i]["keep"] == bool(q) for i, q in labels if got[i]["held_out"]]) > 0.95


def test_op7(spark):
    table = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF_MAIN}/embeddings.parquet' ORDER BY vec_id").fetchall()
    ids, x = np.array([r[0] for r in table]), np.array([r[1] for r in table], np.float64)
    got, hit, n = rows(spark, "op7_ann", SF_MAIN), 0, 0
    for q in ids[ids % 20 == 0].tolist():
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        best = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        mine = {r["vec_id"]: r for r in got if r["query_id"] == q}
        assert sorted(r["rank"] for r in mine.values()) == list(range(1, 21))
        assert all(r["score"] == pytest.approx(s[ids == v][0], rel=1e-12) for v, r in mine.items())
        hit, n = hit + len(best & set(mine)), n + 20
    assert hit >= 0.9 * n


def test_op8(spark, docs):
    got = {r["doc_id"]: r for r in rows(spark, "op8_secret_scan")}
    names = ["assign", "access", "hex"]
    for i, text, _ in docs:
        base = [(names[k], s, e) for s, k, e in plain_base(text)]
        said = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert got[i]["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in names] == [sum(b[0] == k for b in base) for k in names]
        spans = [x for x in got[i]["spans"].split(",") if x]
        assert [x for x in spans if not x.startswith("grammar_")] == [x for x in said.split(",") if x]


def test_op12(spark):
    got = {r["doc_id"]: r for r in rows(spark, "op12_language", SF_MAIN)}
    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF_MAIN}/documents.parquet'").fetchall())
    assert set(got) == set(langs) and all(0 <= r["score"] <= 1 for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert np.mean([got[i]["lang_pred"] == langs[i] for i in got if got[i]["held_out"]]) > 0.98


def test_op13(spark):
    talk = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF_SMALL}/conversations.parquet'").fetchall()
    want = {c: plain_repair(plain_damage(v)) for c, v in by_conv(talk).items()}
    got = {r.pop("conv_id"): tuple(r.values()) for r in rows(spark, "op13_conversations")}
    assert got == want


def test_xxhash_of_spark_is_the_shingle_hash(spark):
    assert spark.sql("SELECT xxhash64('a b c d')").first()[0] & (2 ** 64 - 1) == xxhash.xxh64_intdigest("a b c d", 42)
