import random

import pytest

from llm_fixtures import library, vocab  # noqa: F401
from pricetrend.llm import token_counts as t

PARAMS = t.CountParams(chunk=100, overlap=20)


def texts():
    random.seed(11)
    words = ["the", "don't", "x1y2", "Größe", "日本語", "🙂", "...", "<|endoftext|>", "\n\n", "   ", "a" * 30, "1234567"]
    out = ["".join(random.choice(words) + random.choice(["", " "]) for _ in range(random.randint(1, 300))) for _ in range(60)]
    return out + ["", None, "a" * 900, "é" * 700, " " * 800, "<|endoftext|>" * 90, "ab" * 99 + " " + "x" * 500, "word " * 40]


def test_counts_match_the_library(spark, vocab, library):
    rows = [(i, x, "k") for i, x in enumerate(texts())] + [(None, "again " * 50, "k"), (3, texts()[3], "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_tokens string").selectExpr("*", "'r' AS row", "'s' AS its_row")
    got = t.count_tokens(df, vocab, params=PARAMS)
    assert sorted(got.columns) == ["doc_id", "its_row", "n_tokens", "row"]
    want = sorted((i is None, i or 0, len(library.encode(x or "", add_special_tokens=False).ids)) for i, x, _ in rows)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"]) for r in got.collect()) == want
    assert t.count_tokens(df.limit(0), vocab, params=PARAMS).count() == 0


@pytest.mark.parametrize("pair,cut", [("a ", True), ("  ", False), (" a", False), ("a1", True), ("1a", True), ("a'", True), ("'s", False), ("1.", True), (".1", True)])
def test_provable_cuts(pair, cut):
    assert t.always_cut(*pair) is cut
