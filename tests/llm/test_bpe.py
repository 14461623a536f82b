import hashlib
import random

import numpy as np

from llm_fixtures import library, vocab  # noqa: F401
from pricetrend.llm import bpe

ODD = ["", " ", "\n\n  x", "aaaaaaaaaaaaaaaaaaaaaa", "a" * 5000, "x<|endoftext|>y<|endoftext|>", "<|endof", "don't we'll I've",
       "naïve façade Ölpreis 日本語 🙂🙂", "\u0000\u0001\x7f", "   tabs\t\t\tand  \r\n lines ", "0123456789" * 7]


def test_same_ids_and_texts_as_the_library(vocab, library):
    random.seed(5)
    alphabets = ["a", "ab", "aA ", " \n\t.", "abcdefghijklmnopqrstuvwxyz", "éèßаб中文🙂a1 ", "'s t re<|endoftext|>"]
    texts = ODD + ["".join(random.choice(a) for _ in range(random.randint(1, 60))) for a in alphabets for _ in range(300)]
    model = bpe.model(vocab)
    for text, got, want in zip(texts, model.encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert got.tolist() == want.ids, text
        assert model.decode(got) == library.decode(want.ids, skip_special_tokens=False)
    ids = [random.randrange(50257) for _ in range(400)]
    for at in range(0, 400, 7):
        part = ids[at:at + 7]
        assert model.decode(np.array(part)) == library.decode(part, skip_special_tokens=False)


def test_pair_check_agrees_with_exact_merging(vocab):
    model = bpe.model(vocab)
    rng = np.random.default_rng(3)
    tokens = np.array(sorted(model.token_id.values()))
    a, b = rng.choice(tokens, 4000), rng.choice(tokens, 4000)
    apart = model.apart(a, b)
    for x, y, ok in zip(a.tolist(), b.tolist(), apart.tolist()):
        assert ok == (model.merge_exactly(model.bytes_of[x] + model.bytes_of[y]) == [x, y])


def test_forgetting_words_changes_nothing(vocab, monkeypatch):
    model = bpe.BytePairModel(vocab)
    texts = ["the quick brown fox %d" % i for i in range(50)]
    want = [x.tolist() for x in model.encode(texts)]
    monkeypatch.setattr(bpe, "WORD_MEMORY", 3)
    assert [model.encode([t])[0].tolist() for t in texts] == want


def test_sections_change_nothing(vocab, library, monkeypatch):
    monkeypatch.setattr(bpe, "SECTION", 20)
    model = bpe.BytePairModel(vocab)
    texts = ODD + ["ab  cd   \t ef<|endoftext|> gh " * 9, "x" * 90, "it's <|endoftext|> ' re" * 8, " lead " * 12, "a\x1c b\x85 c\u3000 d" * 6]
    for t, got in zip(texts, model.encode(texts)):
        assert got.tolist() == library.encode(t, add_special_tokens=False).ids
        assert "".join(model.sections(t)) == t


def test_operators_on_odd_rows(spark, vocab, library):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, None, None), (1, " ", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")  # ids clashes and is replaced
    coded = bpe.encode(df, vocab)
    assert coded.columns == ["doc_id", "text", "n_tokens", "ids"]
    out = bpe.decode(coded, vocab).collect()
    assert len(out) == len(rows)
    for r in out:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["n_tokens"] == len(want)
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)
    both = bpe.round_trip(df, vocab).collect()
    assert sorted(hashlib.sha256(r["ids"]).hexdigest() for r in both) == sorted(hashlib.sha256(r["ids"]).hexdigest() for r in out)
    assert bpe.round_trip(df.limit(0), vocab).count() == 0
