import pytest


@pytest.fixture(scope="session")
def vocab():
    public = pytest.importorskip("public_tokenizers")
    return public.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def library(vocab):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocab)
    t.no_truncation()
    t.no_padding()
    return t
