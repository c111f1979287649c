import random

import public_tokenizers
import pytest
import sentencepiece

from larkspire.llm import token_counts as C
from tests.llm.helpers import documents, rows

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "\n", "\n\n", " \n ", "a\n b", "  a  b ", "a▁b", "▁", "\n▁▁a", "é́ 　x", "a\tb\r\nc", None, "<s> </s>", "x" * 3000, " x\n\n  y  \nz ", "ab" * 700 + "\n" + "ba" * 50, "日本語 ﬁ\x00"]


def texts(seed, n=300):
    random.seed(seed)
    parts = ["the", "of", "Thor", "ing", "é", "\n", "  ", " ", " ", " ", "12", "▁", "日", "\t", "<unk>", ".", "xq"]
    return ["".join(random.choice(parts) for _ in range(random.randrange(60))) for _ in range(n)]


@pytest.fixture(scope="module")
def processor():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_counts_like_the_library(processor, monkeypatch):
    for memo in (1 << 25, 25):
        monkeypatch.setattr(C, "MEMO_BYTES", memo)
        counter = C.WholeTokenCounter(MODEL)
        assert counter.cuts_words and counter.cuts_lines and len(counter.proof.whole) > 10_000
        for some in (ODD, texts(1), texts(2)):
            assert counter.count(some) == [len(processor.encode(t or "")) for t in some]


def test_whole_tokens_are_proven(processor):
    for surface in sorted(C.prove(MODEL).whole)[1:2000:37]:
        assert len(processor.encode(surface)) == 1


def test_normaliser_is_read_from_the_model():
    message = lambda *parts: b"".join(bytes([k << 3 | 2, len(v)]) + v if isinstance(v, bytes) else bytes([k << 3, v]) for k, v in parts)
    rules = {1: b"identity", 2: b"", 3: 1, 4: 0, 5: 1}
    assert C.marks_spaces_only(message((1, b"piece"), (3, message(*rules.items()))))
    for number, value in ((2, b"table"), (3, 0), (4, 1), (5, 0)):
        assert not C.marks_spaces_only(message((3, message(*(rules | {number: value}).items()))))
    assert not C.marks_spaces_only(b"")  # a model that says nothing removes extra spaces


def test_query(spark, processor):
    docs = documents(spark, ODD + ODD + [(None, "a b")])
    got = rows(C.count_tokens(docs.selectExpr("*", "1 AS n_bytes", "2 AS n_tokens"), MODEL, limit=500), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = [(i, len((t or "").encode()), n := len(processor.encode(t or "")), n > 500) for i, t in enumerate(ODD + ODD)] + [(None, 3, 2, False)]
    assert got == sorted(want, key=repr)
    assert C.count_tokens(documents(spark, []), MODEL).count() == 0
