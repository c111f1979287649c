import json
import random
import subprocess
import sys
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest

from larkspire.llm import bpe_codec as C
from tests.llm.helpers import documents, rows

FILE = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, " ", "Hello, World!  it's", "<|endoftext|>a<|startoftext|> b", "x<|endoftext|>" * 200, "<|endoftext|>" * 5000, "ab" * 3000, "a" * 1501, "the" * 900 + "'s", "!?" * 800 + "z", "日本語" * 300, "a\u0085b\x1cc d", "é" * 700, " ́a é", "İI" * 400, "Σς ΑΣ", "½½ 12", "a\x00b", "'S 'Ll don'T"]


@pytest.fixture(scope="module")
def codec():
    return C.TreeCodec(FILE)


def library(codec, text):
    e = codec.tokenizer.encode(text or "", add_special_tokens=False)
    return len(e.ids), " ".join(map(str, e.ids)), codec.tokenizer.decode(e.ids, skip_special_tokens=False)


def shown(codec, ids):
    ids = np.frombuffer(ids, np.int32).tolist()
    return len(ids), " ".join(map(str, ids)), codec.decode(ids)


def test_same_as_the_library(codec, monkeypatch):
    random.seed(4)
    mixed = ["".join(random.choice(["the", "in", "G", "er", " ", "n", "T", "é", "ti", "\n", "12", "'s", "!", "<|", "ß", "ő"]) for _ in range(random.randrange(80))) for _ in range(300)]
    for memo in (1 << 25, 30):
        monkeypatch.setattr(C, "MEMO_BYTES", memo)
        for some in (ODD, mixed, mixed[:9]):
            assert [shown(codec, x) for x in codec.encode_texts(some)] == [library(codec, t) for t in some]


def test_files_with_other_steps(tmp_path):
    """A vocabulary that isn't known to break texts at spaces gets whole texts."""
    spec = json.loads(open(FILE, encoding="utf-8").read())
    spec["pre_tokenizer"] = None
    (tmp_path / "other.json").write_text(json.dumps(spec), encoding="utf-8")
    other, some = C.TreeCodec(str(tmp_path / "other.json")), ["the inner thing", "a\nb", "", None]
    assert other.cut is None and [shown(other, x) for x in other.encode_texts(some)] == [library(other, t) for t in some]


def test_memory_of_long_texts():
    """512 texts of 20 000 words take under 700 MB, the texts (75 MB) and their ids included."""
    code = """
import random, resource, sys
from larkspire.llm import bpe_codec as C
random.seed(1)
words = ["".join(random.choice("etaoinshrdlu") for _ in range(random.randrange(1, 11))) for _ in range(50000)]
codec = C.TreeCodec(sys.argv[1])
made = []
for start in range(0, 512, 64):
    texts = [" ".join(random.choices(words, k=20000)) for _ in range(64)]
    made += [len(x) for x in codec.encode_texts(texts)]
print(len(made), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    n, peak = map(int, subprocess.run([sys.executable, "-c", code, FILE], capture_output=True, text=True, check=True).stdout.split())
    assert n == 512 and peak < 700


def test_trees_of_any_leaf_size(codec, monkeypatch):
    random.seed(9)
    for leaf in (1, 2, 7, 64):
        monkeypatch.setattr(C, "LEAF_CHARS", leaf)
        for _ in range(60):
            word = "".join(random.choice(["the", "in", "g", "er", "a", "n", "t", "s", "ti", "on"]) for _ in range(random.randrange(1, 120)))
            assert codec.tree(word) == [t.id for t in codec.tokenizer.model.tokenize(word)]


def test_query(spark, codec):
    docs = documents(spark, ODD + ODD[:4] + [(None, "x y")]).selectExpr("*", "1 AS ids", "2 AS n_tokens")
    want = [library(codec, t) for t in ODD + ODD[:4]]
    plain = {r.doc_id: r for r in C.encode(docs, FILE).collect()}
    assert [(plain[i].n_tokens, " ".join(map(str, plain[i].ids)), plain[i].decoded) for i in range(len(want))] == want and plain[None].n_tokens == 2
    got = rows(C.encode(docs, FILE, digests=True).where("doc_id IS NOT NULL"), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(((i, n, sha256(a.encode()).hexdigest(), sha256(b.encode()).hexdigest()) for i, (n, a, b) in enumerate(want)), key=repr)
    assert C.encode(documents(spark, []), FILE).count() == 0
