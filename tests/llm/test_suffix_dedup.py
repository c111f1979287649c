import random

import numpy as np

from larkspire.llm import suffix_dedup as S
from tests.llm.helpers import documents, rows


def brute(texts):
    seen, out = {}, []
    for i, t in sorted(texts, key=lambda x: x[0]):
        data = (t or "").encode()
        mark = np.zeros(len(data), bool)
        for s in range(len(data) - 99):
            w = data[s : s + 100]
            if w in seen:
                mark[s : s + 100] = True
            else:
                seen[w] = i
        kept = bytes(np.frombuffer(data, np.uint8)[~mark])
        spans = int((np.diff(np.concatenate([[0], mark.astype(int)])) == 1).sum())
        out.append((i, len(data), int(mark.sum()), spans, kept))
    return out


def corpus(seed, n=120):
    random.seed(seed)
    words = ["the", "of", "é", "ing", "tion", "a", "blé", "thor", "wh", "\n", ".", "12"]
    make = lambda k: " ".join(random.choice(words) + random.choice(words) for _ in range(k))
    passages = [make(random.randrange(8, 90)) for _ in range(12)]
    texts = []
    for i in range(n):
        parts = [random.choice([make(random.randrange(30)), random.choice(passages), random.choice(passages)[random.randrange(9) :]]) for _ in range(random.randrange(1, 6))]
        texts.append(" ".join(parts))
        if random.random() < 0.2:
            texts.append(random.choice(texts))
        if random.random() < 0.2:
            old = random.choice(texts)
            cut = random.randrange(len(old) + 1)
            texts.append(old[:cut] + "Q" + old[cut:])
    texts += ["a" * 350, "ab" * 170, "a" * 99, "a" * 100, "xyz" * 60 + "q" + "xyz" * 60, None, "", "日本語" * 70]
    return list(enumerate(texts))


def test_matches_brute_force(spark):
    for seed in (1, 2):
        texts = corpus(seed)
        assert sorted(rows(S.dedup_substrings(documents(spark, texts)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept")) == brute(texts)


def test_small_batches_and_blocks(spark, monkeypatch):
    texts = corpus(7)
    monkeypatch.setattr(S, "TOGETHER", 40)
    monkeypatch.setattr(S, "BLOCK", 150)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        assert sorted(rows(S.dedup_substrings(documents(spark, texts, 7)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept")) == brute(texts)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_hot_digits(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT_RUNS", 2)
    texts = corpus(9)
    assert sorted(rows(S.dedup_substrings(documents(spark, texts, 5)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept")) == brute(texts)


def test_edges(spark):
    assert S.dedup_substrings(documents(spark, [])).count() == 0
    a, b = "0123456789" * 9 + "x" * 30, "".join(chr(97 + i % 26) + str(i) for i in range(90))
    out = rows(S.dedup_substrings(documents(spark, [(4, b), (4, b), (None, b), (5, None)])), "doc_id", "n_removed")
    n = len(b)
    assert out == sorted([(None, 0), (4, n), (4, n), (5, 0)], key=repr)
    out = rows(S.dedup_substrings(documents(spark, [(4, b), (4, b)])), "doc_id", "n_removed")
    assert out == [(4, 0), (4, 0)]  # rows that repeat are one document
    out = S.dedup_substrings(documents(spark, [(1, a), (1, b + b)]).selectExpr("*", "1 AS did", "2 AS start", "3 AS key", "4 AS n"), digests=True)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(r.n_removed for r in out.collect()) == [0, n]


def test_digits_depend_on_the_window_alone():
    random.seed(4)
    data = bytes(random.choice(b"abcd ") for _ in range(3000))
    whole = S.window_digits(S.digit_hashes(np.frombuffer(data, np.uint8)))
    for s in range(0, 2900, 7):
        assert S.window_digits(S.digit_hashes(np.frombuffer(data[s : s + 100], np.uint8)))[0] == whole[s] - s
