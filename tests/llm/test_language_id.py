import random
import zlib

import numpy as np

from larkspire.llm import language_id as L
from larkspire.llm.sampling import stratified
from tests.llm.helpers import DOCS

WORDS = {"en": "the of and thing there with when other".split(), "fr": "les des été où avec pour quand être".split(), "de": "der und über nicht schön wenn mit für".split()}


def corpus(n=400, seed=1):
    random.seed(seed)
    out = []
    for i in range(n):
        lang = random.choice(sorted(WORDS))
        out.append((i, " ".join(random.choice(WORDS[lang]) + random.choice(["", "s", "en", "er"]) for _ in range(random.randrange(3, 40))), lang))
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", 0) for i, t, g in rows], DOCS).repartition(3)


def test_held_out_accuracy(spark):
    rows = corpus() + [(1001, None, "en"), (1002, "", "en"), (1003, "12 34 !!", "fr"), (1004, "été", None), (None, "the other thing", "en")]
    got = L.identify_held_out(table(spark, rows), per_language=60).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    apart = [(by[i], g) for i, _, g in rows if i is not None and i < 1000 and by[i].held_out]
    assert len(apart) > 50 and np.mean([r.lang_pred == g for r, g in apart]) > 0.97
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1001, 1002, 1003)) and by[1004].lang_pred == "fr" and by[None].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got)


def test_repeats_clashing_columns_and_long_texts(spark):
    rows = corpus(150)
    long = " ".join(t for _, t, g in rows if g == "de") * 60
    more = [(2000, long, "de"), (2000, long, "de"), (2001, rows[0][1], None), (0, rows[0][1], rows[0][2])]
    docs = table(spark, rows + more).selectExpr("*", "1 AS score", "2 AS held_out", "3 AS lang_pred", "4 AS at", "5 AS counts")
    got = sorted((r.doc_id, r.lang_pred, r.score) for r in L.identify_held_out(docs).collect())
    assert len(got) == 154 and got[-2] == got[-3] and got[-2][:2] == (2000, "de")
    assert got[0] == got[1] and got[-1][1:] == got[0][1:]


def test_only_training_rows_teach(spark):
    rows = [(i, "abc def", "en") for i in range(40)]
    rows = [(i, t, g if zlib.crc32(str(i).encode()) % 5 else "secret") for i, t, g in rows]
    got = L.identify_held_out(table(spark, rows)).collect()
    assert {r.lang_pred for r in got} == {"en"}


def test_nothing_to_learn(spark):
    assert L.identify_held_out(table(spark, [])).count() == 0
    got = L.identify_held_out(table(spark, [(1, "the", None), (2, None, None)])).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}


def test_document_frequencies_match_brute_force(spark):
    texts = [t for _, t, _ in corpus(60)] + [None, ""]
    found, n = L.document_frequencies(spark.createDataFrame([(t,) for t in texts], "text string").repartition(4))
    want = np.zeros(L.BUCKETS, int)
    for t in texts:
        if t:
            want[L.ngram_counts(t)[0]] += 1
    assert n == 60 and (found == want).all()


def test_penalty_makes_weights_sparse():
    random.seed(1)
    idf = np.ones(L.BUCKETS)
    rows = [L.features(*L.ngram_counts(t), idf) for _, t, _ in corpus(200)]
    labels = np.array([sorted(WORDS).index(g) for _, _, g in corpus(200)])
    kept = [np.count_nonzero(L.fit_ftrl(rows, labels, 3, l1=l1)) for l1 in (0.0, 0.05, 0.5)]
    assert kept[0] > kept[1] > kept[2]


def test_temperature_calibrates():
    random = np.random.default_rng(3)
    logits = random.normal(size=(4000, 3))
    p = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    labels = np.array([random.choice(3, p=x) for x in p])
    assert abs(L.fit_temperature(logits * 4, labels) - 4) < 0.6


def test_sample_is_bounded_and_stratified(spark):
    rows = spark.range(20_000).selectExpr("id", "CASE WHEN id % 100 = 0 THEN 'rare' WHEN id % 7 = 0 THEN NULL ELSE 'often' END AS label")
    chosen, counts = stratified(rows, "label", "id", 500)
    got = {r["label"]: r["n"] for r in chosen.groupBy("label").count().withColumnRenamed("count", "n").collect()}
    assert got["rare"] == 200 == counts["rare"] and 400 < got["often"] < 600


def test_every_language_is_learned(spark):
    word = lambda i: "".join(chr(0x4E00 + 5 * i + k) for k in range(5))
    rows = [(210 * k + i, f"{word(i)} {word(i)}", f"l{i:03}") for i in range(210) for k in range(9 if i == 209 else 10)]
    model = L.train(table(spark, rows))
    assert model.languages == [f"l{i:03}" for i in range(210)]
    wrong = {i for i in range(210) if model.predict(f"{word(i)} {word(i)}")[0] != f"l{i:03}"}
    assert 209 not in wrong and len(wrong) < 5, wrong


def test_sample_of_many_classes_is_bounded(spark):
    rows = spark.range(30_000).selectExpr("id", "concat('c', id % 30) AS label")
    chosen, counts = stratified(rows, "label", "id", 200, classes=10)
    got = {r["label"]: r["n"] for r in chosen.groupBy("label").count().withColumnRenamed("count", "n").collect()}
    assert len(counts) == len(got) == 30 and 1500 < sum(got.values()) < 2500
