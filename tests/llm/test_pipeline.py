import random

import public_tokenizers
import tokenizers

import corpus_pipeline
from larkspire.llm.toxicity import score_toxicity, train, training_rows
from tests.llm import test_decontaminate, test_line_dedup, test_minhash_dedup
from tests.llm.helpers import DOCS


def write_tables(spark, folder):
    random.seed(12)
    words = [f"{a}{b}" for a in "the of ing er an thor wh".split() for b in ["", "a", "ly", "es", "ti"]]
    make = lambda n: " ".join(random.choice(words) + (random.choice(",.") if random.random() < 0.1 else "") for _ in range(n))
    bench = [(i, make(25)) for i in range(5)]
    texts = [make(random.randrange(1, 120)) for _ in range(150)]
    texts += [f"{make(30)} {t} {make(10)}" for _, t in bench]
    texts += [t + " more" for t in texts[:20]] + texts[:10]
    texts += [f"{make(20)}\nA very common line\n{make(20)}" for _ in range(14)]
    texts += [None, "", "zonk"]
    toxic = [random.random() < 0.25 for _ in texts]
    texts = [f"zonk {t} blarg zonk" if bad and t else t for t, bad in zip(texts, toxic)]
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(b)) for i, b in enumerate(toxic)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return bench


def test_stages_match_plain_versions(spark, tmp_path):
    folder = str(tmp_path)
    bench = write_tables(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = train(training_rows(docs), training_rows(spark.read.parquet(f"{folder}/labels.parquet")))
    keep = {r.doc_id for r in score_toxicity(docs, model).where("predicted = 0").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in keep]
    assert 0 < len(rows) < docs.count()
    rows = [(i, t) for i, _, _, t in test_line_dedup.brute(rows, 10, keep_first=True)]
    kept = {i for i, _, _, k in test_minhash_dedup.brute(rows) if k}
    rows = [(i, t) for i, t in rows if i in kept]
    leaked = {d for d, *_ in test_decontaminate.brute(rows, bench)}
    assert leaked
    rows = [(i, t) for i, t in rows if i not in leaked]
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((i, tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in rows)
    assert sorted((r.doc_id, list(r.ids)) for r in corpus_pipeline.run(spark, folder).collect()) == want


def test_columns_pass_through(spark, tmp_path):
    write_tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes], name
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in corpus_pipeline.drop_repeated_lines(spark, docs, str(tmp_path)).collect())


def test_empty_tables_and_odd_rows(spark, tmp_path):
    """Empty documents, labels or benchmark, null ids and texts, repeated rows and further columns go through all stages."""
    write_tables(spark, str(tmp_path / "full"))
    empty = {"documents": DOCS, "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}
    docs = spark.read.parquet(f"{tmp_path}/full/documents.parquet").where("doc_id < 40").selectExpr("*", "1 AS score", "2 AS n_lines", "3 AS kept", "4 AS dk", "5 AS component")
    odd = docs.where("doc_id < 3").union(docs.where("doc_id < 3")).union(docs.where("doc_id < 2").selectExpr("CAST(NULL AS LONG)", *docs.columns[1:])).union(docs.where("doc_id < 2").selectExpr("doc_id + 900", "CAST(NULL AS STRING)", *docs.columns[2:]))
    for missing in ("labels", "benchmark", "documents"):
        folder = f"{tmp_path}/{missing}"
        for name, schema in empty.items():
            df = spark.createDataFrame([], schema) if name == missing else odd if name == "documents" else spark.read.parquet(f"{tmp_path}/full/{name}.parquet")
            df.write.parquet(f"{folder}/{name}.parquet")
        got = [r.doc_id for r in corpus_pipeline.run(spark, folder).collect()]
        if missing == "documents":
            assert got == []
        else:
            assert {900, 901} <= set(got) and (missing == "benchmark" or None in got)
