import re
from collections import Counter

import pytest

from larkspire.engine import SearchEngine
from larkspire.operators import collection
from larkspire.plans.fields import FieldSpec, SplitSpec
from larkspire.sources import index
from tests.fixtures import values

FIELDS = (FieldSpec("id", "i64", stored=True), FieldSpec("body", "text", fast=False), FieldSpec("title", "text"), FieldSpec("lang", "string"), FieldSpec("n", "i64"))
WORDS = "ash birch cedar elm fir hazel larch maple oak pine rowan yew".split()


def rows(n, start=0):
    out = []
    for i in range(start, start + n):
        body = " ".join(WORDS[(i * k + k * k) % len(WORDS)] for k in range(1, 3 + i % 7))
        out.append((i, None if i % 11 == 5 else body, f"the {WORDS[i % 5]}, {WORDS[i % 3]}!", "de" if i % 4 else "en", i % 9))
    return out


@pytest.fixture()
def folder(spark, tmp_path):
    spark.createDataFrame(rows(60), "id long, body string, title string, lang string, n long").repartition(3).write.parquet(str(tmp_path / "a"))
    spark.createDataFrame(rows(30, 60), "id long, body string, title string, lang string, n long").repartition(2).write.parquet(str(tmp_path / "b"))
    return tmp_path


def engine(spark, folder, **more):
    e = SearchEngine(spark)
    e.register("t", [SplitSpec("a", str(folder / "a"), FIELDS, **more), SplitSpec("b", str(folder / "b"), FIELDS)])
    return e


QUERIES = [
    "SELECT id, _score FROM t WHERE full_text(body, 'oak')",
    "SELECT id, _score FROM t WHERE full_text(body, 'oak OR elm^2') AND n > 2",
    "SELECT id, _score FROM t WHERE full_text(body, '+oak -elm')",
    "SELECT id, _score FROM t WHERE full_text(body, 'oak AND lang:de')",
    "SELECT id, _score FROM t WHERE full_text(body, 'oak AND n:[2 TO 5] title:ash')",
    "SELECT id, _score FROM t WHERE full_text(body, '\"oak ash\" OR yew')",
    "SELECT id, _score FROM t WHERE full_text(body, '\"oak fir\"~2')",
    "SELECT id, _score FROM t WHERE full_text(body, 'ma* OR \"oak a\"*')",
    "SELECT id, _score FROM t WHERE full_text(body, 'oak') AND full_text(title, 'birch') AND full_text(lang, 'de')",
    "SELECT id, full_text(body, 'oak') AS _score FROM t WHERE full_text(title, 'ash') OR n = 3",
    "SELECT id, _score FROM t WHERE NOT full_text(body, 'oak') AND n < 3",
    "SELECT id, _score FROM t WHERE full_text(body, '* -oak')",
    "SELECT id, _score FROM t WHERE full_text(body, 'nothing')",
    "SELECT id, _score FROM t WHERE full_text(lang, 'en')",
    "SELECT * FROM t WHERE full_text(title, 'cedar') ORDER BY _score DESC, id LIMIT 7",
]


def shown(df):
    return sorted((r.id, None if r._score is None else round(float(r._score), 5)) for r in df.collect())


def test_index_tells_the_same(spark, folder):
    plain = engine(spark, folder, deleted="id % 13 = 0")
    want = [shown(plain.sql(q)) for q in QUERIES]
    assert sum(map(bool, want)) > 11
    e = engine(spark, folder, deleted="id % 13 = 0")
    e.build_index("t", str(folder / "index"))
    assert [shown(e.sql(q)) for q in QUERIES] == want
    again = engine(spark, folder, deleted="id % 13 = 0")
    again.use_index("t", str(folder / "index"))  # another session would do so
    assert [shown(again.sql(q)) for q in QUERIES[:3]] == want[:3]
    assert shown(again.table("t").full_text("body", "oak").top_k(4, "id").select("id", "_score").frame()) == shown(plain.table("t").full_text("body", "oak").top_k(4, "id").select("id", "_score").frame())
    request = {"l": {"terms": {"field": "lang"}}}
    assert values(again.aggregate("t", request, {"body": "oak"}), "lang", "doc_count") == values(plain.aggregate("t", request, {"body": "oak"}), "lang", "doc_count")


def test_plan(spark, folder):
    e = engine(spark, folder)
    e.build_index("t", str(folder / "index"))
    plan = e.sql("SELECT id, _score FROM t WHERE full_text(body, 'oak elm')")._jdf.queryExecution().executedPlan().toString()
    assert "In(term, [elm,oak])" in plan and "body:string" not in plan  # no text is read
    assert re.search(r"PartitionFilters: \[[^\]]*field", plan)
    assert "LeftOuter" not in plan and "Python" not in plan
    phrase = e.sql("SELECT id FROM t WHERE full_text(body, '\"oak elm\"')")._jdf.queryExecution().executedPlan().toString()
    assert "body:string" in phrase and "In(term, [elm,oak])" in phrase


def test_postings(spark, folder, monkeypatch):
    """Every word of every document once, with its count; F2 to F9: dealt out once, to as many tasks as their number needs."""
    monkeypatch.setattr(index, "WORDS_PER_TASK", 40)
    e = engine(spark, folder)
    e.build_index("t", str(folder / "index"))
    postings = spark.read.parquet(str(folder / "index" / "postings"))
    want = Counter()
    for i, body, title, *_ in rows(60) + rows(30, 60):
        for field, text in (("body", body), ("title", title)):
            words = re.findall("[a-z]+", text or "")
            want.update((field, w, n, len(words)) for w, n in Counter(words).items())
    assert Counter((r.field, r.term, r.tf, r.length) for r in postings.collect()) == want
    assert any(tf > 1 for _, _, tf, _ in want) and len(postings.inputFiles()) > 10
    assert e.collection("t").index.mean_words["title"] == 3 and e.collection("t").index.documents == 90


def test_numbers_of_files_are_broadcast(spark, folder):
    """F7 and the index: the table of files meets the texts where they are, and doesn't deal whole files to tasks."""
    for one in (False, True):
        e = SearchEngine(spark)
        e.register("t", [SplitSpec("a", str(folder / "a"), FIELDS, one_segment=one)])
        plan = e.sql("SELECT _segment_ord, _doc_id, title FROM t")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_kept_table_in_pieces(spark, folder, monkeypatch):
    """pieces of a kept table don't grow with its files; small tables stay as they are read."""
    plain = engine(spark, folder)
    want = shown(plain.sql(QUERIES[5]))
    few = plain.materialize("t").rdd.getNumPartitions()
    plain.release("t")
    monkeypatch.setattr(collection, "PIECE_BYTES", 500)
    e = engine(spark, folder)
    assert e.materialize("t").rdd.getNumPartitions() > max(few, 10) and shown(e.sql(QUERIES[5])) == want
    e.release("t")


def test_index_of_other_files_is_refused(spark, folder):
    e = engine(spark, folder)
    e.build_index("t", str(folder / "index"))
    with pytest.raises(ValueError, match="build it anew"):
        engine(spark, folder, deleted="id = 1").use_index("t", str(folder / "index"))
    spark.createDataFrame(rows(3, 90), "id long, body string, title string, lang string, n long").write.mode("append").parquet(str(folder / "b"))
    with pytest.raises(ValueError, match="build it anew"):
        engine(spark, folder).use_index("t", str(folder / "index"))
    before = e.sql("SELECT id FROM t").count()
    e.refresh("t")
    assert e.sql("SELECT id FROM t").count() == before + 3 and e.collection("t").index is None
    e.build_index("t", str(folder / "index"))
    assert e.sql("SELECT id FROM t WHERE full_text(body, 'oak')").count() == engine(spark, folder).sql("SELECT id FROM t WHERE full_text(body, 'oak')").count()


def test_what_cannot_be_indexed(spark, folder):
    e = SearchEngine(spark)
    e.register("t", [SplitSpec("a", spark.read.parquet(str(folder / "a")), FIELDS)])
    with pytest.raises(ValueError, match="described by a path alone"):
        e.build_index("t", str(folder / "index"))
    e.register("u", [SplitSpec("a", str(folder / "a"), (FieldSpec("id", "i64"), FieldSpec("lang", "string")))])
    with pytest.raises(ValueError, match="no text field"):
        e.build_index("u", str(folder / "index"))
