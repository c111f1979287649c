import json

import pytest
from pyspark.sql import types as T

from larkspire.engine import SearchEngine
from larkspire.plans.fields import FieldSpec, SplitSpec, TableSpec
from tests.fixtures import FIELDS, STD, frame, split, std, values


def ids(df):
    return [i for (i,) in values(df, "id")]


def test_schema_and_internal_columns(spark):
    e = std(spark)
    assert e.sql("SELECT * FROM t").columns == ["_doc_id", "_segment_ord", *(f.name for f in FIELDS), "_score", "_document"]
    assert e.collection("t").table_schema.fieldNames() == e.sql("SELECT * FROM t").columns
    assert values(e.sql("SELECT _doc_id, id FROM t"), "_doc_id", "id") == [(i, i + 1) for i in range(5)]
    two = std(spark, partitions=2).sql("SELECT _segment_ord AS s, _doc_id AS d FROM t")
    assert len(set(values(two, "s", "d"))) == 5 and {r.s for r in two.collect()} == {0, 1}


def test_parquet_places(spark, tmp_path):
    for folder in ("x/one of", "x/two+%20"):
        frame(spark, partitions=2).write.parquet(str(tmp_path / folder))
    for files in (tmp_path / "x").glob("*/part-*"):  # the same names in both folders
        files.rename(files.parent / f"part-{files.name[5:10]}.parquet")
    e = SearchEngine(spark)
    e.register("t", [SplitSpec("s", str(tmp_path / "x/*"), FIELDS)])
    got = values(e.sql("SELECT _segment_ord AS s, _doc_id AS d, id FROM t"), "s", "d", "id")
    assert sorted(i for _, _, i in got) == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5] and len({(s, d) for s, d, _ in got}) == 10 and {s for s, _, _ in got} == {0, 1, 2, 3}
    assert values(e.sql("SELECT id FROM t WHERE _segment_ord = 0 AND _doc_id BETWEEN 0 AND 0"), "id") == [(1,)]
    assert "Join" not in e.explain("SELECT id FROM t WHERE id > 1", "simple")  # numbers that nobody asks for cost nothing
    assert e.collection("t").spec().to_dict() == TableSpec.from_dict(json.loads(json.dumps(e.collection("t").spec().to_dict()))).to_dict()


def test_one_segment_of_many_files(spark, tmp_path):
    """Documents are numbered through all files of a table: F1, where each file began anew at 0."""
    for i, n in enumerate((3, 0, 4, 2)):
        spark.range(100 * i, 100 * i + n, 1, 1).write.parquet(str(tmp_path / f"w{i}"))
        (tmp_path / "t.parquet").mkdir(exist_ok=True)
        next((tmp_path / f"w{i}").glob("*.parquet")).rename(tmp_path / "t.parquet" / f"part-{i}.parquet")
    e = SearchEngine(spark)
    e.register("t", [SplitSpec("all", str(tmp_path / "t.parquet"), one_segment=True)])
    want = [(i, 0, k) for i, k in enumerate((0, 1, 2, 200, 201, 202, 203, 300, 301))]
    assert values(e.sql("SELECT _doc_id AS d, _segment_ord AS s, id FROM t"), "d", "s", "id") == want
    assert values(e.sql("SELECT id FROM t WHERE _segment_ord = 0 AND _doc_id BETWEEN 2 AND 3"), "id") == [(2,), (200,)]
    assert "Join" not in e.explain("SELECT id FROM t WHERE id > 1", "simple")
    assert TableSpec.from_dict(json.loads(json.dumps(e.collection("t").spec().to_dict()))).to_dict() == e.collection("t").spec().to_dict()
    assert TableSpec.from_dict(e.collection("t").spec().to_dict()).splits[0].one_segment


@pytest.mark.parametrize(
    "condition, wanted",
    [
        ("weight > 1.0", [2, 3, 4, 5]),
        ("id = 3", [3]),
        ("id <> 3", [1, 2, 4, 5]),
        ("3 < id", [4, 5]),
        ("height >= 10 AND height < 20", [2, 3]),
        ("tame = true", [1, 3, 5]),
        ("kind = 'otter'", [2, 4]),
        ("seen > TIMESTAMP '1970-01-01T00:00:03'", [4, 5]),
        ("host = '203.0.113.9'", [4]),
        ("mark = X'6333'", [3]),
        ("weight > 100", []),
        ("id IN (1, 5) OR kind LIKE 'o%'", [1, 2, 4, 5]),
        ("full_text(kind, 'heron')", [1, 3]),
        ("full_text('kind', 'HERON')", [1, 3]),
        ("full_text(CAST(kind AS STRING), 'otter')", [2, 4]),
        ("full_text(kind, 'heron') AND weight > 1.0", [3]),
        ("full_text(kind, 'nonexistent_term_xyz')", []),
        ("NOT full_text(kind, 'otter') AND id > 1", [3, 5]),
        ("full_text(kind, 'otter OR id:[5 TO *]')", [2, 4, 5]),
        ("full_text(kind, 'weight:{0.5 TO 4]')", [2, 3]),
        ("full_text(kind, 'tame:true -heron')", [5]),
        ("full_text(kind, '-otter')", []),
        ("full_text(kind, '')", []),
        ("full_text(kind, '* -otter')", [1, 3, 5]),
        ("full_text(kind, 'bad*')", [5]),
    ],
)
def test_filters(spark, condition, wanted):
    assert ids(std(spark).sql(f"SELECT id FROM t WHERE {condition}")) == wanted


def test_scores(spark):
    e = std(spark)
    rows = e.sql("SELECT id, _score FROM t WHERE full_text(kind, 'heron')").collect()
    assert {r.id for r in rows} == {1, 3} and all(r._score > 0 for r in rows) and abs(rows[0]._score - rows[1]._score) < 1e-5
    assert all(r._score is None for r in e.sql("SELECT id, _score FROM t").collect())
    assert all(r._score is None for r in e.sql("SELECT id, _score FROM t WHERE id = 1").collect())
    both = {r.id: r._score for r in e.sql("SELECT id, _score FROM t WHERE full_text(kind, 'heron badger^3')").collect()}
    assert both[5] > both[1] > 0
    top = e.table("t").full_text("kind", "heron badger^3").top_k(2, "id").select("id", "_score").frame().collect()
    assert [r.id for r in top] == [5, 1]
    segments = std(spark, partitions=2).sql("SELECT id, _score FROM t WHERE full_text(kind, 'heron')").collect()
    assert abs(segments[0]._score - segments[1]._score) < 1e-5
    assert values(e.sql("SELECT id FROM t WHERE full_text(kind, 'otter') AND _score > 1000"), "id") == []


def test_score_formula(spark):
    from math import log

    e = SearchEngine(spark)
    texts = ["a a b", "b c", "", None, "a"]
    e.register("t", [split(spark, "s", list(enumerate(texts)), "id long, body string", [("id", "i64"), ("body", "text", {"fast": False})])])
    got = {r.id: r._score for r in e.sql("SELECT id, _score FROM t WHERE full_text('body', 'a')").collect()}
    mean, idf = 6 / 5, log(1 + (5 - 2 + 0.5) / 2.5)
    want = {i: idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean)) for i, tf, n in ((0, 2, 3), (4, 1, 1))}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-6 for i in want)
    assert "body" not in e.sql("SELECT * FROM t").columns


def test_documents(spark):
    got = values(std(spark).sql("SELECT id, _document FROM t WHERE full_text(kind, 'heron')"), "id", "_document")
    assert [json.loads(d) for _, d in got] == [{"kind": ["heron"], "id": [1]}, {"kind": ["heron"], "id": [3]}]
    e = SearchEngine(spark)
    rows = [(1, None, ["x", "y"]), (2, "n", [])]
    e.register("t", [split(spark, "s", rows, "id long, name string, tags array<string>", [("id", "i64"), ("name", "string", {"stored": True}), ("tags", "string", {"stored": True, "multi": True})])])
    assert values(e.sql("SELECT id, _document AS d FROM t"), "id", "d") == [(1, '{"tags":["x","y"]}'), (2, '{"name":["n"]}')]


def test_deletes_and_empty(spark):
    e = std(spark, deleted="id IN (2, 4)")
    assert ids(e.sql("SELECT id FROM t WHERE full_text(kind, 'otter')")) == []
    assert values(e.sql("SELECT kind, count(*) AS n FROM t GROUP BY kind"), "kind", "n") == [("badger", 1), ("heron", 2)]
    e = std(spark, tombstones=spark.createDataFrame([(2,)], "id long"), partitions=2)
    assert ids(e.sql("SELECT id FROM t")) == [1, 3, 4, 5]
    e = std(spark, rows=[])
    assert e.sql("SELECT * FROM t").count() == 0 and e.sql("SELECT count(*) AS n FROM t").first().n == 0
    assert e.sql("SELECT id, _score FROM t WHERE full_text(kind, 'otter')").count() == 0
    e = std(spark, rows=[(77, 3, 1.25, False, "heron", 9, "192.0.2.4", b"z")])
    assert e.sql("SELECT id, _score FROM t WHERE full_text(kind, 'heron')").first()._score > 0


def test_groups(spark):
    e = std(spark)
    sql = "SELECT kind, count(*) AS n, sum(weight) AS s, avg(weight) AS a, min(weight) AS lo, max(weight) AS hi FROM t GROUP BY kind"
    assert values(e.sql(sql), "kind", "n", "s", "a", "lo", "hi") == [("badger", 1, 16.0, 16.0, 16.0, 16.0), ("heron", 2, 2.5, 1.25, 0.5, 2.0), ("otter", 2, 12.0, 6.0, 4.0, 8.0)]
    assert values(e.sql("SELECT tame, count(*) AS n FROM t GROUP BY tame"), "tame", "n") == [(False, 2), (True, 3)]
    assert values(e.sql("SELECT kind, count(*) AS n FROM t WHERE weight > 1.0 GROUP BY kind"), "kind", "n") == [("badger", 1), ("heron", 1), ("otter", 2)]
    assert values(e.sql("SELECT kind, count(*) FILTER (WHERE tame) AS n FROM t GROUP BY kind"), "kind", "n") == [("badger", 1), ("heron", 2), ("otter", 0)]
    assert values(e.sql("SELECT kind, count(DISTINCT tame) AS n FROM t GROUP BY kind"), "n") == [(1,)] * 3
    assert tuple(e.sql("SELECT count(*), sum(weight), avg(weight) FROM t").first()) == (5, 30.5, 6.1)
    e.register("twice", [SplitSpec("a", frame(spark), FIELDS), SplitSpec("b", frame(spark), FIELDS)])
    assert values(e.sql("SELECT kind, count(*) AS n FROM twice GROUP BY kind"), "kind", "n") == [("badger", 2), ("heron", 4), ("otter", 4)]
    other = split(spark, "o", [(10, 1.0), (11, 2.0)], "id long, weight double", [("id", "u64"), ("weight", "f64")])
    e.register("drift", [SplitSpec("a", frame(spark), FIELDS), other])
    got = dict(values(e.sql("SELECT kind, count(*) AS n FROM drift GROUP BY kind"), "kind", "n"))
    assert got == {"otter": 2, "badger": 1, "heron": 2, None: 2}


INT = ([(1, 4), (2, 33)], "id long, size long", [("id", "u64"), ("size", "i64")])
FLOAT = ([(3, 0.25, True), (4, 51.5, False)], "id long, size double, open boolean", [("id", "u64"), ("size", "f64"), ("open", "bool")])
MISSING = ([(7, True), (8, False)], "id long, open boolean", [("id", "u64"), ("open", "bool")])
KIND = ([(15, "otter"), (16, "heron")], "id long, kind string", [("id", "u64"), ("kind", "text", {"stored": True})])
ONE_TAG = ([(1, "red")], "id long, tags string", [("id", "u64"), ("tags", "string")])
TAGS = ([(2, ["blue", "both"]), (3, None)], "id long, tags array<string>", [("id", "u64"), ("tags", "string", {"multi": True})])


def several(spark, *parts, schema=None):
    e = SearchEngine(spark)
    e.register("t", [split(spark, f"s{i}", *p) for i, p in enumerate(parts)], schema)
    return e


def test_splits_drift(spark):
    with pytest.raises(ValueError, match="conflicting fast field types for 'size'.*provide an explicit canonical schema"):
        several(spark, INT, FLOAT)
    schema = T.StructType().add("id", T.LongType()).add("size", T.DoubleType()).add("open", T.BooleanType())
    e = several(spark, INT, FLOAT, schema=schema)
    assert values(e.sql("SELECT size, open FROM t"), "size", "open") == [(0.25, True), (33.0, None), (4.0, None), (51.5, False)]
    assert ids(several(spark, INT, MISSING).sql("SELECT id FROM t WHERE size > 20")) == [2]
    e = several(spark, ONE_TAG, TAGS)
    assert values(e.sql("SELECT id, tags FROM t"), "id", "tags") == [(1, ["red"]), (2, ["blue", "both"]), (3, [])]
    assert ids(e.sql("SELECT id FROM t WHERE full_text(tags, 'both OR red')")) == [1, 2]
    e = several(spark, TAGS, MISSING)
    assert dict(values(e.sql("SELECT id, tags FROM t"), "id", "tags"))[7] is None
    e = several(spark, KIND, MISSING)
    assert ids(e.sql("SELECT id FROM t WHERE full_text(kind, 'otter')")) == [15]
    schema = T.StructType().add("id", T.LongType()).add("nowhere", T.DoubleType())  # a field that no split has
    e = several(spark, INT, schema=schema)
    assert e.sql("SELECT id FROM t WHERE nowhere > 1").count() == 0 and ids(e.sql("SELECT id FROM t WHERE nowhere IS NULL")) == [1, 2]


def test_coercions(spark):
    string = T.StructType().add("id", T.LongType()).add("size", T.StringType())
    assert dict(values(several(spark, INT, FLOAT, schema=string).sql("SELECT id, size FROM t"), "id", "size")) == {1: "4", 2: "33", 3: "0.25", 4: "51.5"}
    narrow = T.StructType().add("id", T.ByteType())
    e = several(spark, ([(1,), (1000,)], "id long", [("id", "i64")]), schema=narrow)
    assert [r.id for r in e.sql("SELECT id FROM t").collect()] == [1, None]
    for wanted, part in ((T.LongType(), KIND), (T.BinaryType(), KIND), (T.ArrayType(T.LongType()), TAGS)):
        name = "kind" if part is KIND else "tags"
        with pytest.raises(ValueError, match=f"cannot coerce split field '{name}'"):
            several(spark, part, schema=T.StructType().add(name, wanted))


def test_kinds_that_differ(spark):
    """A field that is text in one split and a whole value in another is searched as what it is there, in any order of splits."""
    text = ([(1, "red fox"), (2, "grey")], "id long, body string", [("id", "i64"), ("body", "text")])
    value = ([(3, "red fox"), (4, "red")], "id long, body string", [("id", "i64"), ("body", "string")])
    for parts in ((text, value), (value, text)):
        e = several(spark, *parts)
        assert ids(e.sql("SELECT id FROM t WHERE full_text(body, 'red')")) == [1, 4]
        assert ids(e.sql("""SELECT id FROM t WHERE full_text(body, '"red fox"')""")) == [1, 3]
        assert ids(e.sql("SELECT id FROM t WHERE full_text(body, '* -red')")) == [2, 3]
        assert all(r._score > 0 for r in e.sql("SELECT _score FROM t WHERE full_text(body, 'red')").collect())
    e = several(spark, text, ([(5, 7), (6, 8)], "id long, body long", [("id", "i64"), ("body", "i64", {"fast": False})]))
    assert ids(e.sql("SELECT id FROM t WHERE full_text(body, 'red OR 7')")) == [1, 5]


def test_errors(spark):
    e = std(spark)
    for sql, message in (
        ("SELECT id FROM t WHERE full_text(nothing, 'x')", "full_text: field 'nothing' not found in any split"),
        ("SELECT id FROM t WHERE full_text(kind, '(x')", "full_text: failed to parse"),
        ("SELECT id FROM t WHERE full_text(kind, kind)", "string literal"),
        ("SELECT id FROM t WHERE full_text(kind, 'nothing:x')", "field 'nothing' not found in any split"),
    ):
        with pytest.raises(ValueError, match=message.replace("(", r"\(")):
            e.sql(sql)
    with pytest.raises(ValueError, match="at least one local split"):
        e.register("none", [])
    with pytest.raises(ValueError, match="single top-level aggregation"):
        e.aggregate("t", {"a": {"avg": {"field": "weight"}}, "b": {"avg": {"field": "weight"}}})
    with pytest.raises(ValueError, match="unsupported bucket type"):
        e.aggregate("t", {"a": {"geo": {"field": "weight"}}})
    with pytest.raises(ValueError, match="unknown field kind"):
        FieldSpec("x", "json")


def test_sql_blocks(spark):
    e = std(spark)
    e.register("u", [SplitSpec("s", frame(spark, STD[:3]), FIELDS)])
    sql = """SELECT x.id, y.n -- full_text(kind, 'no')
    FROM t AS x JOIN (SELECT kind, count(*) AS n FROM u WHERE full_text(kind, 'heron') GROUP BY kind) y ON x.kind = y.kind
    WHERE full_text(x.kind, 'heron otter') AND x.id > 1"""
    assert values(e.sql(sql), "id", "n") == [(3, 2)]
    assert ids(e.sql("SELECT id FROM t WHERE full_text(kind, 'otter') UNION ALL SELECT id FROM u WHERE full_text(kind, 'heron')")) == [1, 2, 3, 4]
    assert ids(e.sql("WITH c AS (SELECT id FROM t WHERE full_text(kind, 'it''s OR otter')) SELECT id FROM c WHERE id > 2")) == [4]
    assert ids(e.sql("SELECT a.id FROM t a, u b WHERE a.id = b.id AND full_text(b.kind, 'otter')")) == [2]
    with pytest.raises(ValueError, match="belongs to several tables"):
        e.sql("SELECT a.id FROM t a JOIN u b ON a.id = b.id WHERE full_text(kind, 'otter')")


def test_stars(spark):
    e = std(spark)
    found = e.sql("SELECT * FROM t WHERE full_text(kind, 'otter')")
    assert found.columns == e.sql("SELECT * FROM t").columns and all(r._score > 0 for r in found.collect())
    ranked = e.sql("WITH c AS (SELECT * FROM t WHERE full_text(kind, 'otter badger^3')) SELECT id, _score FROM c ORDER BY _score DESC, id").collect()
    assert [r.id for r in ranked] == [5, 2, 4] and ranked[0]._score > ranked[1]._score > 0
    both = e.sql("SELECT a.*, b.id AS other FROM t a JOIN t AS b ON a.id = b.id AND full_text(a.kind, 'heron') WHERE full_text(b.kind, 'heron')")
    assert both.columns == [*e.sql("SELECT * FROM t").columns, "other"] and ids(both) == [1, 3]
    assert e.sql("SELECT count(*) AS n, sum(2 * height) AS s FROM t WHERE full_text(kind, 'heron')").first()[:] == (2, 42)
    assert "_score" not in e.explain("SELECT id FROM t WHERE full_text(kind, 'heron')", "simple")


def test_names_of_ctes(spark):
    e = std(spark)
    assert e.sql("WITH t AS (SELECT 77 AS id) SELECT id FROM t").first().id == 77
    assert ids(e.sql("WITH a AS (SELECT id FROM t), t AS (SELECT id + 10 AS id FROM a) SELECT id FROM t")) == [11, 12, 13, 14, 15]
    assert ids(e.sql("SELECT id FROM t WHERE id IN (WITH t AS (SELECT 3 AS id) SELECT id FROM t)")) == [3]
    assert ids(e.sql("WITH c (id, b) AS (SELECT id, kind FROM t) SELECT id FROM c WHERE b = 'heron'")) == [1, 3]
    e.register("seen", [SplitSpec("s", frame(spark), FIELDS)])
    assert e.sql("SELECT extract(YEAR FROM seen) AS y, trim(BOTH 'h' FROM kind) AS k FROM t WHERE kind IS DISTINCT FROM 'otter' ORDER BY id").collect()[0][:] == (1970, "eron")
    assert e.sql("SELECT id FROM t WHERE weight IS NOT DISTINCT FROM height").count() == 0


def test_full_text_on_subqueries(spark):
    e = std(spark)
    assert ids(e.sql("SELECT id FROM (SELECT * FROM t WHERE id > 1) x WHERE full_text(kind, 'heron')")) == [3]
    assert ids(e.sql("WITH c AS (SELECT id, kind FROM t WHERE id < 5) SELECT id FROM c WHERE full_text(c.kind, 'otter badger')")) == [2, 4]
    rows = e.sql("WITH c AS (SELECT * FROM t) SELECT * FROM (SELECT * FROM c) d WHERE full_text(kind, 'badger')")
    assert rows.columns == e.sql("SELECT * FROM t").columns and [(r.id, r._score > 0) for r in rows.collect()] == [(5, True)]
    inside = "SELECT id FROM t d WHERE EXISTS (SELECT 1 FROM (VALUES (1), (4)) AS v(x) WHERE v.x = d.id AND full_text(d.kind, 'otter'))"
    assert ids(e.sql(inside)) == [4]
    for sql, message in (
        ("SELECT * FROM (SELECT kind, count(*) AS n FROM t GROUP BY kind) x WHERE full_text(kind, 'heron')", "outside of GROUP BY"),
        ("SELECT * FROM (SELECT DISTINCT kind FROM t) x WHERE full_text(kind, 'heron')", "outside of DISTINCT"),
        ("SELECT * FROM (SELECT * FROM t UNION ALL SELECT * FROM t) x WHERE full_text(kind, 'heron')", "outside of a set operation"),
        ("WITH c AS (SELECT * FROM t) SELECT a.id FROM c a JOIN c b ON a.id = b.id WHERE full_text(a.kind, 'heron')", "used several times"),
    ):
        with pytest.raises(ValueError, match=message):
            e.sql(sql)


def test_views(spark):
    e, before = std(spark), {t.name for t in spark.catalog.listTables()}
    e.sql("SELECT id, _score FROM t WHERE full_text(kind, 'heron')").collect()
    assert {t.name for t in spark.catalog.listTables()} == before  # a query leaves no view
    spark.range(3).createOrReplaceTempView("own_view")
    with pytest.warns(UserWarning, match="'own_view' stands before"):
        std(spark, name="own_view")


def test_long_words(spark):
    """A word of more than 40 bytes is none: it isn't found, and doesn't make its text longer."""
    e, long = SearchEngine(spark), "x" * 41
    e.register("t", [split(spark, "s", [(1, f"a {long}"), (2, "a"), (3, f"{long[:40]} b")], "id long, body string", [("id", "i64"), ("body", "text")])])
    score = {r.id: r._score for r in e.sql("SELECT id, _score FROM t WHERE full_text(body, 'a')").collect()}
    assert score[1] == score[2]
    assert ids(e.sql(f"SELECT id FROM t WHERE full_text(body, '{long}')")) == [] and ids(e.sql(f"SELECT id FROM t WHERE full_text(body, '{long[:40]}')")) == [3]


def test_observed(spark):
    df, seen = std(spark).observed("SELECT id FROM t WHERE full_text(kind, 'otter')")
    df.collect()
    assert seen.get == {"output_rows": 2}


def test_typed_filters(spark):
    from datetime import datetime

    from larkspire.plans.filters import typed

    search = std(spark).table("t").select("id")
    cases = [(typed("height", "gte", 14), [2, 3, 4, 5]), (typed("weight", "lt", 2.5), [1, 3]), (typed("weight", "eq", 8), [4]), (typed("tame", "eq", True), [1, 3, 5]), (typed("kind", "neq", "otter"), [1, 3, 5])]
    cases += [(typed("mark", "eq", b"c3"), [3]), (typed("seen", "gt", datetime(1970, 1, 1, 0, 0, 3)), [4, 5]), (typed("seen", "lte", 2000, "ts_ms"), [1, 2]), (typed("seen", "gt", 4 * 10**9, "ts_ns:UTC"), [5])]
    cases += [(typed("host", "eq", "::ffff:203.0.113.9", "ip"), [4]), (typed("id", "eq", 2**64 - 1), []), (typed("id", "gt", 3, "u8"), [4, 5])]
    for filter_, wanted in cases:
        made = json.loads(json.dumps(filter_, sort_keys=True))
        assert made == filter_ and ids(search.where(made).frame()) == wanted, filter_
    for bad in ({"field": "id"}, {"field": "id", "op": "like", "value": 1, "value_type": "i64"}, {"field": "id", "op": "eq", "value": 300, "value_type": "u8"}, {"field": "id", "op": "eq", "value": "x", "value_type": "blob"}):
        with pytest.raises(ValueError):
            search.where(bad)


def test_plans(spark):
    e = std(spark)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    grouped = plan(e.sql("SELECT kind, count(*) FROM t WHERE full_text(kind, 'otter') GROUP BY kind"))
    assert "partial_count" in grouped and "Python" not in grouped and "Join" not in grouped
    assert "TakeOrderedAndProject" in plan(e.table("t").full_text("kind", "otter").top_k(3, "id").frame())
    unscored = plan(e.sql("SELECT id FROM t WHERE full_text(kind, 'otter')"))
    assert "to_json" not in unscored and "regexp_replace" in unscored
    facts = e.table("t").full_text("kind", "otter").where("id > 1").select("id", "_score").top_k(3).describe()
    assert facts["needs_score"] and not facts["needs_document"] and facts["topk"] == 3 and facts["partitions"] == 1


def test_pushdown(spark, tmp_path):
    frame(spark).write.parquet(str(tmp_path / "x"))
    e = SearchEngine(spark)
    e.register("t", [str(tmp_path / "x")], fields=list(FIELDS))
    text = e.sql("SELECT id FROM t WHERE weight > 1.0 AND full_text(kind, 'otter')")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(weight,1.0)" in text and "ReadSchema: struct<id:bigint,weight:double,kind:string" in text


def test_materialized(spark):
    e = std(spark)
    sql = "SELECT id, _score FROM t WHERE full_text(kind, 'otter OR badger')"
    before = values(e.sql(sql), "id", "_score")
    e.materialize("t")
    assert values(e.sql(sql), "id", "_score") == before
    e.collection("t").release()
    assert values(e.sql(sql), "id", "_score") == before


def test_queries_written_down(spark, tmp_path):
    frame(spark).write.parquet(str(tmp_path / "x"))
    e = SearchEngine(spark)
    e.register("t", [SplitSpec("s", str(tmp_path / "x"), FIELDS, deleted="id = 4")])
    search = e.table("t").full_text("kind", "otter").where("id > 1").select("id", "_score").top_k(5, "id").limit(3)
    text = json.dumps(search.to_dict(), sort_keys=True)
    again = SearchEngine(spark).search(json.loads(text))
    assert json.dumps(again.to_dict(), sort_keys=True) == text
    assert values(again.frame(), "id", "_score") == values(search.frame(), "id", "_score") and ids(again.frame()) == [2]
    with pytest.raises(ValueError, match="written down"):
        e.table("t").where(spark.range(1).id > 1).to_dict()


def test_engines_of_one_session(spark):
    a, b = std(spark), std(spark, rows=STD[:2])
    assert a.sql("SELECT id FROM t").count() == 5 and b.sql("SELECT id FROM t").count() == 2
    a.materialize("t")
    assert b.sql("SELECT id FROM t").count() == 2 and "InMemoryTableScan" in a.explain("SELECT id FROM t")
    a.release("t")
    assert "InMemoryTableScan" not in a.explain("SELECT id FROM t") and ids(a.sql("SELECT id FROM t")) == [1, 2, 3, 4, 5]


def test_explain(spark):
    said = std(spark).explain("SELECT id FROM t WHERE full_text(kind, 'otter') AND _score > 0")
    assert "Filter" in said and said.startswith("SearchScan t: splits=1, query=[('kind', 'otter')], score=True, index=None")
