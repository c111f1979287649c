import pytest

from larkspire.engine import SearchEngine
from tests.fixtures import split, std, values

ROWS = [(1, 5.0, "a", ["x", "y"]), (2, 15.0, "a", ["x"]), (3, 25.0, "b", []), (4, None, None, None), (5, 15.0, "b", ["y", "y"]), (6, float("nan"), "c", ["z"])]


@pytest.fixture(scope="module")
def engine(spark):
    e = SearchEngine(spark)
    e.register("t", [split(spark, "s", ROWS, "id long, v double, k string, tags array<string>", [("id", "i64"), ("v", "f64"), ("k", "string"), ("tags", "string", {"multi": True})])])
    return e


def test_terms(engine):
    run = lambda spec, **aggs: [tuple(r) for r in engine.aggregate("t", {"x": {"terms": spec, "aggs": aggs}}).collect()]
    assert run({"field": "k"}) == [("a", 2), ("b", 2), ("c", 1)]
    assert run({"field": "k", "size": 1}) == [("a", 2)]
    assert run({"field": "k", "missing": "none", "order": {"_key": "desc"}}) == [("none", 1), ("c", 1), ("b", 2), ("a", 2)]
    assert run({"field": "k", "min_doc_count": 2, "order": {"m": "desc"}}, m={"max": {"field": "v"}}) == [("b", 2, 25.0), ("a", 2, 15.0)]
    assert run({"field": "tags"}) == [("x", 2), ("y", 2), ("z", 1)]
    assert run({"field": "k", "size": 2}, n={"terms": {"field": "tags"}})[0] == ("a", 2, None)


def test_histogram(engine):
    run = lambda spec: values(engine.aggregate("t", {"x": {"histogram": spec}}), "bucket", "doc_count")
    assert run({"field": "v", "interval": 10}) == [(0.0, 1), (10.0, 2), (20.0, 1)]
    assert run({"field": "v", "interval": 5, "offset": 2, "min_doc_count": 0}) == [(12.0, 2), (17.0, 0), (2.0, 1), (22.0, 1), (7.0, 0)]
    assert run({"field": "v", "interval": 10, "hard_bounds": {"min": 10, "max": 20}}) == [(10.0, 2)]
    with pytest.raises(ValueError, match="positive interval"):
        run({"field": "v", "interval": 0})


def test_ranges(engine):
    spec = {"field": "v", "ranges": [{"to": 10}, {"from": 10, "to": 20}, {"from": 12.5}, {"from": 90, "key": "far"}]}
    got = [tuple(r) for r in engine.aggregate("t", {"x": {"range": spec, "aggs": {"s": {"sum": {"field": "id"}}}}}).collect()]
    assert got == [("*-10", 1, 1), ("10-20", 2, 7), ("12.5-*", 4, 16), ("far", 1, 6)]  # NaN is above every number


def test_metrics(engine, spark):
    first = lambda body: engine.aggregate("t", {"m": body}, filters="NOT isnan(v)").first().asDict()
    assert first({"stats": {"field": "v"}}) == {"m_min": 5.0, "m_max": 25.0, "m_sum": 60.0, "m_count": 4, "m_avg": 15.0}
    assert first({"extended_stats": {"field": "v"}})["m_variance_population"] == 50.0
    assert first({"percentiles": {"field": "v", "percents": [50, 99.5], "exact": True}}).keys() == {"m_p50", "m_p99.5"}
    assert first({"cardinality": {"field": "k", "exact": True}}) == {"m": 2}
    assert first({"value_count": {"field": "tags"}}) == {"m": 5}
    assert engine.aggregate("t", {"m": {"percentiles": {"field": "v", "percents": [100]}}}).first()[0] == 25.0  # NaN doesn't count
    with pytest.raises(ValueError, match="aggregation field 'q' not found"):
        first({"avg": {"field": "q"}})


def test_dates(spark):
    e = std(spark)
    got = values(e.aggregate("t", {"x": {"date_histogram": {"field": "seen", "fixed_interval": "2s"}, "aggs": {"p": {"percentiles": {"field": "weight", "percents": [50], "exact": True}}}}}), "bucket", "doc_count", "p_p50")
    assert got == [(0.0, 1, 0.5), (2000.0, 2, 3.0), (4000.0, 2, 12.0)]
    got = values(e.aggregate("t", {"x": {"terms": {"field": "kind"}}}, full_text={"kind": "otter badger"}, filters=["id > 2"]), "kind", "doc_count")
    assert got == [("badger", 1), ("otter", 1)]


def test_several_values(spark):
    """Every value counts in a metric; a document counts once in each bucket."""
    e, rows = SearchEngine(spark), [(1, [1.0, 5.0], ["x", "y"], 10), (2, [2.0, 2.5, None], ["x"], 20), (3, [], [], 30), (4, None, ["z"], 40), (5, [12.0, 13.0], None, 50)]
    e.register("t", [split(spark, "s", rows, "id long, v array<double>, tags array<string>, n long", [("id", "i64"), ("v", "f64", {"multi": True}), ("tags", "string", {"multi": True}), ("n", "i64")])])
    one = lambda body: e.aggregate("t", {"m": body}).first().asDict()
    assert one({"stats": {"field": "v"}}) == {"m_min": 1.0, "m_max": 13.0, "m_sum": 35.5, "m_count": 6, "m_avg": 35.5 / 6}
    assert one({"cardinality": {"field": "tags", "exact": True}}) == {"m": 3}
    assert one({"percentiles": {"field": "v", "percents": [50], "exact": True}}) == {"m_p50": 3.75}
    made = {"h": {"histogram": {"field": "v", "interval": 2}, "aggs": {"s": {"sum": {"field": "n"}}, "t": {"value_count": {"field": "tags"}}, "top": {"max": {"field": "v"}}}}}
    assert values(e.aggregate("t", made), "bucket", "doc_count", "s", "t", "top") == [(0.0, 1, 10, 2, 5.0), (12.0, 1, 50, 0, 13.0), (2.0, 1, 20, 1, 2.5), (4.0, 1, 10, 2, 5.0)]
    made = {"r": {"range": {"field": "v", "ranges": [{"to": 3}, {"from": 2, "to": 13}]}, "aggs": {"n": {"stats": {"field": "n"}}}}}
    assert values(e.aggregate("t", made), "bucket", "doc_count", "n_sum") == [("*-3", 2, 30), ("2-13", 3, 80)]
    made = {"t": {"terms": {"field": "tags", "missing": "none"}, "aggs": {"s": {"sum": {"field": "v"}}}}}
    assert values(e.aggregate("t", made), "tags", "doc_count", "s") == [("none", 2, 25.0), ("x", 2, 10.5), ("y", 1, 6.0), ("z", 1, None)]


def test_bad_requests(engine):
    for body in ({"terms": {}}, {"histogram": {"field": "v"}}, {"date_histogram": {"field": "v"}}, {"range": {"field": "v"}}, {"avg": {}}, {"terms": "k"}):
        with pytest.raises(ValueError):
            engine.aggregate("t", {"x": body})
