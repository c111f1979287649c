import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larkspire.functions.analysis import words_of
from larkspire.functions.querylang import Group, Term, leaves, parse
from larkspire.plans.sqlrewrite import find_full_text_calls
from tests.fixtures import split, values

TEXTS = ["of the of the a", "The, of: THE!", "aile's aich", "", None, "a a a b", "b-a c d e a", "été ÉTÉ 12 12a", "of x the", "of x y the"]


def test_grammar():
    assert parse("a", "t") == Term("t", "a")
    assert parse("+a -b c", "t") == Group((Term("t", "a"),), (Term("t", "c"),), (Term("t", "b"),))
    assert parse("a AND b OR c", "t") == Group((), (Group((Term("t", "a"), Term("t", "b"))), Term("t", "c")))
    assert parse("f:(a b)^2", "t").boost == 2 and all(x.field == "f" for x in leaves(parse("f:(a b)", "t")))
    for bad in ("(a", "a)", "AND a", "a OR", '"a', "[a TO", "NOT", "a AND", "()", "^2"):
        with pytest.raises(ValueError, match="failed to parse"):
            parse(bad, "t")


def test_calls_in_sql():
    sql = """SELECT 'full_text(a, "b")' /* full_text(x, 'y') */ FROM t WHERE full_text(body, 'it''s (a') OR full_text("other", 'x\\'y') -- full_text(z, 'w')"""
    assert [(c.field, c.query) for c in find_full_text_calls(sql)] == [("body", "it's (a"), ("other", "x'y")]


def plain(text, node):
    """What a tree of words and phrases matches, word by word."""
    words = words_of(text or "")
    if isinstance(node, Term):
        own = words_of(node.text)
        return bool(own) and any(words[i : i + len(own)] == own for i in range(len(words)))
    found = all(plain(text, n) for n in node.must) if node.must else any(plain(text, n) for n in node.should)
    return found and not any(plain(text, n) for n in node.must_not)


@pytest.fixture(scope="module")
def engine(spark):
    from larkspire.engine import SearchEngine

    e = SearchEngine(spark)
    e.register("t", [split(spark, "s", list(enumerate(TEXTS)), "id long, body string", [("id", "i64"), ("body", "text", {"fast": False})])])
    return e


word = st.sampled_from(["of", "the", "a", "b", "aile", "été", "12", "x", '"of the"', '"a a"', '"b a"'])
queries = st.recursive(word, lambda q: st.builds(lambda a, b, op: f"({a} {op} {b})", q, q, st.sampled_from(["AND", "OR", "", "-", "AND NOT"])), max_leaves=5)


@settings(max_examples=40, deadline=None)
@given(queries)
def test_matches_like_the_words(engine, q):
    q = re.sub(r"- \(", "-(", q).replace("- ", "-")
    node = parse(q, "body")
    got = values(engine.table("t").full_text("body", q).select("id").frame(), "id")
    assert got == [(i,) for i, t in enumerate(TEXTS) if plain(t, node)]


def test_slop(engine):
    find = lambda q: [i for (i,) in values(engine.table("t").full_text("body", q).select("id").frame(), "id")]
    assert find('"of the"') == [0, 1]
    assert find('"of the"~1') == [0, 1, 8]
    assert find('"of the"~2') == [0, 1, 8, 9]
