import random

from larkspire.llm import decontaminate as D
from tests.llm.helpers import documents, rows

ITEM = "Alice and then Bob had 12 apples and gave 5 kg of them to Carol before 7 pm. How many apples did Bob keep?"
CHANGED = "Dora and then Emil had 40 apples and gave 9 kg of them to Frida before 3 pm. How many apples did Emil keep?"
TORN = "Alice and then Bob had 12 apples and gave 5 kg of them to Carol before 7 pm. How many apples did Zoe keep?"


def bench(spark, items):
    return spark.createDataFrame([(i, t) for i, t in items], "item_id long, text string")


def brute(docs, items, similarity=0.75):
    """Without the slot check."""

    def shingles(tokens, sizes=(5,)):
        return {tuple(x if v is None or n == 5 else v for x, v in tokens[i : i + n]) for n in sizes for i in range(len(tokens) - n + 1)}

    found = []
    for d, t in docs:
        own = shingles(D.canonical(t or ""), range(1, 6))
        for i, x in items:
            tokens = D.canonical(x or "")
            want = shingles(tokens, [min(len(tokens), 5)]) if tokens else set()
            if want and len(own & want) >= similarity * len(want):
                found.append((d, i, len(own & want), len(want)))
    return sorted(found, key=repr)


def test_reparameterised_questions(spark):
    docs = documents(spark, [f"some words before. {t} And other words after it." for t in (ITEM, CHANGED, "nothing of that kind is here")])
    assert rows(D.find_leaks(spark, docs, bench(spark, [(3, ITEM)])), "doc_id", "item_id") == [(0, 3), (1, 3)]
    changed = {r.doc_id: r.n_changed for r in D.find_leaks(spark, docs, bench(spark, [(3, ITEM)])).collect()}
    assert changed[0] == 0 and changed[1] >= 5
    assert sorted(r.doc_id for r in D.remove_leaks(spark, docs, bench(spark, [(3, ITEM)])).collect()) == [2]


def test_each_occurrence_is_judged(spark):
    other = ITEM.replace("Alice", "Ida").replace("Bob", "Jan").replace("Carol", "Kim").replace("12", "31").replace("5", "8").replace("7", "2")
    long = " ".join(f"word{i} here" for i in range(200))
    texts = [f"{ITEM} {CHANGED}", f"{CHANGED} {other}", f"{other} {ITEM} {CHANGED}", f"{ITEM} {long} {CHANGED}", f"{CHANGED} {ITEM.replace('apples and', 'quite ripe red apples and')}", "nothing of that kind is here"]
    docs = documents(spark, texts)
    assert [r.doc_id for r in D.remove_leaks(spark, docs, bench(spark, [(3, ITEM)])).collect()] == [5]
    torn = [" ".join(f"Then {a} met {b} and" for a, b in pairs) for pairs in ([("Bob", "Bob")] * 6, [("Bob", "Eve"), ("Dan", "Ida"), ("Kim", "Lea"), ("Mia", "Ned"), ("Ole", "Pia"), ("Quin", "Rob")])]
    assert [r.doc_id for r in D.remove_leaks(spark, documents(spark, torn), bench(spark, [(1, "so " + torn[0])])).collect()] == [1]


def test_slots_must_agree():
    own = [["<name>:bob", None, "<num>:3", None, "<name>:bob"]]
    assert D.slots_agree(own, [["eve", None, "4", None, "eve"]]) == (True, 2)
    assert D.slots_agree(own, [["eve", None, "4", None, "dan"]])[0] is False


def test_matches_brute_force(spark):
    random.seed(2)
    words = "the of Bob 12 kg apples, went and. a to 3.5 Eve ran! 7 km far".split()
    items = [(i, " ".join(random.choice(words) for _ in range(random.randrange(1, 14)))) for i in range(25)]
    docs = [(i, " ".join(random.choice(words) for _ in range(random.randrange(40)))) for i in range(120)]
    docs += [(200 + i, f"x {t} y") for i, t in items]
    wide = [(d, i, m, n) for d, i, m, n in brute(docs, items)]
    got = rows(D.find_leaks(spark, documents(spark, docs), bench(spark, items)), "doc_id", "item_id", "n_matched", "n_windows")
    assert set(got) <= set(wide)  # the slot check only takes away
    plain = [(i, t.lower().replace("12", "x").replace("3.5", "y").replace("7", "z").replace("kg", "w").replace("km", "v")) for i, t in items]
    docs = [(i, t.lower()) for i, t in docs if not any(c.isdigit() for c in t)] + [(300 + i, f"q r {t} s") for i, t in plain]
    got = rows(D.find_leaks(spark, documents(spark, docs), bench(spark, plain)), "doc_id", "item_id", "n_matched", "n_windows")
    slotless = [(d, t) for d, t in docs if "kg" not in t and "km" not in t]
    assert set(brute(slotless, plain)) <= set(got) <= set(brute(docs, plain))


def test_edges(spark, monkeypatch):
    items = [(i, f"word{i} " * 3 + "then comes a tail of several plain words") for i in range(6)]
    docs = documents(spark, [(i, f"lead {t} trail") for i, t in items] + [(50, None), (51, ""), (None, "lead " + items[2][1])]).selectExpr("*", "1 AS item_id", "2 AS w", "3 AS dk", "4 AS place")
    whole = rows(D.find_leaks(spark, docs, bench(spark, items + [(None, "x y"), (9, None), (10, " ")])), "doc_id", "item_id")
    assert (None, 2) in whole and (0, 0) in whole
    monkeypatch.setattr(D, "FILTER_BITS", D.PIECE_BITS)  # a filter that lets much through changes nothing
    monkeypatch.setattr(D, "BITS_PER_WINDOW", 0)
    assert rows(D.find_leaks(spark, docs, bench(spark, items)), "doc_id", "item_id") == whole
    assert D.find_leaks(spark, documents(spark, []), bench(spark, items)).count() == 0
    assert D.find_leaks(spark, docs, bench(spark, [])).count() == 0
    kept = D.remove_leaks(spark, docs, bench(spark, []))
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_repeated_rows_and_items(spark):
    docs = documents(spark, [(1, "so " + ITEM), (1, "so " + ITEM), (1, "other text"), (None, ITEM), (None, ITEM), (2, None)])
    got = rows(D.find_leaks(spark, docs, bench(spark, [(3, ITEM), (3, ITEM), (4, ITEM)])), "doc_id", "item_id")
    assert got == sorted([(d, i) for d in (1, 1, None, None) for i in (3, 3, 4)], key=repr)
    assert rows(D.remove_leaks(spark, docs, bench(spark, [(3, ITEM)])), "doc_id", "text") == [(1, "other text"), (2, None)]


def test_short_items_are_found_as_they_stand(spark):
    docs = documents(spark, ["Quick brown foxes", "They say: quick Brown foxes, run over the hills", "quick red foxes", "Who is Zorblat Quux? Nobody.", "Who is Anna Berg? Nobody.", "born in Paris", "it has 5 kg left"])
    items = [(1, "quick brown foxes"), (2, "Who is Zorblat Quux?"), (3, "5kg")]
    assert rows(D.find_leaks(spark, docs, bench(spark, items)), "doc_id", "item_id") == [(0, 1), (1, 1), (3, 2), (6, 3)]
    assert rows(D.remove_leaks(spark, docs, bench(spark, items)), "doc_id") == [(2,), (4,), (5,)]


def test_units_stand_beside_numbers():
    kinds = lambda text: [x for x, _ in D.canonical(text)]
    assert kinds("born in Paris, 5 km in a day") == ["born", "in", "<name>", "<num>", "<unit>", "in", "a", "day"]
    assert kinds("$ 5 or 40 % of V and 3kg") == ["<unit>", "<num>", "or", "<num>", "<unit>", "of", "<name>", "and", "<num>", "<unit>"]


def test_long_texts_and_frequent_windows(spark):
    """A table of numbers shares one window with many items; only items whose other windows are there, too, are judged."""
    table = " ".join(str(k % 97) for k in range(30_000))
    items = [(i, f"row{i} of data has " + " ".join(str(i + k) for k in range(9)) + f" as its end{i} mark") for i in range(60)]
    docs = documents(spark, [(1, table), (2, f"{table} {items[7][1]} {table}"), (3, "x " * 200_000 + items[9][1])])
    assert rows(D.find_leaks(spark, docs, bench(spark, items)), "doc_id", "item_id") == [(2, 7), (3, 9)]


def test_ties_between_fillings():
    """Of values that fill a slot equally often the last in order counts."""
    own = [["<num>:3"], ["<num>:3"]]
    assert D.slots_agree(own, [["3"], ["5"]]) == (False, 1) and D.slots_agree(own, [["1"], ["3"]]) == (False, 0)
