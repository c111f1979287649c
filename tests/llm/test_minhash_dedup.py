import random

import numpy as np

from larkspire.llm import minhash_dedup as M
from larkspire.llm.common import cut
from larkspire.llm.components import components, contract
from tests.llm.helpers import documents, rows


def brute(texts):
    import re

    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted(((i, len(sets[i]), find(i), find(i) == i) for i in ids), key=repr)


def corpus(seed, groups=25, copies=12):
    random.seed(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(groups):
        base = [random.choice(vocabulary) for _ in range(random.randrange(3, 150))]
        for _ in range(random.randrange(1, copies)):
            own = list(base)
            for _ in range(random.randrange(4)):
                own[random.randrange(len(own))] = random.choice(vocabulary)
            texts.append(" ".join(own))
    random.shuffle(texts)
    return list(enumerate(texts))


def test_matches_brute_force(spark):
    texts = corpus(1) + [(9000, None), (9001, ""), (9002, " \t\r"), (9003, "One two"), (9004, "one  TWO"), (9005, "Ärger Über x"), (9006, "ärger über x")]
    got = rows(M.near_duplicates(documents(spark, texts)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == brute(texts)


def test_blocks_find_the_same(spark, monkeypatch):
    texts = corpus(4, groups=3, copies=120)
    want = brute(texts)
    assert rows(M.near_duplicates(documents(spark, texts)), "doc_id", "n_shingles", "component_id", "kept") == want
    monkeypatch.setattr(M, "BLOCK_DOCS", 20)
    assert rows(M.near_duplicates(documents(spark, texts)), "doc_id", "n_shingles", "component_id", "kept") == want


def test_chunks_agree_on_table_keys(spark):
    """Which documents meet doesn't depend on how the rows are dealt: copies that lie in chunks of their own do, too."""
    texts = corpus(11, groups=30, copies=6)
    sets = cut(M.signed(documents(spark, texts)).where("n > 0").select("did", "sig"))
    told = [sorted((r.node, r.component) for r in components(M.candidate_pairs(sets.repartition(n, "did"))).collect()) for n in (1, 7, 60)]
    assert told[0] == told[1] == told[2] and told[0]


def test_edges(spark):
    assert M.near_duplicates(documents(spark, [])).count() == 0
    out = rows(M.near_duplicates(documents(spark, [(3, "a b c"), (3, "x y z"), (1, "a b c"), (7, "x y z"), (None, "a b c"), (5, "q")])), "doc_id", "component_id", "kept")
    assert out == sorted([(1, 1, True), (3, 1, False), (3, 1, False), (7, 1, False), (None, None, True), (5, 5, True)], key=repr)
    clash = documents(spark, ["a b", "a b", "c"]).selectExpr("*", "1 AS did", "2 AS component", "3 AS kept", "4 AS node")
    kept = M.keep_one_of_each(clash)
    assert kept.columns == clash.columns and rows(kept, "doc_id") == [(0,), (2,)]


def test_what_is_apart_meets_once(spark, monkeypatch):
    """Each two nodes of a cluster with different labels meet in one pair of blocks; a large label's own nodes don't."""
    monkeypatch.setattr(M, "BLOCK_DOCS", 16)
    labelled = {i: 0 if i < 100 else 100 if i < 140 else i for i in range(160)} | {i: 500 for i in range(500, 540)}
    clusters = spark.createDataFrame([(i, 0 if i < 500 else 500) for i in labelled], "node long, component long")
    labels = spark.createDataFrame([(i, c) for i, c in labelled.items() if i % 7 or c != i], "node long, component long")
    met, seen = {}, M.blocks_apart(clusters, labels).collect()
    for r in seen:
        assert r.label == labelled[r.node] and r.component == 0
        met.setdefault((r.g, r.i, r.h, r.j), []).append((r["first"], r.node))
    times = {}
    for (g, i, h, j), nodes in met.items():
        for k, (x, a) in enumerate(nodes):
            for y, b in nodes[:k]:
                if labelled[a] != labelled[b] and (x != y or (g, i) == (h, j)):
                    times[frozenset((a, b))] = times.get(frozenset((a, b)), 0) + 1
    assert set(times.values()) == {1} and len(times) == sum(labelled[a] != labelled[b] for a in range(160) for b in range(a))
    assert not any(g == h and g is not None for g, _, h, _ in met)


def test_large_groups_stay_linear(spark, monkeypatch):
    """Near copies of one text are confirmed with about one comparison each, and nothing is left to compare in blocks."""
    monkeypatch.setattr(M, "BLOCK_DOCS", 32)
    random.seed(6)
    base = [f"w{random.randrange(900)}" for _ in range(120)]
    texts = [" ".join(base[:i % 100] + [f"new{i}"] + base[i % 100 + 1 :]) for i in range(700)]
    docs = documents(spark, texts).selectExpr("doc_id AS did", "text")
    pairs = cut(M.candidate_pairs(M.signed(documents(spark, texts)).select("did", "sig")))
    links = M.partner_links(docs, pairs)
    assert links.count() <= len(texts) and links.where("a >= b").count() == 0
    labels, clusters = components(links), components(pairs)
    assert clusters.select("component").distinct().count() == 1
    assert M.blocks_apart(clusters, labels).count() <= 4 * len(texts)


def test_very_long_texts(spark):
    random.seed(7)
    words = [f"w{random.randrange(5000)}" for _ in range(150_000)]
    other = words[:40_000] + ["x"] + words[40_001:]
    got = rows(M.near_duplicates(documents(spark, [" ".join(words), "short one here", " ".join(other), " ".join(words[:75_000])])), "doc_id", "component_id")
    assert got == [(0, 0), (1, 1), (2, 0), (3, 3)]


def test_both_ways_of_comparing_agree():
    random.seed(8)
    sets = [np.unique(np.array([random.randrange(60) for _ in range(random.randrange(1, 60))], np.uint64)) for _ in range(20)] + [np.zeros(0, np.uint64)]
    base = np.arange(100, dtype=np.uint64)
    sets += [np.delete(base, random.sample(range(100), random.randrange(30))) for _ in range(30)]
    nodes, side = np.arange(len(sets)) * 3, np.zeros(len(sets), int)

    def groups(a, b):
        x, y = contract(np.asarray(a, np.int64), np.asarray(b, np.int64))
        return sorted(zip(y.tolist(), x.tolist()))

    a, b = M.link_edges(sets, nodes, side)
    pairs = [(nodes[i], nodes[j]) for i in range(len(sets)) for j in range(i) if M.linked(sets[i], sets[j])]
    assert groups(a, b) == groups(*zip(*pairs))
    label = np.array([random.randrange(12) for _ in sets])
    for some in (slice(0, 20), slice(None)):
        a, b = M.link_edges(sets[some], nodes[some], side[some], label=label[some])
        pairs = [(nodes[some][i], nodes[some][j]) for i in range(len(sets[some])) for j in range(i) if label[i] != label[j] and M.linked(sets[i], sets[j])]
        assert groups(a, b) == groups(*(zip(*pairs) if pairs else ((), ())))


def test_components(spark):
    random.seed(2)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(170)] + [(500 + i, 501 + i) for i in range(90)] + [(None, 3), (4, 4)]
    real = [e for e in edges if None not in e and e[0] != e[1]]
    x, y = contract(np.array([a for a, _ in real]), np.array([b for _, b in real]))
    want = dict(zip(y.tolist(), x.tolist()))
    want |= {r: r for r in set(x.tolist())}
    got = components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()
    assert len(got) == len(want) and {r.node: r.component for r in got} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def ran(spark):
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    return {found.apply(i).executionId(): found.apply(i).physicalPlanDescription() for i in range(found.size())}


def test_components_broadcast_nothing(spark, monkeypatch):
    """What the driver would build, and hold for all rounds, in a stage of many joins of small tables."""
    monkeypatch.setattr("larkspire.llm.components.ONE_TASK_EDGES", 0)
    edges = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(30)]
    before = ran(spark)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(31)}
    plans = [p for k, p in ran(spark).items() if k not in before]
    assert any("SortMergeJoin" in p for p in plans) and not any("BroadcastHashJoin" in p for p in plans)


def test_small_components_join_nothing(spark, monkeypatch):
    """One task contracts a small graph, with the answer of the rounds, also at the bound."""
    random.seed(8)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(500 - i, 499 - i) for i in range(60)] + [(None, 1), (2, None), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    told = []
    for contracted in (False, True):
        before = ran(spark)
        told.append(sorted(map(tuple, components(df, contracted).collect())))
        assert not any("Join" in p for k, p in ran(spark).items() if k not in before)
    monkeypatch.setattr("larkspire.llm.components.ONE_TASK_EDGES", 0)
    assert told[0] == told[1] == sorted(map(tuple, components(df).collect())) and len(told[0]) > 200
