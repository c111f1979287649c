import numpy as np
import pytest

from larkspire.llm import ann


def table(spark, ids, vectors):
    rows = [(int(i), None if v is None else [None if x is None else float(x) for x in v]) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)


def brute(ids, x, q_id, q, k):
    scores = (x.astype(np.float32).astype(float) * q.astype(np.float32).astype(float)).sum(1)
    order = sorted((-s, i) for s, i in zip(scores, ids) if i != q_id)
    return [(i, -s) for s, i in order[:k]]


@pytest.mark.parametrize("lengths", ["unit", "mixed"])
def test_recall_and_scores(spark, lengths, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 700)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 40)
    random = np.random.default_rng(5)
    x = random.normal(size=(2000, 24))
    x /= np.sqrt((x**2).sum(1))[:, None]
    if lengths == "mixed":
        x *= random.uniform(0.2, 2, 2000)[:, None]
    ids = np.arange(2000)
    df = table(spark, ids, x)
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, []).append(r)
    hits = 0
    assert len(got) == 100
    for q, found in got.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 21)) and len({r.vec_id for r in found}) == 20
        assert all(a.score >= b.score for a, b in zip(found, found[1:])) and q not in {r.vec_id for r in found}
        want = brute(ids, x, q, x[q], 20)
        hits += len({i for i, _ in want} & {r.vec_id for r in found})
        scores = dict(brute(ids, x, q, x[q], 2000))
        assert all(abs(scores[r.vec_id] - r.score) < 1e-12 for r in found)
    assert hits / 2000 >= 0.9


def test_ties_and_copies_are_exact(spark):
    random = np.random.default_rng(1)
    base = random.normal(size=(6, 5))
    x = base[random.integers(0, 6, 300)]
    df = table(spark, range(300), x)
    for r in _by_query(ann.nearest(df, df.where("vec_id % 20 = 0"), confidence=0.9999999)).items():
        assert [(i, round(s, 9)) for i, s in r[1]] == [(i, round(s, 9)) for i, s in brute(range(300), x, r[0], x[r[0]], 20)]


def _by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_edges(spark):
    vectors = [[1, 0], [0, 0], None, [1, None], [float("nan"), 1], [float("inf"), 1], [2, 1], [1, 0, 3], []]
    df = table(spark, range(9), vectors)
    assert _by_query(ann.nearest(df, df)) == {0: [(6, 2.0)], 6: [(0, 2.0)]}
    twice = df.union(df)
    assert _by_query(ann.nearest(twice, twice)) == {0: [(6, 2.0)], 6: [(0, 2.0)]}
    assert ann.nearest(df.where("false"), df.where("false")).count() == 0
    assert ann.nearest(df, df.where("vec_id = 1")).count() == 0


def test_extra_columns_and_long_vectors(spark):
    random = np.random.default_rng(2)
    x = random.normal(size=(40, 1500))
    df = table(spark, range(40), x).selectExpr("*", "1 AS id", "2 AS v", "3 AS cell", "4 AS query_id", "5 AS known")
    got = _by_query(ann.nearest(df, df.where("vec_id % 20 = 0"), k=50))
    assert {q: [i for i, _ in r] for q, r in got.items()} == {q: [i for i, _ in brute(range(40), x, q, x[q], 50)] for q in (0, 20)}


def test_descent_passes_over_branches():
    random = np.random.default_rng(3)
    points = random.normal(size=(5000, 4)) + 20 * random.integers(0, 3, size=(5000, 1))
    tree, queries = ann.Tree(points), points[::700]
    limits = np.full(len(queries), 3.0)
    q, leaf, bound = tree.descend(queries, limits)
    leaves = np.flatnonzero(tree.children[:, 0] < 0)
    for i, own in enumerate(queries):
        every = ann.box_bounds(own[None, :], tree.low[leaves], tree.high[leaves])
        assert sorted(leaf[q == i].tolist()) == leaves[every < 3.0].tolist() and (np.diff(bound[q == i]) >= 0).all()
    assert len(q) < len(queries) * len(leaves) / 2
    assert (ann.box_bounds(queries, tree.low[tree.nearest_leaf(queries)], tree.high[tree.nearest_leaf(queries)]) == 0).mean() > 0.5


def test_cells_grow_with_the_input_and_queries_visit_few(spark, monkeypatch):
    """With clusters in the data a query goes to about as many cells whatever the number of vectors is, so what is dealt grows in proportion."""
    monkeypatch.setattr(ann, "BLOCK_ROWS", 100)
    random = np.random.default_rng(4)
    centres, visited = random.normal(size=(30, 12)) * 30, []
    for n in (1500, 3000):
        x = centres[np.arange(n) % 30] + random.normal(size=(n, 12))
        top = ann.fit_top(ann.usable(table(spark, range(n), x), "vec_id", "embedding"))[12]
        assert top.parts.sum() >= n / 100 and (top.parts <= 3).all()
        projected, scale = ann.project_queries(x[:60], top.norm)
        kth = np.sort(x[:60] @ x.T, axis=1)[:, -21]
        limits = ann.chi_square_quantile(0.9, ann.DIRECTIONS) * np.maximum(2 * top.norm**2 - 2 * scale * kth, 0)
        visited.append((top.bounds(projected) < limits[:, None]).mean())
    assert visited[1] < 1.2 * visited[0] and visited[1] < 0.9


def test_quantile():
    assert abs(ann.chi_square_quantile(0.95, 8) - 15.507) < 1e-3
