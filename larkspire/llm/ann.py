"""Approximate nearest neighbours by stable projections and a kd-tree, with a chi-square stopping test.

Vectors are projected on a few Gaussian directions. For a true distance d, (projected distance / d)^2 has the chi-square
distribution with as many degrees of freedom as there are directions, whatever the vectors are. A kd-tree over the projected
points yields them in the order of a lower bound of their projected distance to a query; each is verified with its original
vector. The search ends when the bound of what comes next is so large that, with probability CONFIDENCE, a point nearer than
the worst one held would have come before.

The measure is the largest inner product. It becomes a distance by adding a coordinate that gives all vectors the same norm.

The top of the tree is fitted on a bounded sample; its leaves are cells, to which every vector is dealt once. A cell of many
vectors has parts, so one that holds a third of all rows spreads out. A query first goes to its nearest cell. With the k-th best
score found there it then goes only to the cells that the stopping test leaves, and inside each it descends the cell's own
tree past the branches that the test leaves. Equal vectors in a part are one point of its tree with the smallest of their
ids, as many as can be asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspire.llm.common import chunks, cut, map_arrow, map_chunks

DIRECTIONS = 8
CONFIDENCE = 0.999
#: Vectors of a part, about, and queries that are answered together.
BLOCK_ROWS, BLOCK_QUERIES = 16384, 4096
#: Vectors, at most about, on which the top of the tree is fitted, and cells that it has at most.
SAMPLE_ROWS, MAX_CELLS = 1 << 15, 1 << 11
STEPS = 1 << 20
LEAF_ROWS = 64
#: Leaves that each query verifies between two stopping tests.
STEP_LEAVES = 8
#: Verified points held beyond those asked for, in case rounding reorders nearly equal scores.
SPARE = 4
#: Scores that differ by less, relatively, may be equal ones that were added up in different orders.
TIE = 1e-12


def chi_square_quantile(p: float, degrees: int) -> float:
    """For an even number of degrees."""

    def below(x: float) -> float:
        return 1 - exp(-x / 2) * sum((x / 2) ** i / factorial(i) for i in range(degrees // 2))

    low, high = 0.0, 1000.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


def directions(size: int) -> np.ndarray:
    return np.random.default_rng(size).normal(size=(size, DIRECTIONS))


def project(vectors: np.ndarray, largest_norm: float) -> np.ndarray:
    """Vectors with the coordinate that gives all the same norm, projected."""
    rest = np.sqrt(np.maximum(largest_norm**2 - (vectors**2).sum(1), 0))
    return np.column_stack([vectors, rest]) @ directions(vectors.shape[1] + 1)


def project_queries(queries: np.ndarray, largest_norm: float) -> tuple[np.ndarray, np.ndarray]:
    """Queries, scaled to the norm of the vectors, projected; and their scales."""
    scale = largest_norm / np.sqrt((queries**2).sum(1))
    return (queries * scale[:, None]) @ directions(queries.shape[1] + 1)[:-1], scale


def box_bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances below which no point of a box lies: of query i to box i."""
    return (np.maximum(np.maximum(low - queries, queries - high), 0) ** 2).sum(-1)


class Tree:
    """A kd-tree over points; its leaves are stretches of a reordering of them, and every node has its bounding box."""

    def __init__(self, points: np.ndarray):
        self.order, self.spans, self.children = np.arange(len(points)), [(0, len(points))], [(-1, -1)]
        at = 0
        while at < len(self.spans):
            a, b = self.spans[at]
            if b - a > LEAF_ROWS:
                own = points[self.order[a:b]]
                axis, middle = int((own.max(0) - own.min(0)).argmax()), (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(own[:, axis], middle)]
                self.children[at] = (len(self.spans), len(self.spans) + 1)
                self.spans += [(a, a + middle), (a + middle, b)]
                self.children += [(-1, -1)] * 2
            at += 1
        self.children = np.array(self.children)
        ordered = points[self.order]
        self.low = np.array([ordered[a:b].min(0) for a, b in self.spans])
        self.high = np.array([ordered[a:b].max(0) for a, b in self.spans])

    def nearest_leaf(self, queries: np.ndarray) -> np.ndarray:
        """The leaf that each query reaches by the nearer child of every node."""
        node = np.zeros(len(queries), np.int64)
        while (inner := np.flatnonzero(self.children[node, 0] >= 0)).size:
            left, right = self.children[node[inner]].T
            q = queries[inner]
            nearer = box_bounds(q, self.low[left], self.high[left]) <= box_bounds(q, self.low[right], self.high[right])
            node[inner] = np.where(nearer, left, right)
        return node

    def descend(self, queries: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, leaf, bound) of the leaves with a bound under the query's limit, each query's nearest first.

        A branch whose box lies beyond the limit is passed over as a whole.
        """
        q, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        found: list = []
        while len(q):
            bound = box_bounds(queries[q], self.low[node], self.high[node])
            near = bound < limits[q]
            q, node, bound = q[near], node[near], bound[near]
            leaf = self.children[node, 0] < 0
            found.append((q[leaf], node[leaf], bound[leaf]))
            q, node = np.repeat(q[~leaf], 2), self.children[node[~leaf]].ravel()
        q, node, bound = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((bound, q))
        return q[order], node[order], bound[order]


class Part:
    """The vectors of one part of a cell, indexed."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest_norm: float):
        order = np.lexsort((ids, *vectors.T[::-1]))
        ids, vectors = ids[order], vectors[order]
        new = np.ones(len(ids), bool)
        new[1:] = (vectors[1:] != vectors[:-1]).any(1)
        start = np.flatnonzero(new)
        stop = np.append(start[1:], len(ids))
        self.ids, self.norm, self.tree = ids, largest_norm, Tree(project(vectors[start], largest_norm))
        self.points, self.start, self.stop = vectors[start][self.tree.order], start[self.tree.order], stop[self.tree.order]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, confidence: float, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the query, id, inner product) of up to k neighbours of each query in the part, other than its own id.

        known: the k-th best score that each query has found elsewhere, -inf for none.
        """
        tree, points, ids = self.tree, self.points, self.ids
        known = np.full(len(queries), -np.inf) if known is None else known
        projected, scale = project_queries(queries, self.norm)
        quantile = chi_square_quantile(confidence, DIRECTIONS)
        hold = k + 1 + SPARE  # the query itself may be among them
        best, best_at = np.full((len(queries), hold), -np.inf), np.full((len(queries), hold), -1)

        def limits(at: np.ndarray) -> np.ndarray:
            """Bounds from which on nothing is worth a look."""
            kth = np.maximum(np.partition(best[at], hold - (k + 1), axis=1)[:, hold - (k + 1)], known[at])
            return quantile * np.maximum(2 * self.norm**2 - 2 * scale[at] * kth, 0) + TIE  # inf where nothing is known

        def verify(at: np.ndarray, leaves: np.ndarray) -> None:
            """Hold the best of these leaves, (queries, any number), -1 for none."""
            scores = np.full((len(at), leaves.shape[1] * LEAF_ROWS), -np.inf)
            places = np.full(scores.shape, -1)
            flat = leaves.ravel()
            by_leaf = np.argsort(flat, kind="stable")
            cuts = np.flatnonzero(np.concatenate([[True], flat[by_leaf][1:] != flat[by_leaf][:-1]]))
            for a, b in zip(cuts, np.append(cuts[1:], len(flat))):
                if flat[by_leaf[a]] < 0:
                    continue
                row, slot = np.divmod(by_leaf[a:b], leaves.shape[1])
                low, high = tree.spans[flat[by_leaf[a]]]
                column = slot[:, None] * LEAF_ROWS + np.arange(high - low)
                scores[row[:, None], column] = queries[at[row]] @ points[low:high].T
                places[row[:, None], column] = np.arange(low, high)
            scores = np.concatenate([best[at], scores], axis=1)
            places = np.concatenate([best_at[at], places], axis=1)
            pick = np.argpartition(scores, scores.shape[1] - hold, axis=1)[:, -hold:]
            # Where points tie at the edge of what is held, those with the smaller ids are.
            edge = np.take_along_axis(scores, pick, 1).min(1)
            near = TIE * (1 + np.abs(edge))
            for r in np.flatnonzero((scores >= (edge - near)[:, None]).sum(1) > hold):
                if np.isfinite(edge[r]):
                    tied = np.flatnonzero(scores[r] >= edge[r] - near[r])
                    pick[r] = tied[np.lexsort((ids[self.start[places[r, tied]]], scores[r, tied] <= edge[r] + near[r]))[:hold]]
            best[at] = np.take_along_axis(scores, pick, 1)
            best_at[at] = np.take_along_axis(places, pick, 1)

        every = np.arange(len(queries))
        first = tree.nearest_leaf(projected)
        reached = box_bounds(projected, tree.low[first], tree.high[first]) < limits(every)
        if reached.any():
            verify(every[reached], first[reached][:, None])
        q, leaf, bound = tree.descend(projected, limits(every))
        new = ~(reached[q] & (leaf == first[q]))
        q, leaf, bound = q[new], leaf[new], bound[new]
        begin, end = np.searchsorted(q, every, "left"), np.searchsorted(q, every, "right")
        active = every[begin < end]
        while len(active):
            active = active[bound[begin[active]] < limits(active)]
            if not len(active):
                break
            at = begin[active][:, None] + np.arange(STEP_LEAVES)
            there = at < end[active][:, None]
            verify(active, np.where(there, leaf[np.minimum(at, len(leaf) - 1)], -1))
            begin[active] += STEP_LEAVES
            active = active[begin[active] < end[active]]
        out: tuple[list, list, list] = ([], [], [])
        for i in range(len(queries)):
            found = best_at[i][best_at[i] >= 0]
            scores = np.cumsum(points[found] * queries[i], axis=1)[:, -1]  # one way of adding up for all, so equal vectors tie
            pairs = [(-s, int(x)) for s, p in zip(scores.tolist(), found) for x in ids[self.start[p] : min(self.stop[p], self.start[p] + k + 1)] if x != query_ids[i]]
            pairs = sorted(set(pairs))[:k]
            out[0].extend([i] * len(pairs)), out[1].extend(x for _, x in pairs), out[2].extend(-s for s, _ in pairs)
        return np.array(out[0], np.int64), np.array(out[1], np.int64), np.array(out[2], np.float64)


@dataclass
class Top:
    """The top of the tree for vectors of one length: a complete binary tree of splits, whose leaves are the cells."""

    norm: float
    depth: int
    axis: np.ndarray
    value: np.ndarray
    low: np.ndarray | None = None  # boxes of the cells, and how many parts each has
    high: np.ndarray | None = None
    parts: np.ndarray | None = None

    @staticmethod
    def fit(points: np.ndarray, norm: float, cells: int) -> Top:
        """points: projected vectors of the sample."""
        depth = max(0, int(np.ceil(np.log2(cells))))
        axis, value = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        held = {0: points}
        for node in range(2**depth - 1):
            own = held.pop(node)
            if len(own):
                axis[node] = k = int((own.max(0) - own.min(0)).argmax())
                value[node] = np.median(own[:, k])
            right = own[:, axis[node]] >= value[node]
            held[2 * node + 1], held[2 * node + 2] = own[~right], own[right]
        return Top(norm, depth, axis, value)

    def cells(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] >= self.value[node])
        return node - (2**self.depth - 1)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """(queries, cells); inf for empty cells."""
        return np.where(self.parts > 0, np.stack([box_bounds(queries, a, b) for a, b in zip(self.low, self.high)], axis=1), np.inf)


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """id and v of the vectors that take part: not null, finite throughout, not zero."""
    v = F.col(embedding).cast("array<double>")
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x))
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("id"), v.alias("v")).where(F.col(vec_id).isNotNull() & v.isNotNull() & finite)
    return rows.where(F.exists("v", lambda x: x != 0))


def _matrices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, vectors) for each length of vectors in a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    sizes, flat = np.diff(offsets), column.values.to_numpy()
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield size, rows, flat[offsets[rows][:, None] + np.arange(size)]


EDGES = [f"{side}{k}" for side in ("low", "high") for k in range(DIRECTIONS)]
DEALT = "size int, cell int, part int, asked int, id bigint, own bigint, known double, v array<double>"
FOUND = "query_id bigint, own bigint, vec_id bigint, score double"


def fit_top(data: DataFrame) -> dict[int, Top]:
    """For each length of vectors the top of the tree, with boxes and counts of all vectors of data (id, v)."""
    spark = data.sparkSession
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    facts = {r["size"]: (r["norm"], r["n"]) for r in data.groupBy(F.size("v").alias("size")).agg(F.max(norm).alias("norm"), F.count("*").alias("n")).collect()}  # a row for each length
    if not facts:
        return {}
    share = min(STEPS, -(-STEPS * SAMPLE_ROWS // sum(n for _, n in facts.values())))
    norms = {size: n for size, (n, _) in facts.items()}

    def projected(t: pa.RecordBatch) -> pa.Table:
        made = [(size, project(m, norms[size])) for size, _, m in _matrices(t.column(0))]
        return pa.table({"size": pa.array(np.concatenate([np.full(len(p), s) for s, p in made]).astype(np.int32)), "p": pa.array([x for _, p in made for x in p.tolist()], pa.list_(pa.float64()))})

    sample = map_chunks(data.where(F.pmod(F.xxhash64("id"), F.lit(STEPS)) < share).select("v"), projected, "size int, p array<double>").collect()  # about SAMPLE_ROWS
    tops = {}
    for size, (largest, n) in facts.items():
        points = np.array([r["p"] for r in sample if r["size"] == size]).reshape(-1, DIRECTIONS)
        tops[size] = Top.fit(points, largest, max(1, min(-(-n // BLOCK_ROWS), MAX_CELLS)))
    shared = spark.sparkContext.broadcast(tops)  # MAX_CELLS splits for each length

    def boxes(t: pa.RecordBatch) -> pa.Table:
        out = []
        for size, _, m in _matrices(t.column(0)):
            p = project(m, shared.value[size].norm)
            cell = shared.value[size].cells(p)
            out += [(size, c, int((cell == c).sum()), *p[cell == c].min(0), *p[cell == c].max(0)) for c in np.unique(cell).tolist()]
        kinds = [pa.int32(), pa.int32(), pa.int64()] + [pa.float64()] * (2 * DIRECTIONS)
        return pa.table([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=["size", "cell", "n", *EDGES])

    stated = map_chunks(data.select("v"), boxes, "size int, cell int, n bigint, " + ", ".join(f"{e} double" for e in EDGES))
    least = [(F.min if e.startswith("low") else F.max)(e).alias(e) for e in EDGES]
    for top in tops.values():
        top.low, top.high = np.full((2**top.depth, DIRECTIONS), np.inf), np.full((2**top.depth, DIRECTIONS), -np.inf)
        top.parts = np.zeros(2**top.depth, np.int64)
    for r in stated.groupBy("size", "cell").agg(F.sum("n").alias("n"), *least).collect():  # MAX_CELLS rows for each length
        top = tops[r["size"]]
        top.low[r["cell"]], top.high[r["cell"]] = [r[e] for e in EDGES[:DIRECTIONS]], [r[e] for e in EDGES[DIRECTIONS:]]
        top.parts[r["cell"]] = -(-r["n"] // BLOCK_ROWS)
    return tops


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", confidence: float = CONFIDENCE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k vectors with the largest inner product found for each query.

    queries has the same two columns. Nearest first, ties to the smaller vec_id; a query's own id is no candidate; all
    candidates if there are fewer than k. Vectors that are null, zero, empty or hold null or non-finite components take no
    part on either side, nor do null ids. Queries meet vectors of their own length only. Rows that repeat an id and vector
    count once. Empty tables give an empty result. Columns other than the two named are not read.
    """
    data, asked = usable(vectors, vec_id, embedding), usable(queries, vec_id, embedding)
    tops = fit_top(data)
    spark = data.sparkSession
    shared = spark.sparkContext.broadcast(tops)  # MAX_CELLS boxes for each length of vectors

    def dealt_rows(size, cell, part, asked, ids, own, known, v: pa.Array) -> pa.Table:
        n = len(ids)
        make = lambda x, kind: pa.array(np.broadcast_to(np.asarray(x), n).astype(kind))
        return pa.table([make(size, np.int32), make(cell, np.int32), make(part, np.int32), make(asked, np.int32), make(ids, np.int64), make(own, np.int64), make(known, np.float64), v], names=["size", "cell", "part", "asked", "id", "own", "known", "v"])

    def place(t: pa.RecordBatch) -> pa.Table:
        """Every vector to a part of its cell."""
        out = []
        ids, salt = t.column(0).to_numpy(), t.column(2).to_numpy()
        for size, rows, m in _matrices(t.column(1)):
            top = shared.value[size]
            cell = top.cells(project(m, top.norm))
            out.append(dealt_rows(size, cell, salt[rows] % np.maximum(top.parts[cell], 1), 0, ids[rows], 0, 0, t.column(1).take(pa.array(rows))))
        return pa.concat_tables(out)

    def route(nearest_cell: bool):
        def run(t: pa.RecordBatch) -> pa.Table | None:
            """Queries to all parts of their nearest cell, or of the other cells that the stopping test leaves."""
            out = []
            ids, own = t.column(0).to_numpy(), t.column(1).to_numpy()
            known = np.nan_to_num(t.column(2).to_numpy(zero_copy_only=False).astype(np.float64), nan=-np.inf)
            quantile = chi_square_quantile(confidence, DIRECTIONS)
            for size, rows, m in _matrices(t.column(3)):
                if size not in shared.value:
                    continue
                top = shared.value[size]
                projected, scale = project_queries(m, top.norm)
                bounds = top.bounds(projected)
                first = bounds.argmin(1)
                if nearest_cell:
                    row, cell = np.arange(len(rows)), first
                else:
                    limit = quantile * np.maximum(2 * top.norm**2 - 2 * scale * known[rows], 0) + TIE
                    wanted = bounds < limit[:, None]
                    wanted[np.arange(len(rows)), first] = False
                    row, cell = np.nonzero(wanted)
                n = top.parts[cell]
                row, cell, part = np.repeat(row, n), np.repeat(cell, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = rows[row]
                out.append(dealt_rows(size, cell, part, 1, ids[at], own[at], known[at], t.column(3).take(pa.array(at))))
            return pa.concat_tables(out) if out else None

        return run

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The vectors of a part come first and are indexed; its queries stream past them."""
        key, held, part = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(c).to_numpy() for c in range(4)])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for low, high in zip(cuts, cuts[1:]):
                now, some = tuple(keys[low, :3].tolist()), batch.slice(low, high - low)
                if now != key:
                    key, held, part = now, [], None
                if not keys[low, 3]:
                    held.append(some)
                    continue
                if part is None:
                    if not held:
                        continue
                    t = pa.Table.from_batches(held)
                    part, held = Part(t.column(4).to_numpy(), next(_matrices(t.column(7)))[2], shared.value[now[0]].norm), []
                for start in range(0, some.num_rows, BLOCK_QUERIES):
                    s = some.slice(start, BLOCK_QUERIES)
                    ids, own, known = (s.column(c).to_numpy() for c in (4, 5, 6))
                    at = np.unique(np.column_stack([ids, own]), axis=0, return_index=True)[1]
                    q, found, score = part.search(ids[at], next(_matrices(s.column(7)))[2][at], k, confidence, known[at])
                    yield pa.record_batch([pa.array(ids[at][q]), pa.array(own[at][q]), pa.array(found), pa.array(score)], names=["query_id", "own", "vec_id", "score"])

    if not tops:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    salt = F.pmod(F.xxhash64("id"), F.lit(1 << 30)).alias("salt")
    placed = cut(map_chunks(data.select("id", "v", salt), place, DEALT))
    asks = asked.select("id", F.xxhash64("v").alias("own"), "v")
    best = Window.partitionBy("query_id", "own").orderBy(F.desc("score"), "vec_id")

    def searched(asks: DataFrame, nearest_cell: bool) -> DataFrame:
        routed = map_chunks(asks, route(nearest_cell), DEALT)
        dealt = placed.union(routed).repartition("size", "cell", "part").sortWithinPartitions("size", "cell", "part", "asked", "id")
        return map_arrow(dealt, answer, FOUND)

    near = cut(searched(asks.select("id", "own", F.lit(None).cast("double").alias("known"), "v"), True).distinct())
    kth = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select("query_id", F.col("own").alias("__own"), F.col("score").alias("known"))
    informed = asks.join(kth, (asks["id"] == kth["query_id"]) & (asks["own"] == kth["__own"]), "left").select("id", "own", "known", "v")
    found = near.union(searched(informed, False).distinct())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
