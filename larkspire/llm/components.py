"""Connected components of an edge list, by alternating large-star and small-star steps; small lists in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspire.llm.common import collect_garbage, cut, drop_table, map_arrow

#: Edges that a task contracts together before any shuffle.
CONTRACT_EDGES = 500_000
#: Edges of a whole graph that one task contracts, for which rounds would take many joins, and threads and memory of the driver; CONTRACT_EDGES at most.
ONE_TASK_EDGES = CONTRACT_EDGES
MAX_ROUNDS = 60


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest node of its component."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = index[: len(a)], index[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        np.minimum.at(label, before[x], low)
        np.minimum.at(label, before[y], low)
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            break
    moved = label != np.arange(len(nodes))
    return nodes[label[moved]], nodes[moved]


def _contracted(edges: DataFrame) -> DataFrame:
    """Fewer edges with the same components: each task contracts what it reads, a bounded number at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            if parts:
                a, b = contract(*(np.concatenate([p[k] for p in parts]) for k in (0, 1)))
                yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            parts.append([batch.column(k).to_numpy() for k in (0, 1)])
            size += batch.num_rows
            if size >= CONTRACT_EDGES:
                yield from out()
                parts, size = [], 0
        yield from out()

    return map_arrow(edges.select("a", "b"), run, "a bigint, b bigint")


def _least(pairs: DataFrame) -> DataFrame:
    """(u, m): m is the least of u and of all that pairs (u, v) puts beside it, aggregated before its shuffle, so hubs do no harm there."""
    return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _with_least(pairs: DataFrame, least: DataFrame) -> DataFrame:
    """pairs (u, v) with the m of their u.

    The join is on an expression of u that Spark doesn't know to be dealt out already, so that both sides get exchanges of
    their own and skewed ones, a hub's pairs, are split. It is a merge at every size: a broadcast is built in the driver,
    whose memory would hold those of all rounds until its garbage is collected.
    """
    key = F.col("u").bitwiseXOR(F.lit(1)).alias("x")
    return pairs.select(key, "u", "v").join(least.select(key, "m").hint("merge"), "x")


def _settled(edges: DataFrame) -> DataFrame:
    """Edges from each component's smallest node to its others, by rounds of stars."""
    told = None
    for _ in range(MAX_ROUNDS):
        # Large star: every larger neighbour v of u goes to u's least neighbour.
        both = edges.selectExpr("a AS u", "b AS v").union(edges.selectExpr("b AS u", "a AS v"))
        large = _with_least(both.where("v > u"), _least(both)).selectExpr("m AS a", "v AS b").distinct()
        # Small star: u and its smaller neighbours go to the least of them.
        down = large.selectExpr("b AS u", "a AS v")
        least = _least(down)
        moved = _with_least(down, least).selectExpr("m AS a", "v AS b").union(least.selectExpr("m AS a", "u AS b"))
        before, edges = edges, cut(moved.where("a != b").distinct())
        drop_table(before)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("b")).first()
        if now[0] == now[2] and tuple(now) == told:  # each node has one edge, to its component, and nothing moves
            return edges
        told = tuple(now)
    raise RuntimeError(f"components didn't settle in {MAX_ROUNDS} rounds")


def components(edges: DataFrame, contracted: bool = False) -> DataFrame:
    """(node, component) of every node that has an edge; component is its smallest reachable node.

    edges has bigint a and b. Null ends and loops are passed over, repeated edges count once. No edge gives no row.
    At most ONE_TASK_EDGES edges are contracted by one task; more take rounds of stars.
    contracted: the tasks that make the edges have contracted them already, so no further Python workers are needed for that.
    """
    edges = edges.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = cut((edges if contracted else _contracted(edges)).distinct())
    if edges.count() <= ONE_TASK_EDGES:
        before, edges = edges, cut(_contracted(edges.coalesce(1)))
        drop_table(before)
    else:
        edges = _settled(edges)
    collect_garbage(edges.sparkSession)
    roots = edges.select(F.col("a").alias("node")).distinct()
    return edges.selectExpr("b AS node", "a AS component").union(roots.selectExpr("node", "node AS component"))
