"""Near-duplicates by MinHash with tensored banding, confirmed on full shingle sets.

Two collections of HALVES small keys, each of DEPTH minhashes, are computed for a document; every pair of one key from each
is a table key. The HALVES * HALVES tables so need 2 * HALVES * DEPTH minhashes instead of HALVES * HALVES * 2 * DEPTH. At a
similarity of 0.75 one key matches with probability 0.42, so at least one of each collection, and with them a table, matches
with probability 0.999; pairs of similarity 0.1 meet with probability 0.0002.

Documents with the same set form one class, represented by its smallest id. Table rows that meet become candidate pairs of
each bucket's smallest id with the others; what meets within a task is paired before the shuffle, so a group of very many
near copies sends few rows. Candidates are verified in two steps, both on full sets:

1. Every document is compared with one partner, the one it meets in most tables: the tables count how often two documents
   meet, which grows with the sixth power of their similarity. That is one comparison for each document, however large a
   group is, and joins nearly all that belongs together. Components of these links are labels.
2. Components of all candidate pairs are clusters. A cluster with one label is done. In the others what is still apart, that is
   documents with different labels, is compared: each label of many documents is dealt in blocks of its own, the others
   share blocks, and each pair of blocks that isn't within one label meets in one call. No list of all pairs is made.

Components of the links of both steps are the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspire.llm.common import chunks, cut, give_back, map_arrow, map_chunks
from larkspire.llm.components import components, contract
from larkspire.llm.line_dedup import LOWER

SHINGLE = 5
SIMILARITY = 75  # in hundredths
HALVES, DEPTH = 14, 3
BLOCK_DOCS = 256
MEMO_WORDS = 200_000
PAIR_FLUSH = 200_000
_random = np.random.default_rng(20)
MULTIPLIERS = _random.integers(1 << 40, 1 << 63, 2 * HALVES * DEPTH, dtype=np.uint64) | np.uint64(1)
ADDENDS = _random.integers(0, 1 << 63, 2 * HALVES * DEPTH, dtype=np.uint64)
GOLD, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Shingler:
    """Distinct five-word shingles as sorted 64-bit hashes; hashes of words are remembered in a bounded table."""

    def __init__(self):
        self.memo: dict[bytes, int] = {}

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [(t or "").encode("utf-8", "replace").translate(LOWER).split() for t in texts]  # bytes split at [\x20\x09-\x0D]
        new = set().union(*split) - self.memo.keys() if split else set()
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo.clear()
            new = set().union(*split)
        for w in new:
            self.memo[w] = xxhash.xxh3_64_intdigest(w)
        return [self._set(np.fromiter(map(self.memo.__getitem__, ws), np.uint64, len(ws))) for ws in split]

    @staticmethod
    def _set(h: np.ndarray) -> np.ndarray:
        if not len(h):
            return h
        n = max(len(h) - SHINGLE + 1, 1)
        out = np.full(n, min(len(h), SHINGLE), np.uint64)
        for k in range(min(len(h), SHINGLE)):
            out = (out ^ (out >> np.uint64(31))) * GOLD + h[k : k + n]
        return np.unique((out ^ (out >> np.uint64(32))) * MIX)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minhashes (documents, 2 * HALVES * DEPTH) as uint32; every set has a member."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), len(MULTIPLIERS)), np.uint32)
    for k, (a, b) in enumerate(zip(MULTIPLIERS, ADDENDS)):
        out[:, k] = np.minimum.reduceat(flat * a + b, starts) >> np.uint64(32)
    return out


def table_keys(signature: np.ndarray) -> np.ndarray:
    """Keys (documents, HALVES * HALVES) as int64: each pair of a key of the first and one of the second collection."""
    s = signature.astype(np.uint64).reshape(len(signature), 2, HALVES, DEPTH)
    small = np.zeros(s.shape[:3], np.uint64)
    for k in range(DEPTH):
        small = (small ^ (small >> np.uint64(29))) * GOLD + s[..., k] + np.uint64(k + 1)
    number = np.arange(HALVES * HALVES, dtype=np.uint64).reshape(HALVES, HALVES)
    keys = (small[:, 0, :, None] * MIX) ^ ((small[:, 1, None, :] + number) * GOLD)
    keys = (keys ^ (keys >> np.uint64(32))) * MIX
    return (keys ^ (keys >> np.uint64(29))).reshape(len(signature), -1).view(np.int64)


def signed(docs: DataFrame) -> DataFrame:
    """did, n, h1, h2, sig of each row: the set's size, 128-bit hash and minhashes (null where it is empty)."""
    state: dict = {}

    def run(t: pa.RecordBatch) -> pa.RecordBatch:
        sets = state.setdefault("shingler", Shingler()).sets(t.column(1).to_pylist())
        digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), ">i8").astype(np.int64).reshape(-1, 2)
        full = [i for i, s in enumerate(sets) if len(s)]
        sig: list = [None] * len(sets)
        for i, row in zip(full, signatures([sets[i] for i in full]) if full else ()):
            sig[i] = row.tobytes()
        n = pa.array([len(s) for s in sets], pa.int64())
        return pa.record_batch([t.column(0), n, pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array(sig, pa.binary())], names=["did", "n", "h1", "h2", "sig"])

    return map_chunks(docs.select(F.col("doc_id").cast("bigint").alias("did"), "text"), run, "did bigint, n bigint, h1 bigint, h2 bigint, sig binary")


def _bucket_pairs(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For rows sorted by key, then node: the flags of each bucket's first row, and its pairs with the others."""
    opens = np.ones(len(keys), bool)
    opens[1:] = keys[1:] != keys[:-1]
    start = np.maximum.accumulate(np.where(opens, np.arange(len(keys)), 0))
    other = nodes[start] != nodes
    return opens, nodes[start[other]], nodes[other]


def counted(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each pair once, with the sum of its counts."""
    order = np.lexsort((a, b))
    a, b, n = a[order], b[order], n[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(new)
    return a[at], b[at], np.add.reduceat(n, at) if len(at) else n


def candidate_pairs(representatives: DataFrame) -> DataFrame:
    """(a, b, n): pairs of representatives (did, sig), a < b, that meet in n tables, a as the smallest id that b meets there.

    That is the smallest of b's chunk, if b isn't it, which in turn meets the smallest of all.
    """

    def deal(t: pa.RecordBatch) -> pa.RecordBatch:
        sig = np.frombuffer(b"".join(t.column(1).to_pylist()), np.uint32).reshape(t.num_rows, -1)
        keys = table_keys(sig).ravel()
        nodes = np.repeat(t.column(0).to_numpy(), HALVES * HALVES)
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        opens, a, b = _bucket_pairs(keys, nodes)
        # One row a bucket and chunk goes on; what met here is a pair already, dealt by its larger id.
        a, b, n = counted(a, b, np.ones(len(a), np.int64))
        keys, nodes = keys[opens], nodes[opens]
        made = np.concatenate([np.zeros(len(keys), bool), np.ones(len(a), bool)])
        none = np.zeros(len(keys), np.int64)
        columns = [np.concatenate(x) for x in ((keys, (b.view(np.uint64) * GOLD).view(np.int64)), (nodes, b), (none, a), (none, n))]
        return pa.record_batch([pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2], mask=~made), pa.array(columns[3])], names=["key", "node", "other", "n"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, first_node = None, None
        parts: list = []

        def out() -> Iterator[pa.RecordBatch]:
            if parts:
                yield pa.record_batch([pa.array(x) for x in counted(*(np.concatenate([p[k] for p in parts]) for k in range(3)))], names=["a", "b", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            made = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
            key, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if made.any():
                parts.append((batch.column(2).to_numpy(zero_copy_only=False)[made].astype(np.int64), node[made], batch.column(3).to_numpy()[made]))
                key, node = key[~made], node[~made]
            if len(key):
                if key[0] == last_key:  # the bucket goes on: put its first row before
                    key, node = np.append(last_key, key), np.append(first_node, node)
                opens, a, b = _bucket_pairs(key, node)
                parts.append((a, b, np.ones(len(a), np.int64)))
                last_key, first_node = key[-1], node[np.flatnonzero(opens)[-1]]
            if sum(len(p[0]) for p in parts) >= PAIR_FLUSH:
                yield from out()
                parts = []
        yield from out()

    dealt = map_chunks(representatives.select("did", "sig"), deal, "key bigint, node bigint, other bigint, n bigint")
    sorted_rows = dealt.repartition("key").sortWithinPartitions("key", "node")
    return map_arrow(sorted_rows, meet, "a bigint, b bigint, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))


def linked(x: np.ndarray, y: np.ndarray, similarity: int = SIMILARITY) -> bool:
    low, high = sorted((len(x), len(y)))
    if not low or 100 * low < similarity * high:
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= similarity * (len(x) + len(y) - shared)


def link_edges(sets: list[np.ndarray], nodes: np.ndarray, side: np.ndarray, similarity: int = SIMILARITY, label: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Edges that span the links among the sets; with two sides, only links between sides are looked for.

    Sets of one label are known to belong together and aren't compared.
    """
    n, two = len(sets), len(set(side.tolist())) > 1
    label = np.arange(n) if label is None else label
    if n <= 24:
        root, a, b = list(range(n)), [], []

        def find(i: int) -> int:
            while root[i] != i:
                i = root[i]
            return i

        for i in range(n):
            for j in range(i):
                if not (two and side[i] == side[j]) and label[i] != label[j] and find(i) != find(j) and linked(sets[i], sets[j], similarity):
                    root[find(i)] = find(j)
                    a.append(nodes[i]), b.append(nodes[j])
        return np.array(a, np.int64), np.array(b, np.int64)
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    _, number, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[number] > 1  # only what two sets have counts in an intersection
    rank = np.cumsum(count > 1) - 1
    column, owner = rank[number[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((n, n), np.float32)
    step = 4096
    for start in range(0, int(rank[-1]) + 1, step):
        low, high = np.searchsorted(column, [start, start + step])
        part = np.zeros((n, step), np.float32)
        part[owner[low:high], column[low:high] - start] = 1
        both += part @ part.T
    both = both.astype(np.int64)
    link = 100 * both >= similarity * (sizes[:, None] + sizes[None, :] - both)
    link &= (sizes[:, None] > 0) & (sizes[None, :] > 0)
    link &= label[:, None] != label[None, :]
    if two:
        link &= side[:, None] != side[None, :]
    i, j = np.nonzero(np.triu(link, 1))
    if not len(i):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return contract(nodes[i], nodes[j])


def partner_links(docs: DataFrame, pairs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Edges (a, b): of each b the pair with the a that it meets most often, if the two are linked; docs has did and text.

    The b of one a are dealt in blocks, with the text of a beside each block.
    """
    best = pairs.groupBy("b").agg(F.max(F.struct(F.col("n"), (-F.col("a")).alias("a"))).alias("x")).select((-F.col("x.a")).alias("a"), "b")
    sizes = best.groupBy("a").agg(F.ceil(F.count("*") / BLOCK_DOCS).cast("int").alias("blocks"))
    spread = best.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"), F.lit(1).alias("role"), F.col("b").alias("node"))
    hubs = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("role"), F.col("a").alias("node"))
    # What takes part grows with the input, so it is merged with the texts at every size and never broadcast.
    placed = spread.union(hubs)
    texts = docs.join(placed.hint("merge"), docs["did"] == placed["node"]).select("a", "block", "role", "node", "text")
    dealt = texts.repartition("a", "block").sortWithinPartitions("a", "block", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, key, hubs = Shingler(), None, []  # a document may have several texts, and so may its partner
        for batch in batches:
            for part in chunks(batch):
                a, block, role, node = (part.column(k).to_numpy() for k in range(4))
                out: list[tuple[int, int]] = []
                for i, own in enumerate(shingler.sets(part.column(4).to_pylist())):
                    if (a[i], block[i]) != key:
                        key, hubs = (a[i], block[i]), []
                    if not role[i]:
                        hubs.append(own)
                    elif any(linked(h, own, similarity) for h in hubs):
                        out.append((a[i], node[i]))
                if out:
                    yield pa.record_batch([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
        del shingler
        give_back()

    return map_arrow(dealt, run, "a bigint, b bigint")


def blocks_apart(clusters: DataFrame, labels: DataFrame) -> DataFrame:
    """component, g, i, h, j, first, label, node for what is still apart in clusters (node, component), given labels (node, component).

    Nodes meet in the pairs of blocks (g, i) <= (h, j): g and h are labels of BLOCK_DOCS nodes or more, which have blocks of their
    own, or null for the blocks that all others share. first: the node is of block (g, i), and the two differ. No pair of
    blocks is within one label. A cluster with one label has no row.
    """
    own = clusters.join(labels.select("node", F.col("component").alias("label")), "node", "left").withColumn("label", F.coalesce("label", "node"))
    # As tables their sizes are known before the joins with them are planned, so that nodes aren't shuffled by cluster for a few.
    several = cut(own.groupBy("component").agg((F.min("label") != F.max("label")).alias("apart")).where("apart").select("component"))
    own = cut(own.join(several, "component", "left_semi"))
    of_label = cut(own.groupBy("component", "label").agg(F.count("*").alias("n")))
    large = F.when(F.col("n") >= BLOCK_DOCS, F.col("label"))
    groups = of_label.groupBy("component", large.alias("g")).agg(F.ceil(F.sum("n") / BLOCK_DOCS).cast("int").alias("blocks"))
    shapes = cut(groups.groupBy("component").agg(F.collect_list(F.struct("g", "blocks")).alias("shape")))  # of each large label one
    sized = own.join(of_label, ["component", "label"]).withColumn("g", large).join(shapes, "component")
    mine = F.element_at(F.filter("shape", lambda s: s["g"].eqNullSafe(F.col("g"))), 1)["blocks"]
    placed = sized.withColumn("i", F.pmod(F.xxhash64("node"), mine).cast("int"))
    met = F.filter("shape", lambda s: s["g"].isNull() | ~s["g"].eqNullSafe(F.col("g")))
    others = F.flatten(F.transform(met, lambda s: F.transform(F.sequence(F.lit(0), s["blocks"] - 1), lambda j: F.struct(s["g"].alias("g"), j.alias("i")))))
    pairs = placed.select("component", "label", "node", F.struct("g", "i").alias("p"), F.explode(others).alias("q"))
    low, high = F.when(F.col("p") <= F.col("q"), F.col("p")).otherwise(F.col("q")), F.when(F.col("p") <= F.col("q"), F.col("q")).otherwise(F.col("p"))
    return pairs.select("component", low["g"].alias("g"), low["i"].alias("i"), high["g"].alias("h"), high["i"].alias("j"), (F.col("p") < F.col("q")).alias("first"), "label", "node")


def links_apart(docs: DataFrame, clusters: DataFrame, labels: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Edges (a, b) that span the links within clusters between documents of different labels; docs has did and text."""
    placed = blocks_apart(clusters, labels)
    texts = docs.join(placed.hint("merge"), docs["did"] == placed["node"])
    key = ["component", "g", "i", "h", "j"]
    dealt = texts.select(*key, "first", "label", "node", "text").repartition(*key).sortWithinPartitions(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, key, held = Shingler(), None, []

        def done() -> Iterator[pa.RecordBatch]:
            if len(held) > 1:
                sets = shingler.sets([h[3] for h in held])
                side, label, nodes = (np.array([h[k] for h in held], np.int64) for k in range(3))
                a, b = link_edges(sets, nodes, side, similarity, label)
                if len(a):
                    yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(5))))
            first, label, node = (batch.column(k).to_pylist() for k in (5, 6, 7))
            texts = batch.column(8)
            for i, now in enumerate(keys):
                if now != key:
                    yield from done()
                    key, held = now, []
                held.append((int(first[i]), label[i], node[i], texts[i].as_py()))
        yield from done()
        del shingler
        give_back()

    return map_arrow(dealt, run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """One row per input row of docs (doc_id, text): doc_id, n_shingles, component_id, kept.

    Words are `[^\\x20\\x09-\\x0D]+` after A-Z are lower-cased; a set has the distinct five-word shingles, or the whole
    sequence of fewer words, and is empty for null texts and texts without words, which link with nothing. Sets with
    100 * intersection >= similarity * union are linked; component_id is the smallest doc_id reachable. Rows that share a
    doc_id are one document. A row with a null doc_id links with nothing, has a null component_id and is kept. Equal
    texts always link. An empty table gives an empty result. Only the two named columns are read.
    """
    docs = docs.select("doc_id", "text")
    sets = cut(signed(docs))
    real = sets.where("did IS NOT NULL AND n > 0")
    classes = cut(real.groupBy("h1", "h2").agg(F.min("did").alias("rep")))
    # Ids that stand for several sets link them.
    shared = real.select("did", "h1", "h2").distinct().groupBy("did").agg(F.count("*").alias("c")).where("c > 1").select("did")
    repeated = real.join(shared, "did").join(classes, ["h1", "h2"]).select(F.col("rep").alias("a"), F.col("did").alias("b"))
    chosen = real.join(classes, (real["h1"] == classes["h1"]) & (real["h2"] == classes["h2"]) & (real["did"] == classes["rep"])).select("did", "sig").dropDuplicates(["did", "sig"])
    texts = docs.select(F.col("doc_id").cast("bigint").alias("did"), "text")
    pairs = cut(candidate_pairs(chosen))
    near = cut(partner_links(texts, pairs, similarity).union(repeated))
    apart = links_apart(texts, components(pairs), components(near, contracted=True), similarity)
    links = components(near.union(apart), contracted=True).withColumnRenamed("node", "rep")
    answer = classes.join(links, "rep", "left").select("h1", "h2", F.coalesce("component", "rep").alias("component"))
    joined = sets.select("did", "n", "h1", "h2").join(answer, ["h1", "h2"], "left")
    own = F.when((F.col("n") > 0) & F.col("did").isNotNull(), F.col("component")).otherwise(F.col("did"))
    kind = docs.schema["doc_id"].dataType
    out = joined.select(F.col("did").cast(kind).alias("doc_id"), F.col("n").alias("n_shingles"), own.cast(kind).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_of_each(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """docs without the rows of linked documents other than each component's smallest id; all columns pass through.

    Of rows that repeat a kept id all stay. Rows with a null id stay.
    """
    dropped = near_duplicates(docs.select("doc_id", "text"), similarity).where(~F.col("kept")).select(F.col("doc_id").alias("__drop")).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["__drop"], "left_anti")
