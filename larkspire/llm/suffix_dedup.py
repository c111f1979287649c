"""Exact substring dedup: a depth-limited most-significant-digit radix sort of suffixes.

Only suffixes' first THRESHOLD bytes are ever looked at, and groups of suffixes that are equal so far are refined digit by
digit; those that are equal after THRESHOLD bytes are exactly the repeated windows.

The first digit of a window is the one of its 32-byte strings with the least hash (the leftmost of equals), with its place
in the window. It depends on the window's content alone, so equal windows fall in one group, and neighbouring windows
mostly share it: a text is a row of short runs of windows with one digit string each. Only the runs are dealt out, as a
hash of the digit, a hash of the run's whole content, and places. Runs that are equal as a whole are settled by those hashes (the
first stays, the others are repeats); a task settles what it holds before the shuffle. For digits that occur in different
runs the content is fetched, grouped by a second digit of 83 or more bytes and refined by passes over 8-byte digits.

Runs are dealt out by ranges of (digit, content), so a digit that very many texts have spreads over tasks. One with more than
HOT_RUNS different contents would make groups too large for a task's memory: its windows take their remaining bytes as one
last digit, a 128-bit hash, and the first of each is found by an aggregation that combines before its shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspire.llm.common import cut, map_arrow, map_chunks
from larkspire.llm.line_dedup import NO_ID

THRESHOLD = 100
DIGIT = 32
REACH = THRESHOLD - DIGIT  # the digit's place in a window is 0 to REACH
CLASSES = 4
#: A text is handled in blocks of so many windows; places in a block must fit PLACE_BITS.
BLOCK, PLACE_BITS = 1 << 19, 20
#: Runs of windows that are refined together.
TOGETHER = 30_000
#: Different contents of a digit that are still compared in one task.
HOT_RUNS = 20_000
_random = np.random.default_rng(32)
BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FACTORS = _random.integers(0, 1 << 63, 5, dtype=np.uint64) | np.uint64(1)
MIX = np.uint64(0xD6E8FEB86659FD93)
LOW = np.uint64((1 << PLACE_BITS) - 1)


def digit_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each 32-byte string."""
    h = BYTE[data]
    for k, factor in enumerate(FACTORS):
        step = 1 << k
        h = h[:-step] * factor + h[step:]
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(29))


def window_digits(hashes: np.ndarray) -> np.ndarray:
    """For each window the place of its digit: least hash, leftmost of equals."""
    v = (hashes & ~LOW) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= REACH + 1:
        v = np.minimum(v[:-width], v[width:])
        width *= 2
    rest = REACH + 1 - width
    if rest:
        v = np.minimum(v[:-rest], v[rest:])
    return (v & LOW).astype(np.int64)


def runs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Runs of windows with the same digit place: first window, number of windows, digit place, digit hash, content hash."""
    starts, counts, places, keys = [], [], [], []
    for begin in range(0, len(data) - THRESHOLD + 1, BLOCK):
        part = np.frombuffer(data, np.uint8)[begin : begin + BLOCK + THRESHOLD - 1]
        h = digit_hashes(part)
        at = window_digits(h)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        starts.append(first + begin)
        counts.append(np.diff(np.append(first, len(at))))
        places.append(at[first] + begin)
        keys.append(h[at[first]])
    if not starts:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, []
    a, n, p, k = (np.concatenate(x) for x in (starts, counts, places, keys))
    content, view = xxhash.xxh3_64_intdigest, memoryview(data)
    return a, n, p, k.view(np.int64), [content(view[x:y]) for x, y in zip(a.tolist(), (a + n + (THRESHOLD - 1)).tolist())]


def merged(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of each owner, with those that touch or overlap made one."""
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], end[order]
    if not len(owner):
        return owner, start, end
    change = np.concatenate([[True], owner[1:] != owner[:-1]])
    group = np.cumsum(change) - 1
    shift = group * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + shift) - shift
    new = change.copy()
    new[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return owner[at], start[at], reach[np.append(at[1:], len(owner)) - 1]


RUNS = "key bigint, content bigint, did bigint, rk bigint, start int, n int, place int"


def _deal_runs(t: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of RUNS; repeats that are settled here come as rows whose n is negative: bytes start to -n, dealt by document."""
    did, rk = (t.column(k).to_numpy() for k in (0, 1))
    found = [runs((x or "").encode("utf-8", "replace")) for x in t.column(2).to_pylist()]
    sizes = [len(f[0]) for f in found]
    a, n, p, key = (np.concatenate([f[k] for f in found]) for k in range(4))
    content = np.array([x for f in found for x in f[4]], np.uint64).view(np.int64)
    row = np.repeat(np.arange(len(found)), sizes)
    order = np.lexsort((a, rk[row], did[row], content, key))
    a, n, p, key, content, row = (x[order] for x in (a, n, p, key, content, row))
    same = np.zeros(len(a), bool)
    same[1:] = (key[1:] == key[:-1]) & (content[1:] == content[:-1])
    first = np.maximum.accumulate(np.where(~same, np.arange(len(a)), 0))
    elsewhere = (did[row] != did[row[first]]) | (rk[row] != rk[row[first]]) | (a != a[first])
    repeat, keep = same & elsewhere, ~same
    owner, start, end = merged(row[repeat], a[repeat], a[repeat] + n[repeat] + THRESHOLD - 1)
    row = np.concatenate([row[keep], owner])
    parts = [(key[keep], did[owner] * 31 + start), (content[keep], np.zeros(len(owner), np.int64)), (did[row],), (rk[row],)]
    small = [(a[keep], start), (n[keep], -end), ((p - a)[keep], np.zeros(len(owner), np.int64))]
    columns = [pa.array(np.concatenate(x)) for x in parts] + [pa.array(np.concatenate(x).astype(np.int32)) for x in small]
    return pa.record_batch(columns, names=["key", "content", "did", "rk", "start", "n", "place"])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From runs sorted by key, content and place: repeats (n negative), and the first of each content of keys with several.

    A partition's first and last key may go on in its neighbours, so they count as keys with several.
    """
    last: tuple | None = None  # key, content and first place of the open group
    waiting: pa.RecordBatch | None = None  # its first run, while the key has no other content
    for batch in batches:
        if not batch.num_rows:
            continue
        n = batch.column(5).to_numpy()
        settled = n < 0
        if settled.any():
            yield batch.filter(pa.array(settled))
            batch = batch.filter(pa.array(~settled))
            if not batch.num_rows:
                continue
        key, content, did, rk, start, n = (batch.column(k).to_numpy() for k in range(6))
        size = len(key)
        new_key, new = np.ones(size, bool), np.ones(size, bool)
        new_key[1:] = key[1:] != key[:-1]
        new[1:] = new_key[1:] | (content[1:] != content[:-1])
        goes_on = last is not None and key[0] == last[0]
        new_key[0] = not goes_on
        new[0] = not (goes_on and content[0] == last[1])
        first = np.maximum.accumulate(np.where(new, np.arange(size), -1))
        fd, fr, fs = (np.where(first >= 0, x[np.maximum(first, 0)], y) for x, y in zip((did, rk, start), last[2:] if last else (0, 0, 0)))
        repeat = ~new & ((did != fd) | (rk != fr) | (start != fs))
        if repeat.any():
            end = start[repeat] + n[repeat] + THRESHOLD - 1
            out = batch.filter(pa.array(repeat))
            yield out.set_column(5, "n", pa.array((-end).astype(np.int32)))
        # The first run of each content goes on if its key has another content, before or after.
        heads = np.flatnonzero(new)
        if len(heads):
            opens = new_key[heads]
            group = np.cumsum(opens)  # 0: the key that was open before
            several = np.bincount(group) > 1
            if goes_on:
                several[0] = True  # a head of the open key is another content of it
            elif last is None:
                several[1] = True  # the partition's first key
            if waiting is not None and goes_on and group[0] == 0:
                yield waiting  # else its key has ended with one content
            wanted = several[group]
            tail = group == group[-1]
            hold = int(tail.sum()) == 1 and not wanted[-1]
            if wanted.any():
                yield batch.take(pa.array(heads[wanted]))
            waiting = batch.slice(heads[-1], 1) if hold else None
        last = (key[-1], content[-1], fd[-1], fr[-1], fs[-1])
    if waiting is not None:
        yield waiting


def _window_rows(t: pa.RecordBatch) -> pa.RecordBatch:
    """The windows of runs, each with a hash of all its bytes."""
    digests, rows, starts = [], [], []
    for row, (text, wanted) in enumerate(zip(t.column(2).to_pylist(), t.column(3).to_pylist())):
        data = (text or "").encode("utf-8", "replace")
        for w in wanted:
            for s in range(w["start"], w["start"] + w["n"]):
                digests.append(xxhash.xxh3_128_digest(data[s : s + THRESHOLD]))
                rows.append(row), starts.append(s)
    h = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
    did, rk = (t.column(k).to_numpy()[np.array(rows, np.int64)] for k in (0, 1))
    return pa.record_batch([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(did), pa.array(rk), pa.array(starts, pa.int32())], names=["w1", "w2", "did", "rk", "start"])


def _content_rows(t: pa.RecordBatch) -> pa.RecordBatch:
    """For each wanted run its windows by class of digit place, with their bytes and the second digit's hash."""
    keys, places, starts, counts, offsets, bodies, rows = [], [], [], [], [], [], []
    width = -(-(REACH + 1) // CLASSES)
    for row, (text, wanted) in enumerate(zip(t.column(2).to_pylist(), t.column(3).to_pylist())):
        data = (text or "").encode("utf-8", "replace")
        for w in wanted:
            place, a, n = w["start"] + w["place"], w["start"], w["n"]
            for c in range(CLASSES):
                low, high = c * width, min(c * width + width - 1, REACH)
                s, e = max(a, place - high), min(a + n - 1, place - low)  # windows with the digit at low to high
                if s <= e:
                    keys.append(xxhash.xxh3_64_intdigest(data[place - low : place - high + THRESHOLD], w["key"] & 0xFFFFFFFF) ^ c)
                    rows.append(row), starts.append(s), counts.append(e - s + 1), offsets.append(place - s), bodies.append(data[s : e + THRESHOLD])
    row = np.array(rows, np.int64)
    did, rk = (t.column(k).to_numpy()[row] for k in (0, 1))
    key = np.array(keys, np.uint64).view(np.int64)
    return pa.record_batch([pa.array(key), pa.array(did), pa.array(rk), *(pa.array(x, pa.int32()) for x in (starts, counts, offsets)), pa.array(bodies, pa.binary())], names=["key", "did", "rk", "start", "n", "place", "body"])


def repeated_windows(key: np.ndarray, did: np.ndarray, rk: np.ndarray, start: np.ndarray, n: np.ndarray, place: np.ndarray, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Radix passes over the windows of runs: (run, window) of every window that occurs at an earlier place, too."""
    run = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    # First digits: the key and the digit's place in the window.
    group = np.unique(np.column_stack([key[run], place[run] - inside]), axis=0, return_inverse=True)[1].ravel()
    body = np.frombuffer(b"".join(bodies) + bytes(8), np.uint8)
    at = (np.cumsum([0] + [len(b) for b in bodies])[:-1])[run] + inside
    words = [*range(0, THRESHOLD - 7, 8)]
    words += [THRESHOLD - 8] if THRESHOLD % 8 else []
    order_of_digits = [w for pair in zip(words, reversed(words)) for w in pair][: len(words)]  # from both ends inwards
    alive = np.arange(len(run))

    def refine(alive: np.ndarray, group: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((digit, group))
        g, d = group[order], digit[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
        label = np.cumsum(new) - 1
        many = np.bincount(label)[label] > 1
        return alive[order][many], label[many]

    alive, group = refine(alive, group, np.zeros(len(group), np.uint64))
    for w in order_of_digits:
        if not len(alive):
            break
        digit = np.zeros(len(alive), np.uint64)
        for k in range(8):
            digit = (digit << np.uint64(8)) | body[at[alive] + w + k]
        alive, group = refine(alive, group, digit)
    if not len(alive):
        return alive, alive
    r, s = run[alive], start[run[alive]] + inside[alive]
    order = np.lexsort((s, rk[r], did[r], group))
    r, s, group = r[order], s[order], group[order]
    new = np.ones(len(r), bool)
    new[1:] = group[1:] != group[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(r)), 0))
    later = (did[r] != did[r[first]]) | (rk[r] != rk[r[first]]) | (s != s[first])
    return r[later], s[later]


def _refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From content rows sorted by key: intervals of repeated bytes."""
    held: list[pa.RecordBatch] = []

    def work(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key, did, rk, start, n, place = (t.column(k).to_numpy() for k in range(6))
        if len(key) < 2:
            return
        many = np.zeros(len(key), bool)
        same = key[1:] == key[:-1]
        many[1:] |= same
        many[:-1] |= same
        if not many.any():
            return
        pick = np.flatnonzero(many)
        bodies = t.column(6).take(pa.array(pick)).to_pylist()
        r, s = repeated_windows(key[pick], did[pick], rk[pick], start[pick], n[pick], place[pick], bodies)
        if len(r):
            owners, owner = np.unique(np.column_stack([did[pick][r], rk[pick][r]]), axis=0, return_inverse=True)
            o, a, b = merged(owner.ravel(), s.astype(np.int64), s.astype(np.int64) + THRESHOLD)
            yield pa.record_batch([pa.array(owners[o, 0]), pa.array(owners[o, 1]), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], names=["did", "rk", "start", "end"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) >= TOGETHER:
            t = pa.Table.from_batches(held)
            key = t.column(0).to_numpy()
            cut_at = int(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))[-1])  # the last key may go on
            if cut_at:
                yield from work(t.slice(0, cut_at))
                held = t.slice(cut_at).to_batches()
    if held:
        yield from work(pa.Table.from_batches(held))


def _placed(docs: DataFrame) -> DataFrame:
    """did, rk, text; rk tells rows apart that share an id, and is 0 throughout if none do."""
    did = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("did")
    clash = docs.select(did).groupBy("did").agg(F.count("*").alias("c")).where("c > 1").limit(1).count()
    return docs.select(did, (F.xxhash64("doc_id", "text") if clash else F.lit(0).cast("bigint")).alias("rk"), "text")


def repeated_bytes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """_placed(docs), and its repeated intervals: did, rk, start, end. Intervals of a document may overlap."""
    placed = _placed(docs)
    # Ranges have no number of their own: spark.sql.shuffle.partitions holds, as for any other exchange.
    dealt = map_chunks(placed, _deal_runs, RUNS).repartitionByRange("key", "content").sortWithinPartitions("key", "content", "did", "rk", "start")
    settled = cut(map_arrow(dealt, _settle, RUNS))
    plain = settled.where("n < 0").select("did", "rk", "start", (-F.col("n")).alias("end"))
    several = settled.where("n > 0")
    # As a table its size is known before the joins with it are planned, so the runs aren't shuffled for a few keys or none.
    hot = cut(several.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > HOT_RUNS).select("key"))

    def of_document(runs_: DataFrame) -> DataFrame:
        return placed.join(runs_.groupBy("did", "rk").agg(F.collect_list(F.struct("key", "start", "n", "place")).alias("wanted")), ["did", "rk"]).select("did", "rk", "text", "wanted")

    hashed = cut(map_chunks(of_document(several.join(hot, "key")), _window_rows, "w1 bigint, w2 bigint, did bigint, rk bigint, start int"))
    place = F.struct("did", "rk", "start")
    first = hashed.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.count("*").alias("c")).where("c > 1")
    again = hashed.join(first, ["w1", "w2"]).where(place != F.col("first")).select("did", "rk", "start", (F.col("start") + THRESHOLD).alias("end"))
    wanted = several.join(hot, "key", "left_anti")
    content = map_chunks(of_document(wanted), _content_rows, "key bigint, did bigint, rk bigint, start int, n int, place int, body binary")
    refined = map_arrow(content.repartition("key").sortWithinPartitions("key"), _refine, "did bigint, rk bigint, start int, end int")
    return placed, plain.union(refined).union(again)


def dedup_substrings(docs: DataFrame, digests: bool = False) -> DataFrame:
    """One row per input row of docs (doc_id, text): doc_id, n_bytes, n_removed, n_spans, and kept (binary) or kept_sha256.

    Every byte covered by a 100-byte string that also starts earlier (in a document with a smaller id, or earlier in the
    same one) is removed; strings are judged on the input. A null text is empty, and texts under 100 bytes lose nothing.
    A null id comes first. Rows that repeat both id and text are one document and get the same result; other rows that
    share an id are ordered by a hash of their text. An empty table gives an empty result. Other columns are not read.
    """
    placed, intervals = repeated_bytes(docs.select("doc_id", "text"))
    spans = intervals.groupBy("did", "rk").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = placed.join(spans, ["did", "rk"], "left").select("did", "text", "spans")

    def run(t: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, spans in zip(t.column(1).to_pylist(), t.column(2)):
            data, removed, n = (text or "").encode("utf-8", "replace"), 0, 0
            kept = data
            if spans.is_valid and len(spans):
                start, end = (spans.values.field(k).to_numpy().astype(np.int64) for k in (0, 1))
                _, start, end = merged(np.zeros(len(start), np.int64), start, end)
                n, removed = len(start), int((end - start).sum())
                edges = [0, *np.column_stack([start, end]).ravel().tolist(), len(data)]
                kept = b"".join(data[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2))
            out.append((len(data), removed, n, sha256(kept).hexdigest() if digests else kept))
        ids = pa.array([None if x == NO_ID else x for x in t.column(0).to_pylist()], pa.int64())
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string() if digests else pa.binary())
        return pa.record_batch([ids, *(pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds))], names=names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256" if digests else "kept"]
    return map_chunks(joined, run, f"doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, {names[4]} {'string' if digests else 'binary'}")
