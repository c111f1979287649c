"""Line dedup over a range-partitioned stream of line hashes.

Each line's key is hashed to 128 bits. The rows (hash, document, position) are partitioned by ranges of (hash, document),
so that one very frequent line spreads over many partitions, and sorted by hash, document and position. A pass over each
sorted partition streams the groups, holding back no more rows of a group than decide about it. Only the first and the last
group of a partition can go on in a neighbour; their counts, at most two of a partition, are added up afterwards.

What comes back is one compressed bitmap for each document that loses lines, not its text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspire.llm.common import cut, map_arrow, map_chunks

BLANKS = b" \t\n\x0b\f\r"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
NO_ID = -(1 << 63)
FOUND = "kind int, h1 bigint, h2 bigint, did bigint, rk bigint, pos int, n bigint"
DROP, PENDING, EDGE = 0, 1, 2


def line_keys(text: str | None) -> list[bytes]:
    return [line.strip(BLANKS) for line in (text or "").encode("utf-8", "replace").translate(LOWER).split(b"\n")]


def _identified(docs: DataFrame) -> DataFrame:
    """did and rk name a row: its id (a null id is the smallest), and a hash of its id and text."""
    return docs.withColumns({"__did": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)), "__rk": F.xxhash64("doc_id", "text")})


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """A row for each line whose key has at least min_chars code points."""

    def run(t: pa.RecordBatch) -> pa.RecordBatch:
        digests, places, counts = [], [], []
        for text in t.column(2).to_pylist():
            kept = [(i, k) for i, k in enumerate(line_keys(text)) if len(k) >= min_chars and (min_chars < 2 or len(k.decode("utf-8", "replace")) >= min_chars)]
            digests += [xxhash.xxh3_128_digest(k) for _, k in kept]
            places += [i for i, _ in kept]
            counts.append(len(kept))
        h = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
        did, rk = (np.repeat(t.column(k).to_numpy(zero_copy_only=False), counts) for k in (0, 1))
        return pa.record_batch([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(did), pa.array(rk), pa.array(places, pa.int32())], names=["h1", "h2", "did", "rk", "pos"])

    return map_chunks(_identified(docs).select("__did", "__rk", "text"), run, "h1 bigint, h2 bigint, did bigint, rk bigint, pos int")


def _opens(rows: np.ndarray) -> np.ndarray:
    """Flags of the rows (h1, h2, did, rk, ..), in order, that open a document of their line: rows of an id are one, those without one go by rk."""
    new = np.ones(len(rows), bool)
    did = rows[:, 2]
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1) | ((did[1:] == NO_ID) & (rows[1:, 3] != rows[:-1, 3]))
    return new


class GroupStream:
    """Decides about the groups of one sorted partition, batch after batch."""

    def __init__(self, min_docs: int, keep_first: bool):
        self.min_docs, self.keep_first = min_docs, keep_first
        self.held: np.ndarray | None = None  # (rows, 5) of the last group, while it isn't decided
        self.key: tuple | None = None
        self.docs, self.last, self.first, self.opening = 0, None, None, True

    def _rows(self, kind: int, rows: np.ndarray, n: int = 0) -> list:
        return [np.column_stack([np.full(len(rows), kind), rows, np.full(len(rows), n)])] if len(rows) else []

    def _end_group(self, at_end: bool) -> list:
        """What to say about the group that is complete in this partition."""
        if self.key is None:
            return []
        edge, out = self.opening or at_end, []
        self.opening = False
        if edge:
            out += self._rows(EDGE, self.first[None, :], self.docs)
            if self.docs < self.min_docs:
                out += self._rows(PENDING, self.held)
            elif self.keep_first:
                out += self._rows(PENDING, self.first[None, :])
            # else its rows, all of them drops, have been said
        self.key = None
        return out

    def _whole_group(self, rows: np.ndarray) -> list:
        self.key, self.docs, self.last, self.first = (rows[0, 0], rows[0, 1]), 0, None, rows[0]
        self.held = rows[:0]
        return self._extend(rows)

    def _extend(self, rows: np.ndarray) -> list:
        """Add rows to the open group; once enough documents have it, its rows go out as drops."""
        new = _opens(rows) if self.last is None else _opens(np.vstack([self.last, rows]))[1:]
        before, self.docs, self.last = self.docs, self.docs + int(new.sum()), rows[-1]
        if self.docs < self.min_docs:
            self.held = np.concatenate([self.held, rows])
            return []
        going = rows if before >= self.min_docs else np.concatenate([self.held, rows])
        if self.keep_first and before < self.min_docs:
            going = going[1:]  # the first row stays; at an edge it waits for the neighbours
        self.held = rows[:0]
        return self._rows(DROP, going)

    def feed(self, rows: np.ndarray) -> list:
        """rows: h1, h2, did, rk, pos, sorted."""
        out = []
        starts = np.flatnonzero(np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(1)]))
        ends = np.append(starts[1:], len(rows))
        first = 0
        if self.key is not None and self.key == (rows[0, 0], rows[0, 1]):
            out += self._extend(rows[: ends[0]])
            first = 1
        if first < len(starts):
            out += self._end_group(False)
            last = len(starts) - 1
            if self.opening and first < last:  # the partition's first group can be an edge
                out += self._whole_group(rows[starts[first] : ends[first]]) + self._end_group(False)
                first += 1
            if first < last:
                a, b = starts[first], ends[last - 1]
                part, at = rows[a:b], starts[first:last] - a
                docs = np.add.reduceat(_opens(part).astype(np.int64), at)
                drop = np.repeat(docs >= self.min_docs, np.diff(np.append(at, len(part))))
                if self.keep_first:
                    drop[at] = False
                out += self._rows(DROP, part[drop])
            out += self._whole_group(rows[starts[last] : ends[last]])
        return out


def repeated_lines(docs: DataFrame, min_docs: int, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """did, rk, pos of the lines to drop."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = GroupStream(min_docs, keep_first)

        def said(parts: list) -> Iterator[pa.RecordBatch]:
            if parts:
                x = np.concatenate(parts)
                columns = [pa.array(x[:, 0].astype(np.int32)), *(pa.array(x[:, k]) for k in (1, 2, 3, 4)), pa.array(x[:, 5].astype(np.int32)), pa.array(x[:, 6])]
                yield pa.record_batch(columns, names=["kind", "h1", "h2", "did", "rk", "pos", "n"])

        for batch in batches:
            if batch.num_rows:
                yield from said(stream.feed(np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])))
        yield from said(stream._end_group(True))

    hashed = line_hashes(docs, min_chars)
    # Rows of an id that have a line meet in one partition; those without an id, of which there may be many, are spread by rk.
    dealt = hashed.repartitionByRange("h1", "did", F.when(F.col("did") == NO_ID, F.col("rk"))).sortWithinPartitions("h1", "h2", "did", "rk", "pos")
    found = cut(map_arrow(dealt, run, FOUND))
    place = F.struct("did", "rk", "pos")
    edges = found.where(F.col("kind") == EDGE).groupBy("h1", "h2").agg(F.sum("n").alias("docs"), F.min(place).alias("first"))
    edges = edges.where(F.col("docs") >= min_docs)
    pending = found.where(F.col("kind") == PENDING).join(edges, ["h1", "h2"])
    if keep_first:
        pending = pending.where(place != F.col("first"))
    return found.where(F.col("kind") == DROP).select("did", "rk", "pos").union(pending.select("did", "rk", "pos"))


def drop_bitmaps(docs: DataFrame, min_docs: int, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """__did, __rk, __dropped: the compressed bitmap of dropped lines of each document that loses any."""
    places = repeated_lines(docs, min_docs, min_chars, keep_first).groupBy("did", "rk").agg(F.collect_set("pos").alias("pos"))

    def run(t: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for pos in t.column(2):
            bits = np.zeros(max(p := pos.values.to_numpy()) + 1, bool)
            bits[p] = True
            out.append(zlib.compress(np.packbits(bits).tobytes(), 1))
        return pa.record_batch([t.column(0), t.column(1), pa.array(out, pa.binary())], names=["__did", "__rk", "__dropped"])

    return map_chunks(places, run, "__did bigint, __rk bigint, __dropped binary")


def _apply(text: str | None, dropped: bytes | None) -> tuple[int, int, str | None]:
    lines = (text or "").split("\n")
    if dropped is None:
        return len(lines), 0, text
    bits = np.unpackbits(np.frombuffer(zlib.decompress(dropped), np.uint8))[: len(lines)]
    kept = [x for i, x in enumerate(lines) if i >= len(bits) or not bits[i]]
    return len(lines), len(lines) - len(kept), "\n".join(kept)


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """docs (doc_id, text and any other columns) with the kept lines as text, and n_lines, n_dropped (long) added.

    A line's key is the line without blanks `[\\x20\\x09-\\x0D]` at its ends and with A-Z in lower case. Keys of at least
    min_chars code points found in at least min_docs documents lose all their lines; with keep_first the first line, by
    doc_id and position, stays. A null text is one empty line and stays null; an empty text stays empty. Rows that share an
    id count as one document, whatever their texts, and each loses its own lines; rows with a null id are documents by their
    text. An empty table gives an empty result. Columns of the names n_lines and n_dropped are
    replaced; all other columns pass through.
    """
    names = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    bitmaps = drop_bitmaps(docs.select("doc_id", "text"), min_docs, min_chars, keep_first)
    joined = _identified(docs.select("text", *names)).join(bitmaps, ["__did", "__rk"], "left")

    def run(t: pa.RecordBatch) -> pa.RecordBatch:
        done = [_apply(x, d) for x, d in zip(t.column("text").to_pylist(), t.column("__dropped").to_pylist())]
        more = [pa.array([d[2] for d in done], pa.string()), pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64())]
        return pa.record_batch([*(t.column(c) for c in names), *more], names=[*names, "text", "n_lines", "n_dropped"])

    from pyspark.sql.types import LongType, StringType, StructType

    schema = StructType([docs.schema[c] for c in names]).add("text", StringType()).add("n_lines", LongType()).add("n_dropped", LongType())
    return map_chunks(joined.select(*names, "text", "__dropped"), run, schema)
