"""Benchmark decontamination by template canonicalisation.

Words are turned into templates: numbers, names (capitalised words inside a sentence) and units beside a number become typed
placeholders, and other words are lower-cased without their punctuation. Five-token windows of benchmark templates and of
documents are hash-joined, and an item counts as leaked in a document if at least 75 of 100 of its windows occur there. Then
the slots are checked: the windows that match must agree on what each placeholder of the item stands for, so a question whose
numbers or names were exchanged throughout is found, while text that only shares the shape, with one slot filled in
conflicting ways, is not. They agree if all matching windows of the text together do, or those of one occurrence of the item,
as a text may hold an item several times, filled differently each time.

An item of under five template tokens says too little as a template. It is looked for as it stands: its words in sequence,
without regard to case and punctuation.

The join is one of hashes on both sides, in three steps that no frequent window makes large:

1. Documents send the windows that a Bloom filter of all benchmark windows lets through. The filter has FILTER_BITS bits at most,
   however large the benchmark is, and loses nothing.
2. Of each item the rarest windows, just so many that 75 of 100 cannot be reached without any of them, are joined with
   those of the documents: this gives the pairs of a document and an item that can match at all.
3. For these pairs alone the item's windows meet the document's, and each pair is judged by itself.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspire.llm.common import cut, map_arrow, map_chunks

WINDOW = 5
SIMILARITY = 0.75
#: Bits of the filter that is broadcast, at most (16 MB), and for each benchmark window, at least.
FILTER_BITS, BITS_PER_WINDOW = 1 << 27, 32
#: A piece of the filter, as it is put together.
PIECE_BITS = 1 << 16
MEMO_WORDS = 200_000
#: Words of texts that are looked at together.
GROUP_WORDS = 1 << 15
#: Units of measure that are canonicalised, lower case, after punctuation is taken off.
UNITS = frozenset("mm cm m km in ft yd mi mg g kg lb lbs oz ml l s sec min h hr hrs ms hz khz mhz ghz w kw v j kj cal kcal pa kpa usd eur gbp km/h mph kmh percent % $ € £ ° °c °f".split())
NUMBER = re.compile(r"[-+]?(?:\d+(?:[.,:/]\d+)*)(?:st|nd|rd|th|%)?")
NUMBER_UNIT = re.compile(r"([$€£]?[-+]?\d+(?:[.,]\d+)*)([a-zµ°%€$£/]+)")
TRIM = re.compile(r"^[\W_]+|[\W_]+$")
STOPS = (".", "!", "?", ":", ";")
CLOSERS = "\"')]}»”’"
ENDS = frozenset((*STOPS, *CLOSERS))
#: ASCII characters that TRIM takes off; what else it takes off is left to it.
PUNCTUATION = string.punctuation
NUM, NAME, UNIT = "<num>", "<name>", "<unit>"
KIND = {NUM: 1, NAME: 2, UNIT: 3}


def template(word: str, opens: bool, beside: bool = True) -> list[tuple[str, str | None]]:
    """The template tokens of a word, each with the value that a placeholder hides.

    opens: it starts a sentence. beside: the word before or after it is a number.
    """
    core = TRIM.sub("", word)
    low = core.lower()
    if beside and (low in UNITS or word.lower() in UNITS):
        return [(UNIT, low or word)]
    if not core:
        return []
    if NUMBER.fullmatch(low):
        return [(NUM, low)]
    if (m := NUMBER_UNIT.fullmatch(low)) and m[2] in UNITS:
        return [(NUM, m[1]), (UNIT, m[2])]
    if not opens and core[0].isupper():
        return [(NAME, low)]
    return [(low, None)]


def ends_sentence(word: str) -> bool:
    return word.rstrip(CLOSERS).endswith(STOPS)


def is_number(word: str) -> bool:
    return any(map(str.isdigit, word)) and NUMBER.fullmatch(TRIM.sub("", word).lower()) is not None


def at_place(words: list[str], i: int) -> list[tuple[str, str | None]]:
    """The template tokens of words[i] where it stands."""
    beside = (i > 0 and is_number(words[i - 1])) or (i + 1 < len(words) and is_number(words[i + 1]))
    return template(words[i], i == 0 or ends_sentence(words[i - 1]), beside)


def canonical(text: str) -> list[tuple[str, str | None]]:
    words = text.split()
    return [t for i in range(len(words)) for t in at_place(words, i)]


class Numbers(dict):
    """word -> number, in order of appearance; new holds the words that came since it was last emptied."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Canonicaliser:
    """Texts to rows of 64-bit token ids; placeholders have the ids in KIND. Words are remembered in a bounded table."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.memo = Numbers()
        #: By number, by whether a number is beside it, template tokens or the words themselves, and by whether a sentence
        #: opens there: first and second token, 0 for none.
        self.tokens = np.zeros((1024, 2, 2, 2, 2), np.uint64)
        self.stops, self.numeric = np.zeros(1024, bool), np.zeros(1024, bool)

    @staticmethod
    def ident(token: str) -> int:
        return KIND.get(token) or xxhash.xxh3_64_intdigest(token.encode("utf-8", "replace")) | 8

    def learn(self) -> None:
        """Fill in the rows of the words that are new."""
        new, self.memo.new = self.memo.new, []
        first, end = len(self.memo) - len(new), len(self.memo)
        while end > len(self.tokens):
            self.tokens, self.stops, self.numeric = (np.concatenate([x, np.zeros_like(x)]) for x in (self.tokens, self.stops, self.numeric))
        # Most words are letters between punctuation, or punctuation alone: quick, as template() says of them.
        plain, ids, names, stops = [], [], [], []
        digest = xxhash.xxh3_64_intdigest
        for n, w in enumerate(new, first):
            if w[-1] in ENDS and ends_sentence(w):
                stops.append(n)
            core = w.strip(PUNCTUATION)
            if core.isalpha():
                low = core.lower()
                if low not in UNITS:
                    plain.append(n)
                    ids.append(digest(low) | 8)
                    if core[0].isupper():
                        names.append(n)
                    continue
            elif not core and w not in UNITS:
                continue
            self.tokens[n] = self.cases(w)
            self.numeric[n] = is_number(w)
        self.stops[stops] = True
        self.tokens[plain, :, :, :, 0] = np.array(ids, np.uint64)[:, None, None, None]
        self.tokens[names, :, 0, 0, 0] = KIND[NAME]

    def cases(self, word: str) -> list:
        """The row of tokens of a word, as template() makes it for each case."""
        out = []
        for beside in (False, True):
            made = [template(word, opens, beside) for opens in (False, True)]
            ids = [[[self.ident(v if literal and v is not None else t) for t, v in parts] for parts in made] for literal in (False, True)]
            out.append([[(x + [0, 0])[:2] for x in rows] for rows in ids])
        return out

    def encode(self, texts: list[list[str]], literal: bool) -> tuple[np.ndarray, np.ndarray | None, np.ndarray, np.ndarray, np.ndarray]:
        """Of the words of some texts, one after the other: template ids, ids of the words themselves (if literal), for each
        the number of its word and of its text, and where the words of each text start."""
        if len(self.memo) > MEMO_WORDS:
            self.clear()
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        total = int(lengths.sum())
        numbers = np.fromiter(map(self.memo.__getitem__, chain.from_iterable(texts)), np.int64, total)
        self.learn()
        text_of = np.repeat(np.arange(len(texts)), lengths)
        same = text_of[1:] == text_of[:-1]
        opens, beside = np.ones(total, np.int64), np.zeros(total, np.int64)
        opens[1:] = self.stops[numbers[:-1]] | ~same
        numeric = self.numeric[numbers]
        beside[1:] |= numeric[:-1] & same
        beside[:-1] |= numeric[1:] & same
        pairs = self.tokens[numbers, beside, 0, opens]
        there = pairs != 0
        word_of = np.repeat(np.arange(total), there.sum(1))
        own = self.tokens[numbers, beside, 1, opens][there] if literal else None
        return pairs[there], own, word_of, text_of[word_of], np.cumsum(lengths) - lengths


def windows(ids: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Hashes of all windows of so many tokens; those of different sizes don't meet."""
    n = len(ids) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    h = ids[:n] * np.uint64(2 * size + 1)
    for k in range(1, size):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + n]
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def values_of(words: list[str], word_of: np.ndarray, start: int, size: int, first: int) -> list[str | None]:
    """What the placeholders hide in the window at start, null for other tokens. first: the number of words[0] in word_of."""
    out = []
    for k in range(start, start + size):
        parts = at_place(words, int(word_of[k]) - first)
        out.append(parts[1 if len(parts) > 1 and k and word_of[k - 1] == word_of[k] else 0][1])
    return out


ITEMS = "ik bigint, item_id bigint, n_tokens int, place int, w bigint, own array<string>"


def item_windows(benchmark: DataFrame) -> DataFrame:
    """The windows of the benchmark (item_id, text), rows of ITEMS: own has kind:value for each placeholder.

    ik tells rows apart, so repeated items are items of their own. Nulls and texts without words have no windows.
    """
    rows = benchmark.select(F.monotonically_increasing_id().alias("ik"), F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))

    def run(t: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for ik, item, text in zip(*(t.column(k).to_pylist() for k in range(3))):
            tokens = canonical(text)
            short = len(tokens) < WINDOW
            size = min(len(tokens), WINDOW)
            ids = np.array([Canonicaliser.ident(v if short and v is not None else x) for x, v in tokens], np.uint64)
            own = [None if v is None else f"{x}:{v}" for x, v in tokens]
            out += [(ik, item, len(tokens), i, w, own[i : i + size]) for i, w in enumerate(windows(ids, size).view(np.int64).tolist() if size else ())]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string()))
        return pa.record_batch([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=["ik", "item_id", "n_tokens", "place", "w", "own"])

    return map_chunks(rows.where("item_id IS NOT NULL AND text IS NOT NULL"), run, ITEMS)


PROBES = 3


def probe(w: np.ndarray, bits: int, k: int) -> np.ndarray:
    """The k-th of PROBES places in the filter for each window; bits is a power of two."""
    w = w.view(np.uint64)
    x = w if k == 0 else w >> np.uint64(23) if k == 1 else (w * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(36)
    return (x & np.uint64(bits - 1)).astype(np.int64)


def window_filter(items: DataFrame, n: int) -> np.ndarray:
    """The bits, as bytes, of a Bloom filter of the n windows of items: put together in pieces by tasks, FILTER_BITS at most."""
    bits = PIECE_BITS
    while bits < min(FILTER_BITS, BITS_PER_WINDOW * n):
        bits *= 2

    def places(t: pa.RecordBatch) -> pa.RecordBatch:
        found = np.unique(np.concatenate([probe(t.column(0).to_numpy(), bits, k) for k in range(PROBES)]))
        return pa.record_batch([pa.array(found // PIECE_BITS), pa.array(found % PIECE_BITS)], names=["piece", "bit"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[int, np.ndarray] = {}
        for batch in batches:
            piece, bit = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for p in np.unique(piece).tolist():
                pieces.setdefault(p, np.zeros(PIECE_BITS, bool))[bit[piece == p]] = True
        yield pa.record_batch([pa.array(list(pieces), pa.int64()), pa.array([np.packbits(x).tobytes() for x in pieces.values()], pa.binary())], names=["piece", "bits"])

    set_ = map_chunks(items.select("w"), places, "piece bigint, bit bigint").distinct().repartition("piece")
    out = np.zeros(bits // 8, np.uint8)
    for r in map_arrow(set_, join, "piece bigint, bits binary").collect():  # FILTER_BITS / 8 bytes at most
        out[r["piece"] * PIECE_BITS // 8 : (r["piece"] + 1) * PIECE_BITS // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def passes(bits: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The places in w of the windows that the filter lets through."""
    at = np.arange(len(w))
    for k in range(PROBES):
        p = probe(w[at], 8 * len(bits), k)
        at = at[(bits[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1 == 1]
    return at


def row_keys(docs: DataFrame) -> list[Column]:
    """dk and rk: rows with the same id and text have the same keys, all others different ones."""
    return [F.xxhash64("doc_id", "text").alias("dk"), F.xxhash64("text", F.lit(5)).alias("rk")]


def groups(texts: list[list[str]]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about GROUP_WORDS words in all, so that arrays stay small; a single text may be longer."""
    low = words = 0
    for i, text in enumerate(texts):
        words += len(text)
        if words >= GROUP_WORDS:
            yield low, i + 1
            low, words = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


def document_windows(docs: DataFrame, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """dk, rk, place, w, vals: the windows of documents that pass the filter; sizes are those of the short items."""
    shared = docs.sparkSession.sparkContext.broadcast((bits, tuple(sizes)))  # FILTER_BITS / 8 bytes at most
    state: dict = {}

    def run(t: pa.RecordBatch) -> pa.RecordBatch:
        (bits, sizes), reader = shared.value, state.setdefault("reader", Canonicaliser())
        texts = [(x or "").split() for x in t.column(2).to_pylist()]
        row, places, found, values = [], [], [], []
        for low, high in groups(texts):
            ids, own, word_of, text_of, starts = reader.encode(texts[low:high], bool(sizes))
            first = np.searchsorted(text_of, np.arange(high - low))
            for size in (WINDOW, *sizes):
                w = windows(ids if size == WINDOW else own, size)
                at = passes(bits, w)
                at = at[text_of[at] == text_of[at + size - 1]]
                where = text_of[at]
                row.append(low + where)
                places.append(at - first[where])
                found.append(w[at])
                values += [values_of(texts[low + i], word_of, k, size, int(starts[i])) for k, i in zip(at.tolist(), where.tolist())]
        row, places, found = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (row, places, found))
        keys = [t.column(k).take(pa.array(row)) for k in (0, 1)]
        return pa.record_batch([*keys, pa.array(places.astype(np.int32)), pa.array(found.view(np.int64)), pa.array(values, pa.list_(pa.string()))], names=["dk", "rk", "place", "w", "vals"])

    return map_chunks(docs.select(*row_keys(docs), "text"), run, "dk bigint, rk bigint, place int, w bigint, vals array<string>", done=state.clear)


def slots_agree(own: list[list[str | None]], vals: list[list[str | None]]) -> tuple[bool, int]:
    """Whether matching windows fill the item's slots consistently, and how many of the values differ from the item's.

    own, vals: of each match the item's placeholders (kind:value) and the values in the text. A value of the item, say a name,
    must stand for one value throughout; a quarter of the fillings may disagree, for the edits that a near copy has.
    """
    votes: dict[str, dict[str, int]] = {}
    for mine, theirs in zip(own, vals):
        for slot, value in zip(mine, theirs):
            if slot is not None and value is not None:
                seen = votes.setdefault(slot, {})
                seen[value] = seen.get(value, 0) + 1
    total = sum(sum(v.values()) for v in votes.values())
    agreed = sum(max(v.values()) for v in votes.values())
    changed = sum(max(v, key=lambda x: (v[x], x)) != slot.partition(":")[2] for slot, v in votes.items())
    return agreed >= SIMILARITY * total, changed


def judge(item: tuple[np.ndarray, np.ndarray, list], text: tuple[np.ndarray, np.ndarray, list], n_tokens: int, similarity: float) -> tuple[int, int, int] | None:
    """(matched windows, windows, changed slots) if the text holds the item; each of the two is (places, windows, slots).

    First all matching windows are judged together. If they disagree, occurrences are judged, each an alignment (place in the
    text - place in the item) with what lies around it: first just there, then with words put in or left out, up to half the
    item's length, which keeps the next variant of the item apart. Each window of the item counts at its place closest to
    that alignment.
    """
    (at, w, own), (place, v, vals) = item, text
    distinct = len(np.unique(w))
    need = similarity * distinct
    order = np.argsort(w, kind="stable")
    low, high = np.searchsorted(w[order], v, "left"), np.searchsorted(w[order], v, "right")
    source = np.repeat(np.arange(len(v)), high - low)
    target = order[np.concatenate([np.arange(a, b) for a, b in zip(low, high)])] if len(source) else source
    matched = len(np.unique(w[target]))
    if matched < need or not matched:
        return None
    agree, changed = slots_agree([own[i] for i in target], [vals[i] for i in source])
    if agree:
        return matched, distinct, changed
    shift = place[source] - at[target]
    order = np.lexsort((at[target], shift))
    source, target, shift = source[order], target[order], shift[order]
    best = None
    for slack in (0, max(n_tokens // 2, 1)):
        for s in np.unique(shift):
            a, b = np.searchsorted(shift, (s - slack, s + slack + 1))
            if b - a < need:
                continue
            near = a + np.argsort(np.abs(shift[a:b] - s), kind="stable")
            near = near[np.unique(at[target[near]], return_index=True)[1]]
            if len(np.unique(w[target[near]])) >= need:
                agree, changed = slots_agree([own[i] for i in target[near]], [vals[i] for i in source[near]])
                if agree and (best is None or changed < best):
                    best = changed
    return None if best is None else (matched, distinct, best)


FOUND = "dk bigint, rk bigint, item_id bigint, n_matched bigint, n_windows bigint, n_changed bigint"


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Rows of FOUND: each pair of a document (dk, rk as in row_keys) and an item that it holds, as a table of its own."""
    items = cut(item_windows(benchmark))
    facts = items.agg(F.count("*").alias("n"), F.collect_set(F.when(F.col("n_tokens") < WINDOW, F.col("n_tokens"))).alias("short")).first()  # short: four numbers at most
    hits = cut(document_windows(docs, window_filter(items, facts["n"]), sorted(facts["short"])))
    # Of each item the rarest windows: so many that 75 of 100 can't be reached without one of them.
    once = items.select("ik", "w").distinct()
    spread = once.withColumn("c", F.count("*").over(Window.partitionBy("w")))
    ranked = spread.select("ik", "w", F.row_number().over(Window.partitionBy("ik").orderBy("c", "w")).alias("r"), F.count("*").over(Window.partitionBy("ik")).alias("n"))
    rare = ranked.where(F.col("r") <= F.col("n") - F.ceil(F.col("n") * similarity) + 1).select("ik", "w")
    pairs = hits.select("dk", "rk", "w").distinct().join(rare.hint("shuffle_hash"), "w").select("dk", "rk", "ik").distinct()
    mine = cut(pairs.join(items, "ik").select("dk", "rk", "ik", F.lit(0).alias("side"), "place", "w", F.col("own").alias("slots"), "item_id", "n_tokens"))
    wanted = mine.select("dk", "rk", "ik", "w").distinct()
    theirs = wanted.join(hits, ["dk", "rk", "w"]).select("dk", "rk", "ik", F.lit(1).alias("side"), "place", "w", F.col("vals").alias("slots"), F.lit(None).cast("bigint").alias("item_id"), F.lit(None).cast("int").alias("n_tokens"))
    # Rows that repeat an id and text are one document, whose windows count once.
    both = mine.union(theirs.dropDuplicates(["dk", "rk", "ik", "place", "w"]))
    dealt = both.repartition("dk", "rk", "ik").sortWithinPartitions("dk", "rk", "ik", "side", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held)
            side, place, w = (t.column(k).to_numpy() for k in (3, 4, 5))
            slots, n = t.column(6).to_pylist(), int((side == 0).sum())
            said = judge((place[:n], w[:n], slots[:n]), (place[n:], w[n:], slots[n:]), t.column(8)[0].as_py(), similarity)
            if said:
                yield pa.record_batch([pa.array([x], pa.int64()) for x in (key[0], key[1], t.column(7)[0].as_py(), *said)], names=["dk", "rk", "item_id", "n_matched", "n_windows", "n_changed"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(k).to_numpy() for k in range(3)])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for low, high in zip(cuts, cuts[1:]):
                if (now := tuple(keys[low].tolist())) != key:
                    if held:
                        yield from done()
                    key, held = now, []
                held.append(batch.slice(low, high - low))
        if held:
            yield from done()

    return cut(map_arrow(dealt, run, FOUND))


def find_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """A row for each document row and benchmark item that it holds: doc_id, item_id, n_matched, n_windows, n_changed.

    Null or empty texts of either table match nothing. Repeated documents are each reported; repeated items likewise. With
    an empty table the result is empty. docs needs doc_id and text, benchmark item_id and text; other columns are not read.
    n_changed is of all matching windows together, or if these disagree, of the occurrence that changes least.
    """
    found = leaks(docs.select("doc_id", "text"), benchmark, similarity)
    rows = docs.select("doc_id", *row_keys(docs))
    return rows.join(found, ["dk", "rk"]).select("doc_id", "item_id", "n_matched", "n_windows", "n_changed")


def remove_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs without the rows whose text holds a benchmark item; all columns pass through.

    Rows with null or repeated ids are judged by their own text. Null texts stay.
    """
    found = leaks(docs.select("doc_id", "text"), benchmark, similarity).select(F.col("dk").alias("__dk"), F.col("rk").alias("__rk")).distinct()
    dk, rk = row_keys(docs)
    return docs.join(found, (dk == F.col("__dk")) & (rk == F.col("__rk")), "left_anti")
