"""Token counts with the whole-token shortcut, for the sentencepiece BPE vocabularies.

Offline, that is once on the driver, every vocabulary string is encoded alone. Those that come back as exactly their own id
are proven to be single tokens, and the table of them is sent to the tasks, so a pre-token found in it counts 1 without any
merge. Only the other pre-tokens are merged by the library, and their counts are remembered in a table bounded in bytes.

Pre-tokens are maximal `space* non-space*` stretches. Cutting there is exact if the model's normaliser is the identity but
for the space mark, and no piece has a space mark after another character; that, and that no piece holds a newline (so a
newline is one byte token which nothing merges with), is read from the model, and a vocabulary that fails is counted without
that cut.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspire.llm.common import map_chunks

#: Bytes, about, that each of the two tables of remembered counts may take before it is emptied.
MEMO_BYTES = 32 << 20
#: What an entry takes besides its characters.
ENTRY_BYTES = 120
MARK = "▁"


def _fields(message: bytes) -> list[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message: integers and byte strings."""
    out, at = [], 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            value = message[at : at + size]
            at += size
        out.append((key >> 3, value))
    return out


def marks_spaces_only(model: bytes) -> bool:
    """Whether the normaliser of a sentencepiece model changes nothing but spaces to marks, with one mark put first.

    Numbers of fields as in the published sentencepiece_model.proto: the normaliser is field 3 of the model; in it 2 is its
    table of characters, 3 the first mark, 4 whether spaces are removed, 5 whether they become marks.
    """
    spec = next((v for k, v in _fields(model) if k == 3), b"")
    rules = dict(_fields(spec))
    return not rules.get(2) and rules.get(3, 1) == 1 and rules.get(4, 1) == 0 and rules.get(5, 1) == 1


@dataclass(frozen=True)
class Proof:
    """What is known of a vocabulary: whether texts can be cut at spaces and at newlines, and its proven single tokens.

    whole has the pre-tokens without the one space mark that the library puts before a text.
    """

    cuts_words: bool
    cuts_lines: bool
    whole: frozenset[str]


def prove(model_file: str) -> Proof:
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = processor.vocab_size()
    pieces = [processor.id_to_piece(i) for i in range(size)]
    plain = [not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i)) for i in range(size)]
    with open(model_file, "rb") as f:
        same = marks_spaces_only(f.read())
    cuts_words = same and not any(MARK in p.lstrip(MARK) for p, ok in zip(pieces, plain) if ok)
    cuts_lines = cuts_words and not any("\n" in p for p, ok in zip(pieces, plain) if ok) and len(processor.encode("\n")) == 2
    candidates = [(i, p[1:].replace(MARK, " ")) for i, p in enumerate(pieces) if plain[i] and p.startswith(MARK)]
    alone = processor.encode([s for _, s in candidates])
    return Proof(cuts_words, cuts_lines, frozenset({""} | {s for (i, s), ids in zip(candidates, alone) if ids == [i]}))  # "": a lone mark


class WholeTokenCounter:
    """Counts tokens of texts as `SentencePieceProcessor.encode(text)` gives them."""

    def __init__(self, model_file: str, proof: Proof | None = None):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.proof = proof or prove(model_file)
        self.cuts_words, self.cuts_lines = self.proof.cuts_words, self.proof.cuts_lines
        self.forget()

    def forget(self) -> None:
        self.spaced, self.bare = dict.fromkeys(self.proof.whole, 1), {}
        self.sizes = [0, 0]

    def _merge(self, keys: set[str], lead: str) -> None:
        """Have the counts of all keys: pre-tokens after a space mark, or after a newline."""
        table, k = (self.bare, 1) if lead else (self.spaced, 0)
        if self.sizes[k] > MEMO_BYTES:
            table.clear()
            table.update({} if lead else dict.fromkeys(self.proof.whole, 1))
            self.sizes[k] = 0
        missing = [x for x in keys if x not in table]
        for key, ids in zip(missing, self.processor.encode([lead + x for x in missing])):
            table[key] = len(ids) - 2 * len(lead)
            self.sizes[k] += ENTRY_BYTES + len(key)

    def count(self, texts: list[str | None]) -> list[int]:
        if not self.cuts_words:
            return [len(x) for x in self.processor.encode([t or "" for t in texts])]
        parts, spaced, bare = [], set(), set()
        for text in texts:
            fixed, with_space, without = 0, [], []
            if text:
                text = text.replace(MARK, " ")
                lines = text.split("\n") if self.cuts_lines else [text]
                fixed = len(lines) - 1
                for n, line in enumerate(lines):
                    words = line.split(" ")
                    if "" in words:
                        found = re.findall(" *[^ ]+| +", (" " if n == 0 else "") + line)
                        if not found and n == 0:
                            found = [" "]
                        if n and found and found[0][0] != " ":
                            without.append(found.pop(0))
                        with_space += [x[1:] for x in found]
                    else:
                        if n:
                            without.append(words.pop(0))
                        with_space += words
            parts.append((fixed, with_space, without))
            spaced.update(with_space)
            bare.update(without)
        self._merge(spaced, "")
        self._merge(bare, "\n")
        a, b = self.spaced.__getitem__, self.bare.__getitem__
        return [fixed + sum(map(a, x)) + sum(map(b, y)) for fixed, x, y in parts]


@lru_cache(maxsize=2)
def counter(model_file: str, proof: Proof | None = None) -> WholeTokenCounter:
    return WholeTokenCounter(model_file, proof)


def count_tokens(docs: DataFrame, model_file: str, text: str = "text", doc_id: str = "doc_id", limit: int = 4096) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    A null text counts as the empty text, which has no tokens. Rows that repeat are counted each. An empty table gives an
    empty result. Columns other than the two named are not read, so their names can't clash.
    """
    proof = docs.sparkSession.sparkContext.broadcast(prove(model_file))  # at most the vocabulary

    def run(t: pa.RecordBatch) -> pa.RecordBatch:
        texts = t.column(1).to_pylist()
        counts = counter(model_file, proof.value).count(texts)
        sizes = [len(x.encode()) if x else 0 for x in texts]
        return pa.record_batch([t.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema[doc_id].dataType.simpleString()
    counted = map_chunks(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")), run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint", done=lambda: counter(model_file, proof.value).forget())
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
