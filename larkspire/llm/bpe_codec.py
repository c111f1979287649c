"""BPE encoding and decoding with tree concatenation, for `tokenizers` files of a BPE model.

Where white space never survives pre-tokenisation (the file's steps are compared with the known ones; other files are left
to the library, whole text by whole text), a text is cut at spaces and newlines and each stretch is encoded by itself;
stretches are remembered in a table bounded in bytes. A long stretch is unsplit text: it is normalised and pre-tokenised,
and each long pre-token is encoded as a tree. Halves are encoded independently (the leaves in parallel threads), and two
neighbours are joined by re-encoding a window around the seam that grows until its first and last token agree with the
tokens already there. Merging is deterministic by (rank, place), so a token row is the encoding of its text exactly if
every adjacent pair encodes to itself; agreement at both ends of the window therefore proves the whole joined row.
"""

from __future__ import annotations

import json
import os
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspire.llm.common import map_chunks

#: Bytes, about, that the table of remembered stretches and pre-tokens may take.
MEMO_BYTES = 48 << 20
#: What an entry takes besides its characters and ids.
ENTRY_BYTES = 190
#: The vocabulary file's own pattern of pre-tokens, and the characters for which cutting by it here is exact: below this
#: one, text is in composed form already and lower case depends on no neighbour.
PLAIN_BELOW = "\u0250"
PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
#: Stretches up to this many characters are encoded in one call, and remembered.
LONG_CHARS = 512
#: Characters in a leaf of the tree.
LEAF_CHARS = 256


class Memo(dict):
    """Ids as bytes by string. When its entries take more than half of MEMO_BYTES they become the old ones, in place of those
    before; an old one that is asked for again comes back, so what is frequent stays."""

    def __init__(self):
        self.size, self.old = 0, {}

    def remember(self, keys: list[str], made: list[bytes]) -> None:
        self.update(zip(keys, made))
        self.size += ENTRY_BYTES * len(keys) + sum(map(len, keys)) + sum(map(len, made))

    def age(self) -> None:
        if self.size > MEMO_BYTES // 2:
            self.old = dict(self)
            super().clear()
            self.size = 0

    def missing(self, keys: set[str]) -> set[str]:
        """Those that aren't there; all others are, afterwards."""
        new = keys - self.keys()
        back = list(new & self.old.keys())
        self.remember(back, [self.old[k] for k in back])
        return new.difference(back)

    def clear(self) -> None:
        super().clear()
        self.__init__()


def packed(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


class TreeCodec:
    """Encodes as `Tokenizer.encode(text, add_special_tokens=False)` and decodes as `decode(ids, skip_special_tokens=False)`."""

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core; its threads would only wait
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.specials = [x["content"] for x in spec.get("added_tokens", [])]
        if spec.get("decoder") is not None:
            raise ValueError("only vocabularies without a decoder are supported: their tokens are joined by spaces")
        self.suffix = model.get("end_of_word_suffix") or ""
        self.file = tokenizer_file
        self.token = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.shown = [str(i) for i in range(len(self.token))]
        self.size = [len(t.removesuffix(self.suffix)) if self.suffix else len(t) for t in self.token]
        self.ends = np.array([bool(self.suffix) and t.endswith(self.suffix) for t in self.token])
        self.memo = Memo()  # a pre-token is a stretch, too: it encodes alike alone
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        # Texts can be cut here if the file's steps are the known ones; else each whole text goes to the library.
        steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        first, *rest = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        known = steps == ["NFC", "Replace", "Lowercase"] and first.get("pattern") == {"Regex": PRETOKENS} and [x.get("type") for x in rest] == ["ByteLevel"]
        plain = not any(x.get("normalized") or x.get("single_word") or x.get("lstrip") or x.get("rstrip") or any(c.isspace() for c in x["content"]) for x in spec.get("added_tokens", []))
        self.cut = regex.compile(PRETOKENS).findall if known and plain and self.ends.any() else None

    @cached_property
    def pool(self) -> ThreadPoolExecutor:
        return ThreadPoolExecutor(2)

    @cached_property
    def inner(self):
        """The model for pieces that don't end their word; few texts need it."""
        from tokenizers.models import BPE

        with open(self.file, encoding="utf-8") as f:
            model = json.load(f)["model"]
        return BPE(model["vocab"], [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]])

    def _symbols(self, piece: str, ends_word: bool) -> list[int]:
        return [t.id for t in (self.tokenizer.model if ends_word else self.inner).tokenize(piece)] if piece else []

    def _join(self, text: str, left: list[int], right: list[int], ends_word: bool) -> list[int]:
        """left and right encode the two parts of text, cut after left's characters."""
        size, span = self.size, 2
        cut = sum(size[t] for t in left)
        while True:
            take_left, take_right = min(span, len(left)), min(span, len(right))
            a, b = left[len(left) - take_left :], right[:take_right]
            start, end = cut - sum(size[t] for t in a), cut + sum(size[t] for t in b)
            window = self._symbols(text[start:end], ends_word and take_right == len(right))
            whole_left, whole_right = take_left == len(left), take_right == len(right)
            if (whole_left or window[:1] == a[:1]) and (whole_right or window[-1:] == b[-1:]):
                return left[: len(left) - take_left] + window + right[take_right:]
            span *= 2

    def tree(self, text: str, ends_word: bool = True) -> list[int]:
        """The ids of one pre-token of any length."""
        leaves = [text[i : i + LEAF_CHARS] for i in range(0, len(text), LEAF_CHARS)]
        level = list(self.pool.map(self._symbols, leaves, [ends_word and i == len(leaves) - 1 for i in range(len(leaves))]))
        texts = leaves
        while len(level) > 1:
            pairs = range(0, len(level) - 1, 2)
            joined = [self._join(texts[i] + texts[i + 1], level[i], level[i + 1], ends_word and i + 2 == len(level)) for i in pairs]
            odd = len(level) % 2
            texts = [texts[i] + texts[i + 1] for i in pairs] + texts[-1:] * odd
            level = joined + level[-1:] * odd
        return level[0] if level else []

    def _long(self, stretch: str) -> list[int]:
        """A long stretch without spaces: special strings first, as the library does, then pre-tokens."""
        out, at = [], 0
        for m in self.special.finditer(stretch) if self.special else ():
            out += self._plain(stretch[at : m.start()])
            out.append(self.tokenizer.token_to_id(m[0]))
            at = m.end()
        return out + self._plain(stretch[at:])

    def _plain(self, stretch: str) -> list[int]:
        if not stretch:
            return []
        normal = self.tokenizer.normalizer.normalize_str(stretch) if self.tokenizer.normalizer else stretch
        out = []
        for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
            out += self.tree(piece) if len(piece) > LEAF_CHARS else self._symbols(piece, True)
        return out

    def _encode_words(self, words: set[str]) -> None:
        """Encode pre-tokens in one call: every one ends with a token that has the end-of-word mark."""
        order = list(self.memo.missing(words))
        if not order:
            return
        ids = np.array(self.tokenizer.encode_batch([" ".join(order)], add_special_tokens=False)[0].ids, np.int32)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(order):
            raise AssertionError("a pre-token didn't end with the end-of-word mark")
        data, cuts = ids.tobytes(), [0, *(4 * stops).tolist()]
        self.memo.remember(order, [data[i:j] for i, j in zip(cuts, cuts[1:])])

    def encode_stretches(self, stretches: set[str], specials: list[str]) -> None:
        """Remember the ids of every stretch: all of them are in memo afterwards. specials: the special strings that any holds."""
        self.memo.age()
        split, alone, words, whole, long = {}, [], set(), [], []
        for s in self.memo.missing(stretches):
            if len(s) > LONG_CHARS:
                long.append(s)
            elif (s.isascii() or max(s) < PLAIN_BELOW) and not (specials and any(x in s for x in specials)):
                low = s.lower()
                if low.isalpha():  # one pre-token
                    words.add(low)
                    if low != s:
                        alone.append((s, low))
                else:
                    split[s] = ws = self.cut(low)
                    words.update(ws)
            else:
                whole.append(s)
        self._encode_words(words)
        ids, remember = self.memo.__getitem__, self.memo.remember
        remember([s for s, _ in alone], [ids(low) for _, low in alone])
        remember(list(split), [b"".join(map(ids, ws)) for ws in split.values()])
        remember(whole, [packed(e.ids) for e in self.tokenizer.encode_batch(whole, add_special_tokens=False)])
        remember(long, [packed(self._long(s)) for s in long])

    def forget(self) -> None:
        self.memo.clear()

    def encode_texts(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as int32 in bytes."""
        if self.cut is None:
            return [packed(e.ids) for e in self.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        parts = [(t or "").replace("\n", " ").split(" ") for t in texts]
        specials = [x for x in self.specials if any(t and x in t for t in texts)]
        self.encode_stretches(set().union(*parts) if parts else set(), specials)
        return [b"".join(map(self.memo.__getitem__, p)) for p in parts]

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(tokenizer_file: str) -> TreeCodec:
    return TreeCodec(tokenizer_file)


def encode(docs: DataFrame, tokenizer_file: str, text: str = "text", doc_id: str = "doc_id", digests: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_tokens, and ids array<int> with decoded string, or with digests their SHA-256.

    A null or empty text has no tokens and decodes to the empty text. Repeated rows are encoded each. An empty table gives
    an empty result. Only the two named columns are read.
    """

    def run(t: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(tokenizer_file)
        made = own.encode_texts(t.column(1).to_pylist())
        n = pa.array([len(x) // 4 for x in made], pa.int64())
        if digests:
            shown, rows = own.shown.__getitem__, [np.frombuffer(x, np.int32).tolist() for x in made]
            more = [pa.array([sha256(text.encode()).hexdigest() for text in texts], pa.string()) for texts in ((" ".join(map(shown, r)) for r in rows), map(own.decode, rows))]
        else:
            ends = np.cumsum([0] + [len(x) // 4 for x in made]).astype(np.int32)
            decoded = pa.array([own.decode(np.frombuffer(x, np.int32).tolist()) for x in made], pa.string())
            more = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(made), np.int32))), decoded]
        return pa.record_batch([t.column(0), n, *more], names=names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["doc_id", "n_tokens", "ids", "decoded"]
    kinds = ["string", "string"] if digests else ["array<int>", "string"]
    kind = docs.schema[doc_id].dataType.simpleString()
    return map_chunks(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")), run, f"doc_id {kind}, n_tokens bigint, {names[2]} {kinds[0]}, {names[3]} {kinds[1]}", done=lambda: codec(tokenizer_file).forget())
