"""Compile query trees to column expressions: whether a document matches, and its BM25 score.

Both are built from Spark's own functions, so Catalyst prunes a score nobody selects and generates code for the rest.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property
from math import log

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspire.functions.analysis import occurrences, padded, phrase_pattern, too_long, word_count, words_of
from larkspire.functions.querylang import AnyOf, Everything, Group, Range, Term

#: Okapi BM25, as published by Robertson and Zaragoza.
K1, B = 1.2, 0.75


@dataclass(frozen=True)
class Statistics:
    """Of a collection: documents, mean words of each field, documents that hold each (field, word)."""

    documents: int
    mean_words: dict[str, float]
    holding: dict[tuple[str, str], int]

    def idf(self, field: str, word: str) -> float:
        n = self.holding.get((field, word), 0)
        return log(1 + (self.documents - n + 0.5) / (n + 0.5))


class Searchable:
    """The raw column of a field, and what the field is."""

    def __init__(self, column: Column, kind: str, type_: T.DataType, pad: Column | None = None, words: Column | None = None):
        self.column, self.kind, self.type = column, kind, type_
        self.multi = isinstance(type_, T.ArrayType)
        self.text = F.array_join(column, "\n") if self.multi and kind == "text" else column
        self._pad, self._words = pad, words

    @cached_property
    def pad(self) -> Column:
        return self._pad if self._pad is not None else padded(self.text)

    @cached_property
    def words(self) -> Column:
        return self._words if self._words is not None else word_count(self.text)


class Compiler:
    def __init__(self, fields: Mapping[str, Searchable]):
        self.fields = fields

    def field(self, name: str) -> Searchable:
        if name not in self.fields:
            raise ValueError(f"full_text: field '{name}' not found in any split")
        return self.fields[name]

    def matches(self, node) -> Column:
        """Never null."""
        return F.coalesce(self._matches(node), F.lit(False))

    def _matches(self, node) -> Column:
        if isinstance(node, Everything):
            return F.lit(True)
        if isinstance(node, Group):
            return self._group(node)
        f = self.field(node.field)
        if isinstance(node, Range):
            return self._range(f, node)
        if isinstance(node, AnyOf):
            return _any([self._matches(Term(node.field, v, quoted=True)) for v in node.values])
        if f.kind == "text":
            return self._words(f, node)
        return self._value(f, lambda x: x.startswith(node.text) if node.prefix and f.kind == "string" else x == _literal(node.text, f))

    def _group(self, node: Group) -> Column:
        if node.must:
            found = _all([self.matches(n) for n in node.must])
        elif node.should:
            found = _any([self.matches(n) for n in node.should])
        else:
            return F.lit(False)
        return _all([found, *(~self.matches(n) for n in node.must_not)])

    def _words(self, f: Searchable, node: Term) -> Column:
        words = words_of(node.text)
        if not words or too_long(words if not node.prefix else words[:-1]):
            return F.lit(False)
        low = F.lower(f.text)
        # Cheap substring tests first: the exact test on padded words runs where they hold.
        first = _all([F.contains(low, F.lit(w)) for w in dict.fromkeys(words)])
        if node.slop and len(words) > 1:
            gap = r"(?: [^ ]+ ){0,%d}" % node.slop
            return first & f.pad.rlike(gap.join(f" {re.escape(w)} " for w in words[:-1]) + gap + f" {re.escape(words[-1])}" + ("" if node.prefix else " "))
        if node.prefix:
            return first & F.contains(f.pad, F.lit(phrase_pattern(words)[:-1]))
        return first & F.contains(f.pad, F.lit(phrase_pattern(words)))  # a bare word with breaks in it is a phrase, too

    @staticmethod
    def _value(f: Searchable, test) -> Column:
        return F.exists(f.column, test) if f.multi else test(f.column)

    def _range(self, f: Searchable, node: Range) -> Column:
        def inside(x: Column) -> Column:
            parts = []
            if node.low is not None:
                low = _literal(node.low, f)
                parts.append(x >= low if node.low_included else x > low)
            if node.high is not None:
                high = _literal(node.high, f)
                parts.append(x <= high if node.high_included else x < high)
            return _all(parts) if parts else x.isNotNull()

        return self._value(f, inside)

    def score(self, node, statistics: Statistics) -> Column:
        """The sum of the scores of what matches; 0 where nothing does."""
        if isinstance(node, Group):
            parts = [self.score(n, statistics) for n in (*node.must, *node.should)]
            total = parts[0] if parts else F.lit(0.0)
            for p in parts[1:]:
                total = total + p
            return F.when(self.matches(node), total * F.lit(node.boost)).otherwise(F.lit(0.0))
        f = None if isinstance(node, Everything) else self.field(node.field)
        if isinstance(node, Term) and f is not None and not node.prefix:
            words = words_of(node.text) if f.kind == "text" else [node.text]
            if f.kind == "text" and not node.slop and words:  # a phrase counts as one word with its words' summed idf
                idf = sum(statistics.idf(node.field, w) for w in words)
                return F.lit(node.boost) * self._bm25(self.occurring(f, node, words), self.length(f, node.field), idf, statistics.mean_words.get(node.field) or 1.0)
            if f.kind == "string" and words:  # a whole value occurs once and has no length
                return F.when(self.matches(node), F.lit(node.boost * statistics.idf(node.field, node.text))).otherwise(F.lit(0.0))
        return F.when(self.matches(node), F.lit(float(node.boost))).otherwise(F.lit(0.0))

    def occurring(self, f: Searchable, node: Term, words: list[str]) -> Column:
        """How often a word, or a phrase, occurs in a document."""
        return occurrences(f.pad, phrase_pattern(words))

    def length(self, f: Searchable, name: str) -> Column:
        """The words of a field in a document."""
        return f.words

    @staticmethod
    def _bm25(count: Column, length: Column, idf: float, mean: float) -> Column:
        tf = F.coalesce(count, F.lit(0)).cast("double")
        return F.lit(idf) * (tf * F.lit(K1 + 1)) / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * length / F.lit(mean)))


def scored_words(node, fields: dict[str, str]) -> set[tuple[str, str]]:
    """The (field, word) pairs whose statistics a score needs. fields: kinds by name."""
    if isinstance(node, Group):
        return set().union(*(scored_words(n, fields) for n in (*node.must, *node.should))) if node.must or node.should else set()
    if not isinstance(node, Term) or node.prefix or (node.quoted and node.slop):
        return set()
    kind = fields.get(node.field)
    return {(node.field, w) for w in words_of(node.text)} if kind == "text" else {(node.field, node.text)} if kind == "string" else set()


def _literal(text: str, f: Searchable) -> Column:
    """The text as the field's type; null, which matches nothing, if it isn't one."""
    own = f.type.elementType if f.multi else f.type
    return F.lit(text).cast("binary") if isinstance(own, T.BinaryType) else F.lit(text).try_cast(own)


def _all(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out & p
    return out


def _any(parts: list[Column]) -> Column:
    if not parts:
        return F.lit(False)
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return out
