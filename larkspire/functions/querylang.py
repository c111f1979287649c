"""The query language of full_text: parse a query string to a tree.

    a b            either word            a AND b, +a b    required words
    a OR b         either                 NOT a, -a        excluded
    "a b"          the phrase             "a b"~2          in order, with up to two words between neighbours
    ab*            words by their start   "a b"*           a phrase whose last word is a start
    f:x            another field          x^2              boost
    *              every document         (a b) AND c      groups
    [a TO b] {a TO b} [a TO *]            ranges           IN [a b]  any of the values
A query of exclusions alone matches nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import regex


@dataclass(frozen=True)
class Term:
    field: str
    text: str
    slop: int = 0
    quoted: bool = False
    prefix: bool = False
    boost: float = 1.0


@dataclass(frozen=True)
class Everything:
    boost: float = 1.0


@dataclass(frozen=True)
class Range:
    field: str
    low: str | None
    high: str | None
    low_included: bool
    high_included: bool
    boost: float = 1.0


@dataclass(frozen=True)
class AnyOf:
    field: str
    values: tuple[str, ...]
    boost: float = 1.0


@dataclass(frozen=True)
class Group:
    must: tuple = ()
    should: tuple = ()
    must_not: tuple = ()
    boost: float = 1.0


_TOKENS = regex.compile(
    r"""\s*(?:
      (?P<quoted>"(?:[^"\\]|\\.)*")(?:~(?P<slop>\d+))?(?P<star>\*)?
    | (?P<range>[\[{]\s*(?P<low>[^\s\]}]+)\s+TO\s+(?P<high>[^\s\]}]+)\s*[\]}])
    | IN\s*\[(?P<set>[^\]]*)\]
    | (?P<open>\()|(?P<close>\))
    | (?P<boost>\^(?:\d+(?:\.\d+)?|\.\d+))
    | (?P<sign>[+-])(?=\S)
    | (?P<field>[\p{L}_][\w.]*):(?=\S)
    | (?P<word>[^\s()\[\]{}"^:]+)
    )""",
    regex.X,
)


@dataclass
class _Reader:
    text: str
    field: str
    tokens: list = field(default_factory=list)
    at: int = 0

    def fail(self) -> ValueError:
        return ValueError(f"full_text: failed to parse '{self.text}'")

    def read(self) -> None:
        place, text = 0, self.text.rstrip()
        while place < len(text):
            m = _TOKENS.match(text, place)
            if not m or m.end() == place:
                raise self.fail()
            self.tokens.append(m)
            place = m.end()

    def peek(self):
        return self.tokens[self.at] if self.at < len(self.tokens) else None

    def word_is(self, word: str) -> bool:
        t = self.peek()
        return t is not None and t["word"] == word

    def either(self, field: str):
        """OR of ANDs; clauses that only stand side by side join the group as they are signed."""
        must, should, must_not = [], [], []
        while (t := self.peek()) is not None and not t["close"]:
            if self.word_is("OR"):
                if not (must or should or must_not):
                    raise self.fail()
                self.at += 1
                if self.peek() is None or self.peek()["close"]:
                    raise self.fail()
                continue
            clauses = [self.clause(field)]
            while self.word_is("AND"):
                self.at += 1
                clauses.append(self.clause(field))
            if len(clauses) > 1:
                both = Group(tuple(n for s, n in clauses if s != "-"), (), tuple(n for s, n in clauses if s == "-"))
                should.append(both)
            else:
                sign, node = clauses[0]
                (must if sign == "+" else must_not if sign == "-" else should).append(node)
        if not (must or should or must_not):
            raise self.fail()
        if not must and not must_not and len(should) == 1:
            return should[0]
        return Group(tuple(must), tuple(should), tuple(must_not))

    def clause(self, field: str) -> tuple[str, object]:
        t = self.peek()
        if t is None:
            raise self.fail()
        sign = ""
        if t["word"] == "NOT":
            sign, self.at = "-", self.at + 1
        elif t["sign"]:
            sign, self.at = t["sign"], self.at + 1
        return sign, self.leaf(field)

    def leaf(self, field: str):
        t = self.peek()
        if t is None or t["close"] or t["sign"] or t["boost"] or t["word"] in ("AND", "OR", "NOT"):
            raise self.fail()
        self.at += 1
        if t["field"]:
            return self.leaf(t["field"])
        if t["open"]:
            node = self.either(field)
            if self.peek() is None:
                raise self.fail()
            self.at += 1
        elif t["quoted"]:
            node = Term(field, regex.sub(r"\\(.)", r"\1", t["quoted"][1:-1]), int(t["slop"] or 0), True, bool(t["star"]))
        elif t["range"]:
            low, high = (None if x == "*" else x for x in (t["low"], t["high"]))
            node = Range(field, low, high, t["range"][0] == "[", t["range"][-1] == "]")
        elif t["set"] is not None:
            node = AnyOf(field, tuple(t["set"].split()))
        elif t["word"] == "*":
            node = Everything()
        else:
            prefix = t["word"].endswith("*")
            node = Term(field, t["word"][: -1 if prefix else None], prefix=prefix)
        if (b := self.peek()) is not None and b["boost"]:
            self.at += 1
            node = replace(node, boost=node.boost * float(b["boost"][1:]))
        return node


def parse(text: str, field: str):
    """The tree of a query string whose words are looked for in field unless they name another. ValueError if malformed."""
    reader = _Reader(text, field)
    reader.read()
    if not reader.tokens:
        return Group()
    node = reader.either(field)
    if reader.peek() is not None:
        raise reader.fail()
    return node


def leaves(node) -> list:
    if isinstance(node, Group):
        return [x for part in (node.must, node.should, node.must_not) for n in part for x in leaves(n)]
    return [node]


def replaced(node, make):
    """The tree with make(leaf) for every leaf that has a field."""
    if isinstance(node, Group):
        return replace(node, **{k: tuple(replaced(n, make) for n in getattr(node, k)) for k in ("must", "should", "must_not")})
    return make(node) if hasattr(node, "field") else node
