"""Find full_text(...) calls and collections in SQL text, block by block, and put compiled columns in their place.

A block is a SELECT with its own FROM: a subquery, a CTE or an arm of a set operation. In each block a collection becomes a
view of its own that has a column for each full_text call on it and their summed score as _score. A call on a subquery or CTE
goes to the collection inside it, whose match column is passed outwards; so does one on a table of a block around. The match
columns are taken out of every `*`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import regex

_LEXER = regex.compile(
    r"""(?P<space>\s+|--[^\n]*|/\*.*?\*/)|(?P<text>'(?:[^'\\]|''|\\.)*'|"(?:[^"\\]|""|\\.)*")|(?P<name>`(?:[^`]|``)*`|[\p{L}_][\w]*)|(?P<number>\d[\w.]*)|(?P<other>.)""",
    regex.X | regex.S,
)
#: Words that can't be an alias after a table.
KEYWORDS = frozenset("where group order having limit join on using inner left right full cross natural union intersect except minus window lateral as tablesample sort cluster distribute offset pivot unpivot anti semi outer qualify select from set by".split())
#: Words that end a FROM clause, and those that join the arms of a set operation.
AFTER_FROM = frozenset("where group order having limit window qualify sort cluster distribute offset".split())
SET_OPERATIONS = frozenset("union intersect except minus".split())


@dataclass
class Token:
    kind: str
    text: str
    start: int
    end: int

    @property
    def word(self) -> str:
        return self.text.lower() if self.kind == "name" and self.text[0] != "`" else ""

    @property
    def name(self) -> str:
        return self.text[1:-1].replace("``", "`") if self.text[0] == "`" else self.text


@dataclass
class Call:
    """full_text(field, query): qualifier is the alias or table before the field."""

    start: int
    end: int
    qualifier: str | None
    field: str
    query: str


@dataclass(eq=False)
class Source:
    """What stands in a FROM clause: a collection, or a subquery or CTE with its block."""

    start: int
    end: int
    name: str | None
    alias: str | None
    block: Block | None = None
    calls: list[Call] = field(default_factory=list)
    columns: list[str] = field(default_factory=list)

    @property
    def names(self) -> set[str]:
        return {x.lower() for x in (self.alias or self.name,) if x}

    @property
    def shown(self) -> str:
        return f"`{(self.alias or self.name).replace('`', '``')}`"


@dataclass(eq=False)
class Block:
    parent: Block | None = None
    sources: list[Source] = field(default_factory=list)
    calls: list[Call] = field(default_factory=list)
    stars: list[tuple[int, int, str | None]] = field(default_factory=list)  # with the name before it
    names: set[str] = field(default_factory=set)  # in the select list
    scored: bool = False
    merged: str | None = None  # why no column can be passed through
    list_end: int | None = None  # where the select list ends
    passed: dict[str, str] = field(default_factory=dict)  # match columns passed outwards: name, expression


@dataclass(eq=False)
class _Frame:
    """An open parenthesis."""

    block: Block | None
    state: str | None = None  # the clause of the block that is open at this level
    source: bool = False  # the parenthesis stands where a FROM clause expects a table
    first: Block | None = None
    ctes: dict[str, Block | None] = field(default_factory=dict)
    naming: bool = False  # inside WITH, before a CTE's parenthesis
    cte: str | None = None


def tokens(sql: str) -> list[Token]:
    found = [Token(m.lastgroup, m[0], m.start(), m.end()) for m in _LEXER.finditer(sql)]
    return [t for t in found if t.kind != "space"]


def unquoted(text: str) -> str:
    quote, body = text[0], text[1:-1]
    return regex.sub(r"\\(.)", r"\1", body.replace(quote * 2, quote))


def _arguments(found: list[Token], at: int) -> tuple[list[list[Token]], int]:
    """The arguments of the call whose opening parenthesis is at `at`, and the place of the closing one."""
    depth, parts = 0, [[]]
    for i in range(at, len(found)):
        t = found[i]
        if t.text == "(":
            depth += 1
            if depth == 1:
                continue
        elif t.text == ")":
            depth -= 1
            if not depth:
                return parts, i
        elif t.text == "," and depth == 1:
            parts.append([])
            continue
        parts[-1].append(t)
    raise ValueError("full_text: no closing parenthesis")


def _field_of(part: list[Token]) -> tuple[str | None, str]:
    """From a column, a quoted name, or a CAST or TRY_CAST of a column."""
    if len(part) > 3 and part[0].word in ("cast", "try_cast") and part[1].text == "(":
        end = next(i for i, t in enumerate(part) if t.word == "as")
        return _field_of(part[2:end])
    if len(part) == 1 and part[0].kind == "text":
        return None, unquoted(part[0].text)
    if len(part) in (1, 3) and all(t.kind == "name" for t in part[::2]) and (len(part) == 1 or part[1].text == "."):
        return (part[0].name if len(part) == 3 else None), part[-1].name
    raise ValueError("full_text: the first argument must be a column or a field's name")


def _alias(found: list[Token], at: int) -> str | None:
    """The alias that begins at a place, if one does."""
    if at < len(found) and found[at].word == "as" and at + 1 < len(found):
        return found[at + 1].name
    return found[at].name if at < len(found) and found[at].kind == "name" and found[at].word not in KEYWORDS else None


class _Reader:
    """Reads a statement's blocks in one pass over its tokens."""

    def __init__(self, sql: str, known: frozenset[str]):
        self.found, self.known, self.out = tokens(sql), known, []
        self.stack = [_Frame(None)]

    def cte(self, name: str) -> tuple[bool, Block | None]:
        for frame in reversed(self.stack):
            if name.lower() in frame.ctes:
                return True, frame.ctes[name.lower()]
        return False, None

    def expects_source(self, i: int) -> bool:
        """Whether a FROM clause expects a table at token i."""
        frame, before = self.stack[-1], self.found[i - 1] if i else None
        if before is None or not (frame.state == "from" or frame.source and frame.first is None):
            return False
        return before.word in ("from", "join", "lateral") or before.text in (",", "(")

    def read(self) -> list[Block]:
        i = 0
        while i < len(self.found):
            i = self.step(i)
        return self.out

    def step(self, i: int) -> int:
        t, frame = self.found[i], self.stack[-1]
        before = self.found[i - 1] if i else None
        after = self.found[i + 1] if i + 1 < len(self.found) else None
        if t.word == "with" and frame.first is None and (before is None or before.text in ("(", ";") or before.word in ("explain", "as")) and after is not None and after.kind == "name":
            frame.naming = True
        elif frame.naming and t.kind == "name" and t.word not in ("recursive", "as", "materialized", "not", "select", "from", "values", "table") and frame.cte is None:
            frame.cte = t.name
            if before.word == "recursive":
                frame.ctes[t.name.lower()] = None
        elif t.text == "(":
            named = frame.naming and before.word in ("as", "materialized")
            made = _Frame(frame.block, source=not named and self.expects_source(i))
            if frame.naming and not named:  # the columns of a CTE
                made.state = "columns"
            elif made.source and after is not None and after.word not in ("select", "with", "values", "table", "from") and after.text != "(":
                made.state = "from"  # joins in parentheses
            self.stack.append(made)
        elif t.text == ")" and len(self.stack) > 1:
            self.close(i)
        elif t.word == "select":
            made = Block(frame.block if frame.first is None else frame.first.parent)
            if frame.first is None:
                frame.first = made
            else:
                made.merged = frame.first.merged = "a set operation"
            frame.block, frame.state, frame.naming = made, "select", False
            self.out.append(made)
            if after is not None and after.word == "distinct":
                made.merged = "DISTINCT"
        elif t.word == "full_text" and after is not None and after.text == "(":
            parts, end = _arguments(self.found, i + 1)
            if len(parts) != 2:
                raise ValueError("full_text takes a field and a query")
            if len(parts[1]) != 1 or parts[1][0].kind != "text":
                raise ValueError("full_text: the query must be a string literal")
            if frame.block is not None:
                frame.block.calls.append(Call(t.start, self.found[end].end, *_field_of(parts[0]), unquoted(parts[1][0].text)))
            return end + 1
        elif t.word == "from" and frame.state == "select" and not (before.word == "distinct" and self.found[i - 2].word in ("is", "not")):
            frame.state, frame.block.list_end = "from", before.end
        elif t.word == "join" and frame.state in ("from", "on"):
            frame.state = "from"
        elif t.word in ("on", "using") and frame.state == "from":
            frame.state = "on"
        elif t.text == "," and frame.state == "on":
            frame.state = "from"
        elif t.word in SET_OPERATIONS and frame.state not in (None, "columns") and not (t.word == "except" and before.text in ("*", ")") and frame.state == "select"):
            frame.state = "set"
        elif t.word in AFTER_FROM and frame.state in ("select", "from", "on", "rest"):
            if t.word == "group":
                frame.block.merged = "GROUP BY"
            if frame.state == "select":
                frame.block.list_end = before.end
            frame.state = "rest"
        elif t.kind == "name" and self.expects_source(i) and (after is None or after.text not in (".", "(")) and before.text != ".":
            self.table(i)
        elif t.kind == "name" and frame.block is not None:
            if t.name.lower() == "_score":
                frame.block.scored = True
            if frame.state == "select":
                frame.block.names.add(t.name.lower())
        elif t.text == "*" and frame.state == "select" and (before.word in ("select", "distinct", "all") or before.text in (",", ".")):
            dotted = before.text == "."
            start = self.found[i - 2].start if dotted else t.start
            frame.block.stars.append((start, t.end, self.found[i - 2].name if dotted else None))
            frame.block.scored = True
        return i + 1

    def table(self, i: int) -> None:
        t, frame = self.found[i], self.stack[-1]
        is_cte, block = self.cte(t.name)
        if is_cte or t.name.lower() in self.known:
            frame.block.sources.append(Source(t.start, t.end, t.name, _alias(self.found, i + 1), block if is_cte else None))
            if is_cte and block is None:
                frame.block.sources.pop()  # one that can't be looked into

    def close(self, i: int) -> None:
        done = self.stack.pop()
        frame = self.stack[-1]
        if frame.naming and done.state != "columns" and frame.cte is not None:
            frame.ctes[frame.cte.lower()] = done.first
            frame.cte = None
        elif done.source and done.first is not None and frame.block is not None:
            frame.block.sources.append(Source(i, i, None, _alias(self.found, i + 1), done.first))


def blocks(sql: str, known: frozenset[str]) -> list[Block]:
    """The blocks of a statement, with the collections of known names, subqueries, CTEs and full_text calls in them."""
    return _Reader(sql, known).read()


def find_full_text_calls(sql: str) -> list[Call]:
    return [c for b in blocks(sql, frozenset()) for c in b.calls]


class _Resolver:
    def __init__(self, known: dict[str, frozenset[str]], every: list[Block]):
        self.known, self.every, self.count = known, every, 0

    def provides(self, source: Source, field: str) -> bool:
        if source.block is None:
            return field in self.known[source.name.lower()]
        inner = source.block
        return bool(inner.stars or field.lower() in inner.names) and any(self.provides(s, field) for s in inner.sources)

    def choose(self, block: Block, call: Call) -> Source | None:
        """The source of a block that a call is about."""
        if call.qualifier:
            return next((s for s in block.sources if call.qualifier.lower() in s.names), None)
        fits = [s for s in block.sources if self.provides(s, call.field)]
        if len(fits) > 1:
            raise ValueError(f"full_text: field '{call.field}' belongs to several tables; put one's name before it")
        return fits[0] if fits else None

    def resolve(self, block: Block, call: Call) -> str:
        """The expression for a call: a match column of the source that it is about, here or in a block around."""
        around: Block | None = block
        while around is not None:
            if source := self.choose(around, call):
                return self.column(source, call)
            around = around.parent
        alone = [s for s in block.sources if s.block is None]
        if len(alone) == 1 and not call.qualifier:
            return self.column(alone[0], call)  # where the collection says which field it lacks
        raise ValueError(f"full_text: field '{call.field}' not found in any split of the tables beside it")

    def column(self, source: Source, call: Call) -> str:
        if source.alias is None and source.name is None:
            raise ValueError("full_text: the subquery needs an alias")
        if source.block is None:
            source.calls.append(call)
            source.columns.append(f"__match_{self.count}")
            self.count += 1
            return f"{source.shown}.{source.columns[-1]}"
        inner = source.block
        if inner.merged:
            raise ValueError(f"full_text can't be used outside of {inner.merged}; put it inside")
        if sum(s.block is inner for b in self.every for s in b.sources) > 1:
            raise ValueError(f"full_text on '{source.alias or source.name}', which is used several times; put it inside")
        found = self.choose(inner, Call(call.start, call.end, None, call.field, call.query))
        if found is None:
            raise ValueError(f"full_text: field '{call.field}' not found in any split of the tables beside it")
        expression = self.column(found, call)
        name = expression.rpartition(".")[2]
        inner.passed[name] = expression
        source.columns.append(name)
        return f"{source.shown}.{name}"


def rewrite(sql: str, known: dict[str, frozenset[str]], view: Callable[[str, list[Call], list[str], bool], str]) -> str:
    """known: fields that full_text finds, by collection. view: makes the view of a collection for calls with these columns."""
    every = blocks(sql, frozenset(known))
    resolver = _Resolver(known, every)
    edits: list[tuple[int, int, str]] = []
    for block in every:
        for call in block.calls:
            edits.append((call.start, call.end, resolver.resolve(block, call)))
    for block in every:
        for source in block.sources:
            if source.block is None:
                name = view(source.name.lower(), source.calls, source.columns, block.scored)
                edits.append((source.start, source.end, name if source.alias else f"{name} AS {sql[source.start : source.end]}"))
        for start, end, before in block.stars:
            hidden = [c for s in block.sources if before is None or before.lower() in s.names for c in s.columns]
            if hidden:
                edits.append((start, end, f"{sql[start:end]} EXCEPT ({', '.join(hidden)})"))
        if block.passed and block.list_end is not None:
            edits.append((block.list_end, block.list_end, "".join(f", {x}" for x in block.passed.values())))
    for start, end, text in sorted(edits, key=lambda e: (e[0], e[1]), reverse=True):
        sql = sql[:start] + text + sql[end:]
    return sql
