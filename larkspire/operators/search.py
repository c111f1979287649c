"""A query on one collection: full_text clauses, filters, projection, and top-k by score."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspire.operators.collection import Collection
from larkspire.plans.filters import condition
from larkspire.plans.fields import SCORE


@dataclass(frozen=True)
class Search:
    """Immutable; each method returns a further query. frame() is an ordinary DataFrame."""

    collection: Collection
    clauses: tuple[tuple[str, str], ...] = ()
    filters: tuple[str | Column | dict, ...] = ()
    columns: tuple[str, ...] | None = None
    top: int | None = None
    ties: tuple[str, ...] = ()
    rows: int | None = None

    def full_text(self, field: str, query: str) -> Search:
        self.collection.parse(field, query)  # a bad query or field is told at once
        return replace(self, clauses=(*self.clauses, (field, query)))

    def where(self, filter_: str | Column | dict) -> Search:
        """A SQL condition, a column, or a typed filter {field, op, value, value_type} as plans/filters.py has them."""
        if isinstance(filter_, dict):
            condition(filter_)  # a bad one is told at once
        return replace(self, filters=(*self.filters, filter_))

    def select(self, *columns: str) -> Search:
        return replace(self, columns=columns)

    def top_k(self, k: int, *ties: str) -> Search:
        """The k best scores; equal ones by the columns of ties."""
        return replace(self, top=k, ties=ties)

    def limit(self, n: int) -> Search:
        return replace(self, rows=n)

    def frame(self) -> DataFrame:
        c = self.collection
        nodes, columns = [c.parse(f, q) for f, q in self.clauses], [f"__match_{i}" for i in range(len(self.clauses))]
        wanted = list(self.columns or c.public)
        scored = nodes and (SCORE in wanted or self.top is not None or any(SCORE in str(f) for f in self.filters))
        df = c.searched(nodes, columns, bool(scored))
        for x in columns:
            df = df.where(F.col(x))
        for f in self.filters:
            df = df.where(condition(f))
        if self.top is not None:
            df = df.orderBy(F.desc_nulls_last(SCORE), *self.ties).limit(self.top)
        df = df.select(*wanted)
        return df if self.rows is None else df.limit(self.rows)

    def to_dict(self) -> dict:
        """The query for another session, with its table: SearchEngine.search() takes it. Filters must be SQL text or typed."""
        if any(not isinstance(f, (str, dict)) for f in self.filters):
            raise ValueError("a query with column expressions as filters can't be written down; use SQL text or typed filters")
        return {
            "table": self.collection.spec().to_dict(),
            "full_text": [list(c) for c in self.clauses],
            "filters": list(self.filters),
            "columns": None if self.columns is None else list(self.columns),
            "top_k": self.top,
            "ties": list(self.ties),
            "limit": self.rows,
        }

    def describe(self) -> dict:
        """The facts of the plan, for logs and tests."""
        wanted = list(self.columns or self.collection.public)
        return {
            "table": self.collection.name,
            "splits": [s.split_id for s in self.collection.splits],
            "partitions": len(self.collection.splits),
            "raw_queries": list(self.clauses),
            "filters": [str(f) for f in self.filters],
            "projection": wanted,
            "has_query": bool(self.clauses or self.filters),
            "needs_score": bool(self.clauses) and (SCORE in wanted or self.top is not None),
            "needs_document": "_document" in wanted,
            "topk": self.top,
            "row_limit": self.rows,
            "schema": self.collection.schema,
        }
