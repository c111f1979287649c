"""A collection: splits as one table, with the canonical schema and what full_text needs beside it."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import replace
from functools import cached_property, reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspire.functions.analysis import padded, phrase_pattern, word_count
from larkspire.functions.fulltext import Compiler, Searchable, Statistics, scored_words
from larkspire.functions.querylang import Group, leaves, parse, replaced
from larkspire.plans.canonical import coerced, explicit_schema, infer_schema
from larkspire.plans.fields import DOC_ID, DOCUMENT, SCORE, SEGMENT, SPLIT, FieldSpec, SplitSpec, TableSpec
from larkspire.sources.index import DOC_KEY, Index
from larkspire.sources.splits import open_split, read_split

#: Columns of this prefix hold a split's raw field, or prepared text, for full_text; they are never shown.
RAW, PAD, WORDS = "__raw_", "__pad_", "__words_"
#: Of files, in one piece of a kept table: a task reads the whole piece, which takes about five times as much with its prepared texts.
PIECE_BYTES = 16 << 20


class _Fields(Mapping):
    """Searchable fields by name; the columns of one are made when it is asked for."""

    def __init__(self, collection: Collection):
        self.collection, self.made = collection, {}

    def __getitem__(self, name: str) -> Searchable:
        c = self.collection
        if name not in c.searchable_names:
            raise KeyError(name)
        if name not in self.made:
            ahead = (F.col(PAD + name), F.col(WORDS + name)) if c._prepared is not None and c.kinds[name] == "text" else (None, None)
            self.made[name] = Searchable(F.col(RAW + name), c.kinds[name], c._raw_type(name), *ahead)
        return self.made[name]

    def __contains__(self, name: object) -> bool:
        return name in self.collection.searchable_names

    def __iter__(self) -> Iterator[str]:
        return iter(self.collection.searchable_names)

    def __len__(self) -> int:
        return len(self.collection.searchable_names)


class Collection:
    def __init__(self, spark: SparkSession, name: str, splits: list[SplitSpec], schema: T.StructType | None = None):
        self.spark, self.name = spark, name
        self.splits = [open_split(spark, s) for s in splits]
        self.explicit = schema
        self.schema = explicit_schema(schema, self.splits) if schema is not None else infer_schema(self.splits)
        self.variants = _variants(self.splits)
        #: The kind of every searchable variant of a field.
        self.kinds = {v: k for found in self.variants.values() for k, v in found.items()}
        self._parts: list[DataFrame] | None = None
        self._prepared: DataFrame | None = None
        self._statistics: dict = {}
        self.index: Index | None = None

    def spec(self) -> TableSpec:
        return TableSpec(self.name, tuple(self.splits), self.explicit)

    @property
    def public(self) -> list[str]:
        fast = [f.name for f in self.schema.fields if f.name not in (DOC_ID, SEGMENT)]
        return [DOC_ID, SEGMENT, *fast, SCORE, DOCUMENT]

    @property
    def table_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(SCORE, T.FloatType()), T.StructField(DOCUMENT, T.StringType())])

    def _own(self, split: SplitSpec, variant: str) -> FieldSpec | None:
        """A split's field, if it has that variant of it."""
        name, kind = self._names[variant], self.kinds[variant]
        own = split.field(name)
        return own if own is not None and (len(self.variants[name]) == 1 or (own.kind == "text") == (kind == "text")) else None

    @cached_property
    def _names(self) -> dict[str, str]:
        return {v: name for name, found in self.variants.items() for v in found.values()}

    def _raw_type(self, variant: str) -> T.DataType | None:
        """The common type of a field in all splits that have it: lists only if one has lists."""
        types = [own.type for s in self.splits if (own := self._own(s, variant))]
        inner = {t.elementType if isinstance(t, T.ArrayType) else t for t in types}
        if len(inner) > 1:
            return None
        return types[0] if len(set(map(str, types))) == 1 else T.ArrayType(inner.pop())

    def frame(self) -> DataFrame:
        """All splits: canonical columns, _document, _split and the raw fields."""
        if self._prepared is not None:
            return self._prepared
        if self._parts is None:
            self._parts = [self._part(s) for s in self.splits]
        return reduce(DataFrame.unionAll, self._parts)

    def _part(self, split: SplitSpec) -> DataFrame:
        df = read_split(self.spark, split)
        columns = [F.col(DOC_ID), F.col(SEGMENT)]
        for f in self.schema.fields:
            if f.name not in (DOC_ID, SEGMENT):
                columns.append(coerced(F.col(f"`{f.name}`"), split.field(f.name), f.dataType).alias(f.name))
        columns += [F.col(DOCUMENT), F.lit(split.split_id).alias(SPLIT)]
        for name in self.kinds:
            kind, own = self._raw_type(name), self._own(split, name)
            if kind is not None:
                value = F.lit(None) if own is None else F.col(f"`{own.name}`")
                if own is not None and isinstance(kind, T.ArrayType) and not own.multi:
                    value = F.when(value.isNotNull(), F.array(value))
                columns.append(value.cast(kind).alias(RAW + name))
        return df.select(*columns)

    def materialize(self, partitions: int | None = None) -> DataFrame:
        """Keep the table, with its texts in padded form and their word counts, for many queries on it.

        partitions: deals the rows anew, where a few large files would keep most cores idle in every query. Else splits of
        over PIECE_BYTES of files are dealt by place into pieces of about that size, however large a file or its row groups are.
        """
        if self._prepared is None:
            pieces = None if partitions is not None else self._pieces()
            df = self.frame().repartition(partitions) if partitions is not None else self.frame() if pieces is None else self.frame().repartition(pieces, SPLIT, SEGMENT, DOC_ID)
            texts = {n: F.array_join(RAW + n, "\n") if isinstance(self._raw_type(n), T.ArrayType) else F.col(RAW + n) for n, k in self.kinds.items() if k == "text"}
            df = df.select("*", *(padded(t).alias(PAD + n) for n, t in texts.items()), *(word_count(t).alias(WORDS + n) for n, t in texts.items()))
            self._prepared = df.persist()
        return self._prepared

    def _pieces(self) -> int | None:
        """Into how many pieces a kept table of files is dealt; None if it is small, or not of files alone."""
        if not all(isinstance(s.source, str) for s in self.splits):
            return None
        size = sum(int(str(self.spark.read.parquet(s.source)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for s in self.splits)
        return ceil(size / PIECE_BYTES) if size > PIECE_BYTES else None

    def release(self) -> None:
        if self._prepared is not None:
            self._prepared.unpersist()
            self._prepared = None

    @cached_property
    def searchable_names(self) -> frozenset[str]:
        """Variants that can be searched."""
        return frozenset(n for n in self.kinds if self._raw_type(n) is not None)

    @cached_property
    def field_names(self) -> frozenset[str]:
        """Names that full_text takes."""
        return frozenset(name for name, found in self.variants.items() if set(found.values()) <= self.searchable_names)

    def searchable(self) -> Mapping[str, Searchable]:
        """For compiling queries against frame(); a field that a split lacks is null there and so matches nothing."""
        return _Fields(self)

    def compiler(self) -> Compiler:
        return Compiler(self.searchable())

    def parse(self, field: str, query: str):
        """The tree of a query on a field, whose own and named fields all exist.

        A field that is text in one split and a whole value in another is searched as what it is in each.
        """
        known = self.field_names
        if field not in known:
            raise ValueError(f"full_text: field '{field}' not found in any split")
        node = parse(query, field)
        for leaf in leaves(node):
            if getattr(leaf, "field", field) not in known:
                raise ValueError(f"full_text: field '{leaf.field}' not found in any split")

        def variants(leaf):
            found = list(self.variants[leaf.field].values())
            return leaf if found == [leaf.field] else Group(should=tuple(replace(leaf, field=v) for v in found))

        return replaced(node, variants)

    def searched(self, nodes: list, columns: list[str], scored: bool) -> DataFrame:
        """frame() with a match column for each query and their summed score, by the index if there is one that can tell."""
        df, compiler, score = self.frame(), self.compiler(), None
        if self.index is not None and nodes:
            hits, compiler, score = self.index.hits(self, nodes, scored)
            df = df.join(hits, list(DOC_KEY), "left")
        score = score if score is not None else self.score_column(nodes if scored else [])
        return df.withColumns({n: compiler.matches(x) for n, x in zip(columns, nodes)} | {SCORE: score})

    def statistics(self, nodes: list) -> Statistics:
        """What the scores of these queries need, from one aggregate over the fields that they name; each number is asked for once."""
        words = sorted(set().union(*(scored_words(n, self.kinds) for n in nodes)) if nodes else set())
        fields = self.searchable()
        texts = sorted({f for f, _ in words if self.kinds[f] == "text"})
        asked = {("documents",): F.count("*")}
        asked |= {("words", f): F.avg(F.coalesce(fields[f].words, F.lit(0))) for f in texts}
        for f, w in words:
            x = fields[f]
            if x.kind == "text":
                holds = F.contains(F.lower(x.text), F.lit(w)) & F.contains(x.pad, F.lit(phrase_pattern([w])))
            else:
                holds = F.array_contains(x.column, w) if x.multi else x.column == w
            asked[("holding", f, w)] = F.count_if(holds)
        new = {k: c for k, c in asked.items() if k not in self._statistics}
        if new:
            row = self.frame().agg(*(c.alias(f"c{i}") for i, c in enumerate(new.values()))).first()
            self._statistics |= dict(zip(new, row))
        got = self._statistics
        return Statistics(got[("documents",)], {f: got[("words", f)] or 0.0 for f in texts}, {(f, w): got[("holding", f, w)] for f, w in words})

    def score_column(self, nodes: list, compiler: Compiler | None = None, statistics: Statistics | None = None) -> Column:
        """The sum of the queries' scores; null without any query."""
        if not nodes:
            return F.lit(None).cast("float")
        compiler, statistics = compiler or self.compiler(), statistics or self.statistics(nodes)
        total = compiler.score(nodes[0], statistics)
        for n in nodes[1:]:
            total = total + compiler.score(n, statistics)
        return total.cast("float")

    def refresh(self) -> None:
        """Read the splits' files anew, and forget what is known of the old ones."""
        self.release()
        self._parts, self._statistics, self.index = None, {}, None


def _variants(splits: list[SplitSpec]) -> dict[str, dict[str, str]]:
    """For each field its kinds as queries see them, with the name of each: text, and whole values of any type.

    A field that is both, in different splits, has two variants with names of their own.
    """
    found: dict[str, dict[str, str]] = {}
    for s in splits:
        for f in s.fields:
            found.setdefault(f.name, {})["text" if f.kind == "text" else f.kind] = f.name
    for name, kinds in found.items():
        values = [k for k in kinds if k != "text"]
        if len(values) > 1:  # the types decide whether these go together
            for k in values[1:]:
                kinds.pop(k)
        if len(kinds) > 1:
            found[name] = {k: f"{name}__{k}" for k in kinds}
    return found
