"""The engine: register collections, and query them by SQL, by search objects or by aggregation requests."""

from __future__ import annotations

import itertools
import warnings

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspire.operators.buckets import aggregate
from larkspire.operators.collection import Collection
from larkspire.operators.search import Search
from larkspire.plans.fields import SCORE, FieldSpec, SplitSpec, TableSpec
from larkspire.plans.sqlrewrite import Call, rewrite
from larkspire.sources.index import Index, build_index

_numbers = itertools.count()
#: Names of the views that engines made, by application.
_shown: dict[str, set[str]] = {}


class SearchEngine:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.collections: dict[str, Collection] = {}
        self._plain: dict[str, str] = {}

    def register(self, name: str, splits: list[SplitSpec | DataFrame | str], schema: T.StructType | None = None, fields: list[FieldSpec] | None = None) -> Collection:
        """Make a collection of splits. A DataFrame or path stands for a split of that content.

        schema: the canonical schema, else it is inferred. fields: for splits that don't say theirs.
        """
        made = []
        for i, s in enumerate(splits):
            s = s if isinstance(s, SplitSpec) else SplitSpec(f"split-{i}", s)
            made.append(s if s.fields or not fields else s.with_fields(fields))
        found = self.collections[name.lower()] = Collection(self.spark, name, made, schema)
        self._show(found)
        return found

    def _show(self, c: Collection) -> None:
        """Views of the table without scores: one of its name, and one that no other engine of the session replaces."""
        plain = c.frame().withColumn(SCORE, F.lit(None).cast("float")).select(*c.public)
        ours = _shown.setdefault(self.spark.sparkContext.applicationId, set())
        if c.name.lower() not in ours and self.spark.catalog.tableExists(c.name):
            warnings.warn(f"the collection's view '{c.name}' stands before a table or view of that name", stacklevel=3)
        ours.add(c.name.lower())
        plain.createOrReplaceTempView(c.name)
        own = self._plain.setdefault(c.name.lower(), f"__larkspire_{next(_numbers)}")
        plain.createOrReplaceTempView(own)

    def build_index(self, name: str, path: str) -> Index:
        """Write an inverted index of the collection's text fields to a path, and use it. A session to come has use_index()."""
        build_index(self.collection(name), path)
        return self.use_index(name, path)

    def use_index(self, name: str, path: str) -> Index:
        """Use the index at a path for full_text on the collection; one of other files than the splits have now is refused."""
        c, found = self.collection(name), Index(self.spark, path)
        found.check(c)
        c.index = found
        return found

    def refresh(self, name: str) -> None:
        """Read the splits' files anew; statistics and an index of the old ones are forgotten."""
        c = self.collection(name)
        c.refresh()
        self._show(c)

    def register_spec(self, spec: TableSpec | dict) -> Collection:
        spec = TableSpec.from_dict(spec) if isinstance(spec, dict) else spec
        return self.register(spec.name, list(spec.splits), spec.schema)

    def collection(self, name: str) -> Collection:
        if name.lower() not in self.collections:
            raise ValueError(f"no collection '{name}'")
        return self.collections[name.lower()]

    def table(self, name: str) -> Search:
        return Search(self.collection(name))

    def search(self, query: dict) -> Search:
        """The query that Search.to_dict() wrote down; its table is registered if there is none of its name."""
        name = query["table"]["name"]
        found = self.collections.get(name.lower()) or self.register_spec(query["table"])
        columns = query["columns"]
        return Search(found, tuple(map(tuple, query["full_text"])), tuple(query["filters"]), None if columns is None else tuple(columns), query["top_k"], tuple(query["ties"]), query["limit"])

    def explain(self, text: str, mode: str = "formatted") -> str:
        """A line for each collection that a statement reads, then Spark's plan."""
        kinds = self.spark._jvm.org.apache.spark.sql.execution.ExplainMode
        lines = [f"SearchScan {d['table']}: splits={len(d['splits'])}, query={d['raw_queries']}, score={d['needs_score']}, index={d['index']}" for d in self.describe(text)]
        return "\n".join([*lines, self.sql(text)._jdf.queryExecution().explainString(kinds.fromString(mode))])

    def describe(self, text: str) -> list[dict]:
        """The facts of each use of a collection in a statement, for logs and tests."""
        told = []

        def view(name: str, calls: list[Call], columns: list[str], scored: bool) -> str:
            c = self.collection(name)
            told.append({"table": c.name, "splits": [s.split_id for s in c.splits], "raw_queries": [(x.field, x.query) for x in calls], "needs_score": bool(calls) and scored, "index": c.index.path if c.index is not None and calls else None})
            return name

        rewrite(text, self._known(), view)
        return told

    def observed(self, text: str) -> tuple[DataFrame, Observation]:
        """A statement's rows, and what is told of them once they were read: output_rows."""
        seen = Observation()
        return self.sql(text).observe(seen, F.count(F.lit(1)).alias("output_rows")), seen

    def materialize(self, name: str, partitions: int | None = None) -> DataFrame:
        """Keep the collection's table in memory and on disk, with its texts prepared, for the queries that follow."""
        c = self.collection(name)
        kept = c.materialize(partitions)
        self._show(c)
        return kept

    def release(self, name: str) -> None:
        c = self.collection(name)
        c.release()
        self._show(c)

    def _known(self) -> dict[str, frozenset[str]]:
        return {n: c.field_names for n, c in self.collections.items()}

    def sql(self, text: str) -> DataFrame:
        """Spark SQL over collections and any other tables, with full_text(field, 'query') and _score."""
        made: list[str] = []

        def view(name: str, calls: list[Call], columns: list[str], scored: bool) -> str:
            if not calls:
                return self._plain[name]
            c = self.collection(name)
            df = c.searched([c.parse(x.field, x.query) for x in calls], columns, scored)
            made.append(f"__larkspire_{next(_numbers)}")
            df.select(*c.public, *columns).createOrReplaceTempView(made[-1])
            return made[-1]

        try:
            return self.spark.sql(rewrite(text, self._known(), view))
        finally:  # the plan holds what it needs of them
            for name in made:
                self.spark.catalog.dropTempView(name)

    def aggregate(self, name: str, request: dict, full_text: dict[str, str] | None = None, filters: list[str | Column] | str | None = None) -> DataFrame:
        """A search-style aggregation over the documents that match."""
        search = self.table(name)
        for field, query in (full_text or {}).items():
            search = search.full_text(field, query)
        for condition in [filters] if isinstance(filters, (str, Column)) else filters or []:
            search = search.where(condition)
        return aggregate(search.frame(), request)
