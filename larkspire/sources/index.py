"""A durable inverted index of a collection's text fields.

postings has a row for each field, word and document: how often it occurs, and the words of the field in that document. They lie in a
folder for each field, sorted by word, so a query's words reach the Parquet scan as pushed filters and few row groups are
read; a word that very many documents have spreads over files, as the documents are part of the order. Documents and mean
lengths, and the state of the splits that were indexed, lie beside them. An index of other files, or of other deleted
documents, is refused.
"""

from __future__ import annotations

import hashlib
import json
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspire.functions.analysis import BREAKS, LONGEST, too_long, word_count, words_of
from larkspire.functions.fulltext import Compiler, Searchable, Statistics, scored_words
from larkspire.functions.querylang import Term, leaves
from larkspire.plans.fields import DOC_ID, SEGMENT, SPLIT, SplitSpec
from larkspire.sources.splits import files_state

DOC_KEY = (SPLIT, SEGMENT, DOC_ID)
VERSION = 1
#: Of the words that are indexed, those of one task: it sorts at most so many postings, of about 120 bytes each in memory.
WORDS_PER_TASK = 2_000_000


def state_of(spark: SparkSession, splits: list[SplitSpec]) -> str:
    """A fingerprint of splits: what they are, and their files."""
    told = []
    for s in splits:
        if not isinstance(s.source, str) or s.tombstones is not None:
            raise ValueError(f"split '{s.split_id}' isn't described by a path alone, so an index of it can't be kept")
        told.append([s.to_dict(), files_state(spark, s)])
    return hashlib.sha256(json.dumps([VERSION, told], sort_keys=True).encode()).hexdigest()


def build_index(collection, path: str) -> None:
    """Write the index of all text fields of a collection; what is at path is replaced."""
    spark, fields = collection.spark, collection.searchable()
    texts = sorted(n for n in collection.searchable_names if collection.kinds[n] == "text")
    state, frame = state_of(spark, collection.splits), collection.frame()
    parts = [frame.select(*DOC_KEY, F.lit(n).alias("field"), fields[n].text.alias("text")).where("text IS NOT NULL") for n in texts]
    if not parts:
        raise ValueError(f"collection '{collection.name}' has no text field to index")
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionAll(p)
    totals = [F.sum(word_count(fields[n].text)).alias(f"s{i}") for i, n in enumerate(texts)]
    row = frame.agg(F.count("*").alias("n"), *totals).first()
    counted = {n: row[f"s{i}"] or 0 for i, n in enumerate(texts)}
    tasks = max(1, ceil(sum(counted.values()) / WORDS_PER_TASK))
    words = F.sort_array(F.filter(F.split(F.lower("text"), BREAKS), lambda w: (w != "") & (F.octet_length(w) <= LONGEST)))
    postings = rows.select(*DOC_KEY, "field", words.alias("words")).select(*DOC_KEY, "field", F.size("words").alias("length"), F.inline(_runs(F.col("words"))))
    order = ["field", "term", *DOC_KEY]
    postings.repartitionByRange(tasks, *order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("field").parquet(f"{path}/postings")
    facts = [(state, row["n"], {n: total / max(1, row["n"]) for n, total in counted.items()})]
    spark.createDataFrame(facts, "state string, documents bigint, mean_words map<string, double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")


def _runs(words: Column) -> Column:
    """The different words of a sorted array, each with how often it is there: [(term, tf)].

    A document's words are counted within its row, so postings are dealt out once, to be sorted, and no task holds a table of
    them. The inner transforms over one value name what is used for every element; Catalyst can't copy it there.
    """
    def counted(w: Column) -> Column:
        n = F.size(w)
        places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(places, lambda i: (i == 0) | (F.get(w, i) != F.get(w, i - 1)))
        return F.transform(F.array(starts), lambda s: F.transform(s, lambda p, k: F.struct(F.get(w, p).alias("term"), (F.coalesce(F.get(s, k + 1), F.size(w)) - p).alias("tf"))))[0]

    return F.transform(F.array(words), counted)[0]


class Index:
    """An index that was written to a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        facts = spark.read.parquet(f"{path}/facts").first()
        self.state, self.documents, self.mean_words = facts["state"], facts["documents"], facts["mean_words"]
        self.postings = spark.read.option("mergeSchema", "false").parquet(f"{path}/postings")
        self.holding: dict[tuple[str, str], int] = {}

    def check(self, collection) -> None:
        if state_of(collection.spark, collection.splits) != self.state:
            raise ValueError(f"the index at '{self.path}' is of other splits or files than '{collection.name}' has now; build it anew")

    def of(self, asked: list[tuple[str, str, bool]]) -> DataFrame:
        """The postings of words, or of words by their starts; folders are chosen by field, row groups by word."""
        starts, whole = [w for _, w, start in asked if start], [w for _, w, start in asked if not start]
        term = _any([*([F.col("term").isin(sorted(set(whole)))] if whole else []), *(F.col("term").startswith(w) for w in starts)])
        rows = self.postings.where(F.col("field").isin(sorted({f for f, _, _ in asked})) & term)
        return rows.where(_any([_holds(*x) for x in asked]))

    def statistics(self, words: set[tuple[str, str]], collection) -> Statistics:
        """Counts of text words from the index; each is asked for once."""
        new = sorted(w for w in words if w not in self.holding and w[0] in self.mean_words)
        if new:
            self.holding |= dict.fromkeys(new, 0)
            counted = self.of([(f, w, False) for f, w in new]).groupBy("field", "term").count()
            self.holding |= {(r["field"], r["term"]): r["count"] for r in counted.collect()}  # as many rows as the query has words
        return Statistics(self.documents, self.mean_words, {w: self.holding[w] for w in words if w in self.holding})

    def hits(self, collection, nodes: list, scored: bool) -> tuple[DataFrame, Compiler, Column | None]:
        """Documents (DOC_KEY) that have any of the queries' words, with columns that the compiler uses; and the score."""
        asked: dict[tuple[str, str, bool], str] = {}
        for node in nodes:
            for leaf in leaves(node):
                if isinstance(leaf, Term) and leaf.field in self.mean_words:
                    found = words_of(leaf.text)
                    for i, w in enumerate(found):
                        asked.setdefault((leaf.field, w, leaf.prefix and i + 1 == len(found)), f"__hit_{len(asked)}")
        lengths = {f: f"__length_{i}" for i, f in enumerate(sorted({f for f, _, _ in asked}))}
        aggregates = [F.max(F.when(_holds(*key), F.col("tf"))).alias(name) for key, name in asked.items()]
        aggregates += [F.max(F.when(F.col("field") == f, F.col("length"))).alias(name) for f, name in lengths.items()]
        some = self.of(list(asked)) if asked else self.postings.where(F.lit(False))
        hits = some.groupBy(*DOC_KEY).agg(*aggregates) if aggregates else some.select(*DOC_KEY)
        compiler = IndexCompiler(collection.searchable(), asked, lengths)
        if not scored:
            return hits, compiler, F.lit(None).cast("float")
        words = set().union(*(scored_words(n, collection.kinds) for n in nodes))
        others = [n for n in nodes if any(collection.kinds[f] != "text" for f, _ in scored_words(n, collection.kinds))]
        own = self.statistics(words, collection)
        if others:  # whole values are counted in the table
            more = collection.statistics(others).holding
            own = Statistics(own.documents, own.mean_words, {k: v for k, v in more.items() if k not in own.holding} | own.holding)
        return hits, compiler, collection.score_column(nodes, compiler, own)


class IndexCompiler(Compiler):
    """Words come from the index; phrases are looked for in the texts of the documents that have their words."""

    def __init__(self, fields, asked: dict[tuple[str, str, bool], str], lengths: dict[str, str]):
        super().__init__(fields)
        self.asked, self.lengths = asked, lengths

    def _words(self, f: Searchable, node: Term) -> Column:
        words = words_of(node.text)
        if not words or too_long(words if not node.prefix else words[:-1]) or node.field not in self.lengths:
            return super()._words(f, node)
        there = F.lit(True)
        for i, w in enumerate(words):
            there = there & F.col(self.asked[node.field, w, node.prefix and i + 1 == len(words)]).isNotNull()
        return there if len(words) == 1 else there & super()._words(f, node)

    def occurring(self, f: Searchable, node: Term, words: list[str]) -> Column:
        if len(words) == 1 and node.field in self.lengths:
            return F.coalesce(F.col(self.asked[node.field, words[0], False]), F.lit(0))
        if node.field in self.lengths:
            return F.when(self.matches(node), super().occurring(f, node, words)).otherwise(F.lit(0))
        return super().occurring(f, node, words)

    def length(self, f: Searchable, name: str) -> Column:
        return F.coalesce(F.col(self.lengths[name]), F.lit(0)) if name in self.lengths else super().length(f, name)


def _holds(field: str, word: str, start: bool) -> Column:
    return (F.col("field") == field) & (F.col("term").startswith(word) if start else F.col("term") == word)


def _any(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return out
