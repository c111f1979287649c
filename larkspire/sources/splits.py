"""Open splits: read their documents and give each its place, type its fields, and leave out deleted ones."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspire.plans.fields import DOC_ID, DOCUMENT, KINDS, SEGMENT, FieldSpec, SplitSpec, fields_of

#: In a column from monotonically_increasing_id() the partition stands above so many bits.
PARTITION_BITS = 33
FILE, AHEAD = "__larkspire_file", "__larkspire_ahead"


def open_split(spark: SparkSession, split: SplitSpec) -> SplitSpec:
    """The split with its fields known."""
    if split.fields:
        return split
    df = spark.read.parquet(split.source) if isinstance(split.source, str) else split.source
    return split.with_fields(fields_of(df.schema))


def _placed(spark: SparkSession, split: SplitSpec) -> DataFrame:
    """The split's columns with _doc_id (place in its segment) and _segment_ord (number of the file or partition).

    Files are numbered in the order of their full paths. The numbers come by a join with the table of files, which Catalyst
    leaves out of plans that don't use them, as it knows that a path is there once. In a split of one segment the join tells how
    many documents the files before have; only their footers are read for that. The table, a row a file, is broadcast: else Spark,
    which doesn't know its size, deals all columns by file. A DataFrame that has these columns keeps them.
    """
    if isinstance(split.source, str):
        df = spark.read.parquet(split.source)
        paths = sorted({_one_way(p) for p in df.inputFiles()})
        own = F.regexp_replace("_metadata.file_path", "^([^:/]+):/+", "$1:/").alias(FILE)
        placed = df.select("*", F.col("_metadata.row_index").alias(DOC_ID), own)
        if len(paths) < 2:
            return placed.withColumn(SEGMENT, F.lit(0)).drop(FILE)
        if split.one_segment:
            ahead = Window.orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1)
            files = df.select(own).groupBy(FILE).agg(F.count("*").alias(AHEAD)).withColumn(AHEAD, F.coalesce(F.sum(AHEAD).over(ahead), F.lit(0)))
            return placed.join(F.broadcast(files), FILE, "left").withColumns({DOC_ID: F.col(DOC_ID) + F.col(AHEAD), SEGMENT: F.lit(0)}).drop(FILE, AHEAD)
        files = spark.createDataFrame([(p, i) for i, p in enumerate(paths)], f"{FILE} string, {SEGMENT} int").groupBy(FILE).agg(F.min(SEGMENT).alias(SEGMENT))
        return placed.join(F.broadcast(files), FILE, "left").drop(FILE)
    df = split.source
    if DOC_ID in df.columns:
        return df if SEGMENT in df.columns else df.withColumn(SEGMENT, F.lit(0))
    place = F.monotonically_increasing_id()
    return df.withColumns({DOC_ID: place.bitwiseAND(F.lit((1 << PARTITION_BITS) - 1)), SEGMENT: F.shiftright(place, PARTITION_BITS).cast("int")})


def _one_way(path: str) -> str:
    """file:/x and file:///x are the same."""
    return re.sub("^([^:/]+):/+", "\\1:/", path)


def files_state(spark: SparkSession, split: SplitSpec) -> str:
    """A fingerprint of the files of a split that is named by a path: their names, sizes and times."""
    meta = spark.read.parquet(split.source).select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s"), F.col("_metadata.file_modification_time").alias("t")).distinct()
    row = meta.agg(F.count("*").alias("n"), F.sum(F.xxhash64("p", "s", "t").cast("decimal(38,0)")).alias("h")).first()
    return f"{row['n']}:{row['h']}"


def _without_deleted(df: DataFrame, split: SplitSpec) -> DataFrame:
    if split.deleted:
        df = df.where(~F.coalesce(F.expr(split.deleted), F.lit(False)))
    if split.tombstones is not None:
        keys = [c for c in split.tombstones.columns if c in df.columns]
        if not keys:
            raise ValueError(f"the tombstones of split '{split.split_id}' have no column that it has")
        df = df.join(split.tombstones.select(keys).distinct(), keys, "left_anti")
    return df


def typed(column: Column, f: FieldSpec, own: T.DataType) -> Column:
    """The field's value as its kind's type. A list where one value is expected gives its first; one where a list is, a list."""
    wanted, listed = KINDS[f.kind], isinstance(own, T.ArrayType)
    inner = own.elementType if listed else own
    if listed and not f.multi:
        column = F.try_element_at(column, F.lit(1))
    if f.multi:
        if not listed:
            column = F.when(column.isNotNull(), F.array(column))
        return column if inner == wanted else column.cast(T.ArrayType(wanted))
    if f.kind == "ip":
        column = F.regexp_replace(column.cast("string"), "^::ffff:(?=[0-9]+\\.)", "")
    return column if inner == wanted else column.cast(wanted)


def document_json(df: DataFrame, split: SplitSpec) -> Column:
    """Stored fields as JSON: each a list of its values, in alphabetical order, absent ones left out."""
    parts = []
    for f in sorted((f for f in split.fields if f.stored), key=lambda f: f.name):
        value = typed(F.col(f"`{f.name}`"), f, df.schema[f.name].dataType)
        parts.append((F.when(F.size(value) > 0, value) if f.multi else F.when(value.isNotNull(), F.array(value))).alias(f.name))
    return F.to_json(F.struct(*parts)) if parts else F.lit("{}")


def read_split(spark: SparkSession, split: SplitSpec) -> DataFrame:
    """Every field of the split as a column of its type, with _doc_id, _segment_ord and _document."""
    df = _without_deleted(_placed(spark, split), split)
    columns = [typed(F.col(f"`{f.name}`"), f, df.schema[f.name].dataType).alias(f.name) for f in split.fields]
    return df.select(F.col(DOC_ID).cast("bigint").alias(DOC_ID), F.col(SEGMENT).cast("int").alias(SEGMENT), *columns, document_json(df, split).alias(DOCUMENT))
