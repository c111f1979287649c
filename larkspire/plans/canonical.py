"""One schema over splits whose fields drifted apart, and the columns that bring each split to it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspire.plans.fields import DOC_ID, SEGMENT, FieldSpec, SplitSpec

NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
TIMES = (T.TimestampType, T.TimestampNTZType)
INTERNAL = {DOC_ID: T.LongType(), SEGMENT: T.IntegerType()}


def _inner(t: T.DataType) -> T.DataType:
    return t.elementType if isinstance(t, T.ArrayType) else t


def merge_types(name: str, a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    if _inner(a) == _inner(b):
        return T.ArrayType(_inner(a))
    raise ValueError(f"conflicting fast field types for '{name}': {a.simpleString()} and {b.simpleString()}; provide an explicit canonical schema")


def infer_schema(splits: list[SplitSpec]) -> T.StructType:
    """Fast fields of all splits by name, in the order in which they first appear, after the two internal ones."""
    if not splits:
        raise ValueError("a collection requires at least one local split or split descriptor")
    found: dict[str, T.DataType] = {}
    for split in splits:
        for f in split.fields:
            if f.fast:
                found[f.name] = merge_types(f.name, found[f.name], f.type) if f.name in found else f.type
    return _schema(found)


def _schema(found: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in INTERNAL) for n, t in (INTERNAL | found).items()])


def explicit_schema(schema: T.StructType, splits: list[SplitSpec]) -> T.StructType:
    """The given schema with the internal fields before it; every split is checked against it at once."""
    if not splits:
        raise ValueError("a collection requires at least one local split or split descriptor")
    whole = _schema({f.name: f.dataType for f in schema.fields if f.name not in INTERNAL})
    for split in splits:
        for f in whole.fields:
            own = split.field(f.name)
            if own is not None and own.fast:
                check_coercion(f.name, own.type, f.dataType)
    return whole


def check_coercion(name: str, own: T.DataType, wanted: T.DataType) -> str:
    """How a split's field becomes the canonical one: exact, cast or promote."""
    if own == wanted:
        return "exact"
    if isinstance(wanted, T.ArrayType):
        if isinstance(own, T.ArrayType):
            raise ValueError(f"cannot coerce split field '{name}': list coercions require an exact list type match")
        check_coercion(name, own, wanted.elementType)
        return "promote"
    number, text = isinstance(own, NUMBERS), isinstance(wanted, T.StringType)
    allowed = (
        (number and isinstance(wanted, NUMBERS))
        or (text and (number or isinstance(own, (T.BooleanType, *TIMES))))
        or (isinstance(own, TIMES) and isinstance(wanted, TIMES))
    )
    if not allowed:
        raise ValueError(f"cannot coerce split field '{name}' from {own.simpleString()} to {wanted.simpleString()}")
    return "cast"


def coerced(column: Column, f: FieldSpec | None, wanted: T.DataType) -> Column:
    """The canonical column of a split: null where it lacks the field; values that don't fit are null, too."""
    if f is None or not f.fast:
        return F.lit(None).cast(wanted)
    how = check_coercion(f.name, f.type, wanted)
    if how == "promote":
        value = column if f.type == _inner(wanted) else column.try_cast(wanted.elementType)
        return F.when(value.isNotNull(), F.array(value)).cast(wanted)
    if how == "cast":
        return column.try_cast(wanted)
    # A list field has an empty list where a document has no value.
    return F.coalesce(column, F.array().cast(wanted)) if isinstance(wanted, T.ArrayType) else column
