"""What a collection is made of: fields, and splits that hold documents with them."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Spark's type for each kind of field. u64big is for values beyond 2^63 - 1.
KINDS = {
    "u64": T.LongType(),
    "u64big": T.DecimalType(20, 0),
    "i64": T.LongType(),
    "f64": T.DoubleType(),
    "bool": T.BooleanType(),
    "date": T.TimestampNTZType(),
    "text": T.StringType(),
    "string": T.StringType(),
    "bytes": T.BinaryType(),
    "ip": T.StringType(),
}
DOC_ID, SEGMENT, SCORE, DOCUMENT, SPLIT = "_doc_id", "_segment_ord", "_score", "_document", "_split"
RESERVED = (DOC_ID, SEGMENT, SCORE, DOCUMENT, SPLIT)


@dataclass(frozen=True)
class FieldSpec:
    """A field of a split. Only fast fields are columns of the table; stored ones are in _document.

    kind `text` is analysed into words for full_text, `string` is one term. multi: documents may have several values.
    """

    name: str
    kind: str
    fast: bool = True
    stored: bool = False
    multi: bool = False

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown field kind '{self.kind}' for '{self.name}'")
        if self.name in RESERVED:
            raise ValueError(f"field name '{self.name}' is reserved")

    @property
    def searchable(self) -> bool:
        return self.kind in ("text", "string")

    @property
    def type(self) -> T.DataType:
        own = KINDS[self.kind]
        return T.ArrayType(own) if self.multi else own

    def to_dict(self) -> dict:
        return {"name": self.name, "kind": self.kind, "fast": self.fast, "stored": self.stored, "multi": self.multi}


def fields_of(schema: T.StructType, text: tuple[str, ...] = (), stored: tuple[str, ...] = (), hidden: tuple[str, ...] = ()) -> list[FieldSpec]:
    """Specs for the supported columns of a schema; other columns (maps, structs, nested lists) are left out.

    text: analysed columns; stored: columns of _document; hidden: columns that aren't fast.
    """
    found = []
    for f in schema.fields:
        own = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        if isinstance(own, T.StringType):
            kind = "text" if f.name in text else "string"
        elif isinstance(own, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            kind = "i64"
        elif isinstance(own, (T.FloatType, T.DoubleType)):
            kind = "f64"
        elif isinstance(own, T.DecimalType) and own.scale == 0 and own.precision == 20:
            kind = "u64big"
        elif isinstance(own, T.BooleanType):
            kind = "bool"
        elif isinstance(own, (T.TimestampType, T.TimestampNTZType)):
            kind = "date"
        elif isinstance(own, T.BinaryType):
            kind = "bytes"
        else:
            continue
        if f.name not in RESERVED:
            found.append(FieldSpec(f.name, kind, f.name not in hidden, f.name in stored, isinstance(f.dataType, T.ArrayType)))
    return found


@dataclass(frozen=True)
class SplitSpec:
    """One split: a path that Spark reads as Parquet, or a DataFrame, with its fields.

    deleted: a SQL condition on the split's own columns that deleted documents meet. tombstones: a DataFrame whose rows
    name deleted documents by columns that the split has, too. one_segment: the documents of all its files are numbered
    through, in the order of the files' paths, as one segment; else each file is a segment. A DataFrame has its partitions.
    """

    split_id: str
    source: str | DataFrame
    fields: tuple[FieldSpec, ...] = ()
    deleted: str | None = None
    tombstones: DataFrame | None = None
    one_segment: bool = False

    def with_fields(self, fields: list[FieldSpec]) -> SplitSpec:
        return replace(self, fields=tuple(fields))

    def field(self, name: str) -> FieldSpec | None:
        return next((f for f in self.fields if f.name == name), None)

    def to_dict(self) -> dict:
        """For splits that are named by a path: what another session needs to open the split."""
        if not isinstance(self.source, str) or self.tombstones is not None:
            raise ValueError(f"split '{self.split_id}' isn't described by a path alone")
        told = {"split_id": self.split_id, "source": self.source, "fields": [f.to_dict() for f in self.fields], "deleted": self.deleted}
        return told | ({"one_segment": True} if self.one_segment else {})

    @staticmethod
    def from_dict(spec: dict) -> SplitSpec:
        return SplitSpec(spec["split_id"], spec["source"], tuple(FieldSpec(**f) for f in spec["fields"]), spec.get("deleted"), one_segment=spec.get("one_segment", False))


@dataclass(frozen=True)
class TableSpec:
    """A serialisable collection: its name, splits, and the schema if one was given."""

    name: str
    splits: tuple[SplitSpec, ...]
    schema: T.StructType | None = field(default=None)

    def to_dict(self) -> dict:
        return {"name": self.name, "splits": [s.to_dict() for s in self.splits], "schema": self.schema.jsonValue() if self.schema else None}

    @staticmethod
    def from_dict(spec: dict) -> TableSpec:
        schema = T.StructType.fromJson(spec["schema"]) if spec.get("schema") else None
        return TableSpec(spec["name"], tuple(SplitSpec.from_dict(s) for s in spec["splits"]), schema)
