"""Small collections for the engine's tests."""

from datetime import datetime, timedelta

from larkspire.engine import SearchEngine
from larkspire.plans.fields import FieldSpec, SplitSpec

EPOCH = datetime(1970, 1, 1)
STD = [
    (1, 7, 0.5, True, "heron", 1, "198.51.100.1", b"a1"),
    (2, 14, 4.0, False, "otter", 2, "203.0.113.5", b"b2"),
    (3, 14, 2.0, True, "heron", 3, "198.51.100.2", b"c3"),
    (4, 28, 8.0, False, "otter", 4, "203.0.113.9", b"d4"),
    (5, 90, 16.0, True, "badger", 5, "192.0.2.44", b"e5"),
]
SCHEMA = "id long, height long, weight double, tame boolean, kind string, seen timestamp_ntz, host string, mark binary"
FIELDS = (
    FieldSpec("id", "u64", stored=True),
    FieldSpec("height", "i64"),
    FieldSpec("weight", "f64"),
    FieldSpec("tame", "bool"),
    FieldSpec("kind", "text", stored=True),
    FieldSpec("seen", "date"),
    FieldSpec("host", "ip"),
    FieldSpec("mark", "bytes"),
)


def frame(spark, rows=STD, partitions=1):
    rows = [(*r[:5], EPOCH + timedelta(seconds=r[5]), *r[6:]) for r in rows]
    return spark.createDataFrame(rows, SCHEMA).coalesce(partitions) if partitions == 1 else spark.createDataFrame(spark.sparkContext.parallelize(rows, partitions), SCHEMA)


def std(spark, name="t", rows=STD, partitions=1, **more):
    e = SearchEngine(spark)
    e.register(name, [SplitSpec("s", frame(spark, rows, partitions), FIELDS, **more)])
    return e


def split(spark, name, rows, schema, fields):
    return SplitSpec(name, spark.createDataFrame(rows, schema).coalesce(1), tuple(FieldSpec(*f[:2], **(f[2] if len(f) > 2 else {})) for f in fields))


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
