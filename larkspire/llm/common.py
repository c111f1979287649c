"""Helpers that several corpus operators share."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_libc = ctypes.CDLL(None)
#: Rows, and bytes of them, handled together inside a Python worker.
CHUNK_ROWS, CHUNK_BYTES = 512, 4 << 20
#: Bytes of an Arrow batch between the JVM and Python, unless the session says otherwise: both sides hold a few at a time.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; where it is unset, one in the warehouse, which all machines share, too."""
    own = spark.conf.get("spark.checkpoint.dir", None)
    return (own or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints").rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone at exit
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Paths of the tables that cut() wrote, by the scope that removes them.
_scopes: list[list[tuple[SparkSession, str]]] = [[]]


def _clear(tables: list[tuple[SparkSession, str]]) -> None:
    while tables:
        _remove(*tables.pop())


atexit.register(lambda: [_clear(s) for s in _scopes])


@contextlib.contextmanager
def scratch() -> Iterator[None]:
    """Intermediate tables made inside are removed at its end: write the results inside. Without one, the driver's exit removes them."""
    _scopes.append([])
    try:
        yield
    finally:
        _clear(_scopes.pop())


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it again: lineage ends there, and lost executors lose nothing.

    Parquet keeps such tables a few times smaller than checkpoint() would. They are removed when the scratch() around ends, or
    the driver exits, or by drop_table().
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/larkspire/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _scopes[-1].append((spark, path))
    made = spark.read.schema(df.schema).parquet(path)
    made._larkspire_path = path
    return made


def drop_table(made: DataFrame | None) -> None:
    """Remove a table that cut() returned; nothing may read it any more."""
    path = getattr(made, "_larkspire_path", None)
    if path:
        _remove(made.sparkSession, path)


def collect_garbage(spark: SparkSession) -> None:
    """Let the driver's JVM collect its garbage: Spark removes shuffle files and broadcasts when it finds their handles gone.

    By itself it does so every half hour, or when its heap has filled with them.
    """
    gc.collect()  # Python's handles hold the JVM's
    spark._jvm.System.gc()


def give_back() -> None:
    """Return freed memory to the system: Spark uses its Python workers again, and the driver lives on, for other stages, too."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if (trim := getattr(_libc, "malloc_trim", None)) is not None:
        trim(0)


def chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most CHUNK_ROWS rows and CHUNK_BYTES bytes; a single row may be larger."""
    start = 0
    while start < batch.num_rows:
        part = batch.slice(start, CHUNK_ROWS)
        while part.num_rows > 1 and part.nbytes > CHUNK_BYTES:
            part = part.slice(0, part.num_rows // 2)
        yield part
        start += part.num_rows


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of what follows in bytes, unless the session has a bound of its own."""
    if BATCH_BYTES[0] not in spark.conf.getAll:
        spark.conf.set(*BATCH_BYTES)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow with batches of bounded size."""
    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_chunks(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | None], schema: str, done: Callable[[], None] | None = None) -> DataFrame:
    """mapInArrow in chunks(); function gets a batch of df's columns and returns rows of schema.

    done is called when a task ends.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                out = function(part)
                if out is not None and out.num_rows:
                    yield from out.to_batches() if isinstance(out, pa.Table) else (out,)
        if done is not None:
            done()
        give_back()

    return map_arrow(df, run, schema)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's decimal text modulo 5 is 0. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def row_key(df: DataFrame, *columns: str) -> Column:
    """A key of a row's content, so that rows which repeat an id with other content stay apart."""
    return F.xxhash64(*[df[c] for c in columns])
