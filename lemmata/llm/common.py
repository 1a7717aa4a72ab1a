"""Shared plumbing of the training-data operators.

Defined results everywhere: a null text counts as an empty one. Operators that
look at each row by itself carry null and repeated ids through; those that relate
rows tell them apart by ``with_row``. Columns are selected before any are added,
so extra columns with clashing names can't collide. Texts may be as long as a
record of Arrow can hold (2 GB); a worker takes one such text by itself.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts are handed to a worker function in slices of about this many bytes.
SLICE_BYTES = 500_000


def cuts(lengths: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows whose lengths add up to at most ``limit``, or one row."""
    ends = np.cumsum(lengths)
    start = 0
    while start < len(ends):
        before = int(ends[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, end
        start = end


def slices(texts: list[str], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows that hold about ``limit`` characters each (one row at least)."""
    return cuts(np.fromiter(map(len, texts), np.int64, len(texts)), limit)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, list[str]]]:
    """(first row, end, texts) of a column of an Arrow batch, only one slice of which is ever made into strings."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    for a, b in cuts(lengths, limit):
        yield a, b, [t or "" for t in column.slice(a, b - a).to_pylist()]


def give_back() -> None:
    """Return freed memory of a worker to the system: workers are reused, and the next operator's caches come on top."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def settle(spark: SparkSession) -> None:
    """Return memory of ended work on the driver, and let the engine drop that work's broadcasts and shuffle files.

    Both go only when a collection finds them unreachable, which a driver between long jobs may not do for long.
    """
    spark.sparkContext._jvm.System.gc()
    give_back()


#: Bytes of an Arrow batch. The engine's default, 64 MB, is held several times at once by both sides of the pipe.
BATCH_BYTES = 4_000_000
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``df.mapInArrow(fn, schema)``, whose workers give freed memory back behind each partition.

    Sets the session's size of Arrow batches to BATCH_BYTES where nobody has set it.
    """
    conf = df.sparkSession.conf
    if _BATCH not in conf.getAll:
        conf.set(_BATCH, BATCH_BYTES)

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def map_texts(
    df: DataFrame,
    fn: Callable[[list[str]], dict[str, list]],
    out: str,
    keys: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """One row per input row: ``keys`` and the columns named in ``out`` (DDL).

    ``fn`` gets a list of texts and returns one list for each column. Batches
    are Arrow records cut into bounded slices, so one task never holds more
    than a record batch.
    """
    base = df.select(*(F.col(f"`{k}`") for k in keys), F.col(f"`{text}`").cast("string").alias("__text"))
    kinds = {f.name: f.dataType for f in base.schema.fields}
    ddl = ", ".join(f"`{k}` {kinds[k].simpleString()}" for k in keys) + ", " + out

    def run(batches):
        for batch in batches:
            for a, b, texts in text_slices(batch.column(len(keys)), limit):
                made = fn(texts)
                cols = [batch.column(i).slice(a, b - a) for i in range(len(keys))]
                yield pa.RecordBatch.from_arrays(
                    cols + [v if isinstance(v, pa.Array) else pa.array(v) for v in made.values()],
                    names=[*keys, *made],
                )

    return in_arrow(base, run, ddl)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only on one machine (a local master, as in tests) a local folder may take its place.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        master = spark.conf.get("spark.master", "")
        if master.split("[")[0] != "local":
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all machines share (master {master})")
        top = "file://" + os.path.join(tempfile.gettempdir(), "lemmata-shared")
    return top.rstrip("/")


#: Folders written by this driver that a result may still read; they go when the driver ends.
_written: list[tuple[SparkSession, str]] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/lemmata-{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        with contextlib.suppress(Exception):  # the session's JVM may be gone already
            remove(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that an operator wrote and no longer needs."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: The column that ``numbered`` adds.
ROW = "__row"


def numbered(docs: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ROW: a bigint, unique, that ascends with the id.

    It is the id itself where ids are integers, unique and not null. Else the rows
    are numbered, in a table in the shared folder, by id (nulls last) and digest of
    the text, so that equal and null ids have an order that doesn't change from run
    to run, up to rows that are equal in both.
    """
    own = F.col(f"`{id_col}`")
    if isinstance(docs.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        unclear = docs.select(own.alias("id")).groupBy("id").count().where("id is null or count > 1")
        if unclear.isEmpty():
            return docs.withColumn(ROW, own.cast("bigint"))
    place = [own.asc_nulls_last(), F.asc("__digest")]
    digest = F.sha2(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary"), 256)
    ranged = docs.withColumn("__digest", digest).repartitionByRange(*place).sortWithinPartitions(*place)
    # a partition's rows come in order, and monotonically increasing ids follow the partitions
    return materialize(ranged.drop("__digest").withColumn(ROW, F.monotonically_increasing_id()), "ordered")


def with_row(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` as (row, id, text), row as ``numbered`` has it."""
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return numbered(base, "id").select(F.col(ROW).alias("row"), "id", "text")


def is_id(docs: DataFrame) -> bool:
    """Whether ``docs`` (row, id, ...) has its ids as rows."""
    same = docs.schema["id"].dataType == docs.schema["row"].dataType
    return same and docs.where("id is null or id <> row").isEmpty()


def buckets(spark: SparkSession) -> int:
    return max(4, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


#: Sides of a join are broadcast up to this many rows; beyond it they are shuffled.
BROADCAST_ROWS = 500_000


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count shows that it has at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class Memo:
    """Worker cache from chunk to value, filled for many chunks at a time.

    It holds ``limit`` entries at most, and starts anew when more are needed;
    chunks of over 64 characters are made each time. A worker that goes on to another
    operator's memo drops the one it used before.
    """

    in_use: Memo | None = None

    def __init__(self, make_many: Callable[[list[str]], list], limit: int = 400_000):
        self.make_many, self.limit, self.known = make_many, limit, {}

    def _use(self) -> dict:
        if Memo.in_use is not self:
            if Memo.in_use is not None:
                Memo.in_use.known.clear()
                pa.default_memory_pool().release_unused()
            Memo.in_use = self
        return self.known

    def add(self, missing: list[str]) -> list:
        """The values of different chunks, none of them known."""
        known = self._use()
        if len(known) + len(missing) > self.limit:
            known.clear()
        made = self.make_many(missing)
        known.update((c, v) for c, v in zip(missing, made) if len(c) <= 64)
        return made

    def table(self, chunks: set[str]) -> dict:
        """A mapping that holds all of ``chunks``."""
        known = self._use()
        missing = [c for c in chunks if c not in known]
        if len(known) + len(missing) > self.limit:
            known.clear()
            missing = list(chunks)
        made = dict(zip(missing, self.make_many(missing))) if missing else {}
        long = [c for c in made if len(c) > 64]
        if not long:
            known.update(made)
            return known
        known.update((c, v) for c, v in made.items() if len(c) <= 64)
        return Layered(known, {c: made[c] for c in long})


class Layered(dict):
    """A small mapping in front of a large one."""

    def __init__(self, below: dict, own: dict):
        super().__init__(own)
        self.below = below

    def __missing__(self, key):
        return self.below[key]
