"""Helpers shared by the corpus operators: scratch tables, Arrow text blocks."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A bitmap of keys has so many bits (2 to this power), as a table of at most 2^19 rows.
KEY_BITS = 25
#: Scratch tables of the running scope, and those of the last one.
_scope: list[str] | None = None
_last: dict[str, list[str]] = {}

#: Text bytes that one numpy pass handles at a time; a longer text is one block of its own.
BLOCK_BYTES = 1 << 20


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a temporary one only in local mode."""
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="corpus-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and return the written table.

    Later steps read finished files: nothing is computed twice, and a lost
    executor costs a re-read.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scope is not None:
        _scope.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def step(function: Callable) -> Callable:
    """A pipeline stage (spark, docs, sf_dir): its scratch tables go when the next stage of the application begins.

    A stage's result may read its scratch tables, so it must be written before the next stage is called.
    """

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        global _scope
        application = spark.sparkContext.applicationId
        for path in _last.pop(application, []):
            _delete(spark, path)
        _scope = []
        try:
            return function(spark, docs, sf_dir)
        finally:
            _last[application], _scope = _scope, None

    return run


def _delete(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that ``stage`` wrote, in whatever file system it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


def without(df: DataFrame, bad: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``bad`` (one column of that name); rows of a null key stay.

    The keys' hashes become a bitmap of a fixed size, a small table whatever the number of keys.
    Rows that miss it stay where they are; only the others go through an anti-join.
    """
    mark, word, bits = (free_name(df, c) for c in ("_mark", "_word", "_bits"))
    hashed = F.shiftrightunsigned(F.xxhash64(key), 64 - KEY_BITS)
    spots = (bad.select(hashed.alias(mark)).groupBy(F.shiftright(mark, 6).alias(word))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, cast({mark} & 63 as int))")).alias(bits)))
    marked = df.withColumn(mark, hashed).join(F.broadcast(spots), F.shiftright(mark, 6) == F.col(word), "left")
    seen = F.coalesce(F.expr(f"shiftrightunsigned({bits}, cast({mark} & 63 as int)) & 1") == 1, F.lit(False))
    rest = marked.where(seen).select(*df.columns).join(bad.select(key).distinct(), key, "left_anti").select(*df.columns)
    return marked.where(~seen).select(*df.columns).union(rest)


def release() -> None:
    """Give memory that a task has freed back to the system: its Python worker serves later stages too."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):                    # glibc only
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bound what one Arrow batch holds: texts can be long, so batches have few rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def held_out(doc_id: Column) -> Column:
    """The contract's split: crc32 of the id as text, remainder 1 of 3 (a null id is never held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows: (first row, end row, UTF-8 bytes, offsets of the rows).

    A null reads as an empty text. Rows are never cut.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if n == 0:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi
