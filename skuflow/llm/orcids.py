"""Token ids as ORC files (operator 9).

``write`` range-partitions the documents by doc_id, encodes each within its task
and writes ORC: the ids are an integer array column, which ORC stores by integer
run-length encoding, each stripe has a row index (min/max per stride) and a Bloom
filter on doc_id, so a reader splits work by stripe and skips stripes and strides
by their metadata. Files follow ascending doc_id. ``read`` gives the documents
back from the files, with each one's first position in the whole id stream.

Null text counts as empty (the end id alone). A null doc_id sorts first; rows
that share a doc_id follow each other by text. An empty table gives no rows;
other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skuflow.llm import tokens
from skuflow.llm.common import small_batches, text_blocks

FILE_SCHEMA = "doc_id bigint, part bigint, part_start bigint, n_tokens bigint, ids array<int>"
STRIPE_BYTES, INDEX_STRIDE, BLOOM_FPP = 32 << 20, 2000, 0.01


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = tokens.END_ID,
          stripe_bytes: int = STRIPE_BYTES, index_stride: int = INDEX_STRIDE) -> None:
    """Write the ids of all documents under ``path``, in ascending doc_id order."""
    small_batches(docs.sparkSession, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(vocabulary)
        part, position = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(1), tokens.TOKEN_BLOCK):
                ids, begin = encode.block(data, offsets, end_id)
                n = hi - lo
                lists = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array(np.full(n, part)), pa.array(position + begin[:-1]),
                     pa.array(np.diff(begin)), lists], ["doc_id", "part", "part_start", "n_tokens", "ids"])
                position += len(ids)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # rows of one id, a null above all, are dealt by their text too; within an id they go by its hash
    order = ("doc_id", F.xxhash64("text"), "text")
    (rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
     .mapInArrow(run, FILE_SCHEMA)
     .write.option("compression", "zstd").option("orc.stripe.size", stripe_bytes)
     .option("orc.row.index.stride", index_stride).option("orc.create.index", "true")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", BLOOM_FPP).orc(path))


def _file_starts(rows: DataFrame) -> DataFrame:
    """Ids before each file: one row per file, so the running sum is small however many documents there are."""
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("__total"))
    return totals.select(F.col("part").alias("__part"),
                         (F.sum("__total").over(Window.orderBy("part")) - F.col("__total")).alias("__before"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before it), n_tokens, ids."""
    rows = spark.read.schema(FILE_SCHEMA).orc(path)
    before = _file_starts(rows)
    return (rows.join(before, rows["part"] == before["__part"])
            .select("doc_id", (F.col("__before") + F.col("part_start")).alias("start"), "n_tokens", "ids"))


def digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of each document's ids as little-endian unsigned 32-bit integers.

    The ids are digested where they are read; only a short row per document meets the file starts.
    """
    small_batches(spark, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values, at = np.asarray(lists.values).astype("<u4"), np.asarray(lists.offsets)
            crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
                ["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])

    files = spark.read.schema(FILE_SCHEMA).orc(path)
    rows = files.select("doc_id", "part", "part_start", "ids").mapInArrow(
        run, "doc_id bigint, part bigint, part_start bigint, n_tokens bigint, ids_crc32 bigint")
    before = _file_starts(files)
    return (rows.join(before, rows["part"] == before["__part"])
            .select("doc_id", (F.col("__before") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"))
