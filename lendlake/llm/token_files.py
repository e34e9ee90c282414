"""Token ids as Parquet lists, with files laid out for selective reads.

Documents are written in ascending id order, one file per key range:

* ``ids`` is a list column, dictionary-encoded (a vocabulary fits one
  dictionary page, so ids are bit-packed to its width);
* ``doc_id``, ``local_start`` and ``n_tokens`` rise or are small, and are
  delta-encoded (data page version 2, no dictionary);
* row groups and pages have fixed target sizes, and each file carries column
  and offset indexes, so a range of ids reads only the pages that hold it, and
  metadata reads touch no page of ``ids``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlake.llm.arrow import by_bytes, list_array, map_batches, replaced_schema, with_columns
from lendlake.llm.word_tokens import encoder

FILE_COLUMNS = "doc_id bigint, part int, local_start bigint, n_tokens bigint, ids array<int>"


def write(
    docs: DataFrame,
    target: str,
    path: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 64 << 10,
) -> None:
    """Encode every whole text, append ``end_id``, write files to the folder ``target``.

    Ids rise within and between files (nulls first); rows of one id follow each
    other in the order read, and a row number in the sort key lets even a
    repeated id spread over several ranges.  Null and empty texts give the end
    id alone; other columns are not read; an empty table writes empty files.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.col(f"`{text}`").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    ordered = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
    end = np.array([end_id], np.uint32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, start = encoder(path), TaskContext.get().partitionId(), 0
        for batch in by_bytes(batches, "text", 4 << 20):
            packed = [x + end for x in coder.encode([x or "" for x in batch.column("text").to_pylist()])]
            sizes = np.array([len(x) // 4 for x in packed], np.int64)
            starts = start + np.cumsum(sizes) - sizes
            start += int(sizes.sum())
            more = {
                "part": pa.array(np.full(len(packed), part, np.int32)),
                "local_start": pa.array(starts),
                "n_tokens": pa.array(sizes),
                "ids": list_array(packed, pa.int32()),
            }
            yield with_columns(batch, ["text", "row"], more)

    writer = map_batches(ordered, run, FILE_COLUMNS).write.option("compression", "zstd")
    settings = {
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.writer.version": "v2",
        "parquet.enable.dictionary": "true",
        "parquet.enable.dictionary#doc_id": "false",
        "parquet.enable.dictionary#local_start": "false",
        "parquet.enable.dictionary#n_tokens": "false",
    }
    for key, value in settings.items():
        writer = writer.option(key, str(value))
    writer.parquet(target)


def read(spark: SparkSession, target: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The files' rows with ``start``, the ids of all documents before.

    ``first`` and ``last`` limit the doc ids read (by page index); the starts
    still count all documents, from the metadata columns alone.
    """
    files = spark.read.schema(FILE_COLUMNS).parquet(target)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # One row per file from here: the running total needs them in one task, and the join may send them to all.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rows = files
    if first is not None:
        rows = rows.filter(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.filter(F.col("doc_id") <= last)
    return rows.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids"
    )


def with_crc(tokens: DataFrame, ids: str = "ids", out: str = "ids_crc32") -> DataFrame:
    """Replace the list by the CRC-32 of its ids as little-endian unsigned 32-bit integers."""
    schema = replaced_schema(tokens, [ids, out], T.StructField(out, T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, ids):
            lists = batch.column(ids)
            ends = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            crcs = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
            yield with_columns(batch, [ids, out], {out: pa.array(crcs, pa.int64())})

    return map_batches(tokens, run, schema)
