"""Arrow batches inside tasks: bounded slices and column building."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SLICE_BYTES = 8 << 20

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    Spark's file server sends the archive, so it may lie on the driver's disk.
    """
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="lendlake-")) / "lendlake.zip"
        with zipfile.ZipFile(target, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(target))
        _SHIPPED.add(app)


def map_batches(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow`` with this package at hand on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about ``limit`` bytes of ``column``.

    A row is never cut; a longer value is a slice of its own.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = batch.column(column)
        wide = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
        if pa.types.is_list(values.type):
            ends = values.offsets.to_numpy() * 4
        else:
            raw = np.frombuffer(values.buffers()[1], np.int64 if wide else np.int32)
            ends = raw[values.offset : values.offset + len(values) + 1]
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, int(ends[start]) + limit, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(values: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in values.cast(pa.binary()).to_pylist()]


def list_array(packed: list[bytes], kind: pa.DataType) -> pa.Array:
    """A list column from packed values."""
    width = kind.bit_width // 8
    ends = np.zeros(len(packed) + 1, np.int32)
    np.cumsum([len(x) // width for x in packed], out=ends[1:])
    values = pa.Array.from_buffers(kind, int(ends[-1]), [None, pa.py_buffer(b"".join(packed))])
    return pa.ListArray.from_arrays(pa.array(ends), values)


def replaced_schema(df: DataFrame, drop: list[str], *fields: T.StructField) -> T.StructType:
    gone = {x.lower() for x in drop}
    return T.StructType([f for f in df.schema.fields if f.name.lower() not in gone] + list(fields))


def with_column(batch: pa.RecordBatch, drop: list[str], name: str, values: pa.Array) -> pa.RecordBatch:
    return with_columns(batch, drop, {name: values})


def with_columns(batch: pa.RecordBatch, drop: list[str], more: dict[str, pa.Array]) -> pa.RecordBatch:
    gone = {x.lower() for x in drop}
    kept = [n for n in batch.schema.names if n.lower() not in gone]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + list(more.values()), names=kept + list(more))
