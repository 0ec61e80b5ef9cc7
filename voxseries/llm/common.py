"""Shared helpers: staged tables, Arrow slices and vectorised hashes."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxseries.sources.tables import shared_dir

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


class Stages:
    """Tables written to the shared folder. They cut lineage, and survive the loss of the executor that wrote them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._count = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self._count += 1
        path = f"{self.root}/{self._count:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._stage_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Give the space of tables back once every table made from them is written.

        Shuffle files of finished jobs go too: Spark's cleaner removes them when a collection finds the jobs unreferenced.
        """
        for df in tables:
            self._delete(df._stage_path)
        self.spark._jvm.System.gc()

    def clear(self) -> None:
        """Drop all tables."""
        self._delete(self.root)
        self.spark._jvm.System.gc()

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def text_digest(text: Column) -> Column:
    """SHA-256 of a text as it is, 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def tidy(run: Callable) -> Callable:
    """A task over Arrow batches that gives its memory back at the end: idle Python workers then hold little of it."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return wrapped


def text_slices(batch: pa.RecordBatch, column: str, size: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `size` bytes in one string column (at least one row each).

    What a task makes of texts is many times their size, so small slices bound its memory.
    """
    lengths = batch.column(column).cast(pa.large_string()).buffers()
    if batch.num_rows == 0:
        return
    offsets = np.frombuffer(lengths[1], np.int64)[batch.column(column).offset:][: batch.num_rows + 1]
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty. The bytes are a view where Arrow allows it."""
    column = column.fill_null("") if column.null_count else column
    if column.offset:
        column = pa.concat_arrays([column])
    column = column.cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:][: len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """An ordered hash of two 64-bit values."""
    return mix(a * _GOLD + mix(b + _GOLD))


def string_array(texts: list[str]) -> pa.Array:
    return pa.array(texts, pa.string())


def replaced(batch: pa.RecordBatch, schema: pa.Schema, values: dict[str, pa.Array]) -> pa.RecordBatch:
    """A batch with the fields of `schema`: given values, else the batch's own columns."""
    names = batch.schema.names
    columns = [values[f.name] if f.name in values else batch.column(names.index(f.name)).cast(f.type) for f in schema]
    return pa.RecordBatch.from_arrays(columns, schema=schema)
