"""Text columns as flat byte arrays, and tables written once to cut lineage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from sluiceway.session import fresh_dir

#: Work arrays have up to eight bytes for each of these, several at a time; so they stay in a core's cache.
SLICE_BYTES = 128 << 10


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def saved(df: DataFrame, label: str, **options: str) -> DataFrame:
    """The table written to the folder that all executors share, and read back: lost executors redo nothing before it."""
    path = fresh_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each text begins in them (one more than texts); null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    width = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return every[at[0] : at[-1]], at - at[0]


def released() -> None:
    """Gives back what Arrow keeps of freed memory: the worker's next task may be another operator's, that needs other sizes."""
    pa.default_memory_pool().release_unused()


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each, so that work arrays stay small; a longer text is a range by itself."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first, done = 0, 0
    while first < len(ends):
        last = max(first + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield first, last
        done = int(ends[last - 1])
        first = last
