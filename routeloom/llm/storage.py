"""Stored intermediate tables and rows that keep their other columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeloom.workspace import new_path

#: Texts are handled in blocks of so many bytes (or one document), which bounds a task's memory.
BLOCK_BYTES = 1 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replaced(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """All columns of ``df`` and the new ones; a column of the same name (in any case) gives way."""
    taken = {name.lower() for name in new}
    kept = [df[f"`{c}`"] for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[column.alias(name) for name, column in new.items()])


def without(schema: T.StructType, names: list[str]) -> list[T.StructField]:
    """The fields of ``schema`` that keep their place beside new columns ``names``."""
    taken = {name.lower() for name in names}
    return [f for f in schema.fields if f.name.lower() not in taken]


def texts_of(batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column as one array, and the offsets of its rows (null: empty)."""
    column = pc.fill_null(batch.column(text).cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    return raw, bounds - bounds[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes of text, or one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi


def fingerprint_columns(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """The two columns every operator needs, under names of its own."""
    return [F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")]
