"""Shared helpers: inputs, Arrow slices of bounded size, tables cut out of the lineage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..plans.session import written

__all__ = ["mix64", "slices", "table", "written"]

#: Characters of text that one step of an Arrow function holds at a time (a longer text is held alone).
SLICE_CHARS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Consecutive rows of the batches with at most ``limit`` characters, and their texts (null: empty)."""
    for batch in batches:
        column, start, size = batch.column(batch.schema.get_field_index(text)), 0, 0
        texts: list[str] = []
        for i in range(batch.num_rows):
            value = column[i].as_py() or ""
            if texts and size + len(value) > limit:
                yield batch.slice(start, i - start), texts
                start, size, texts = i, 0, []
            texts.append(value)
            size += len(value)
        if texts:
            yield batch.slice(start), texts


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words, so that every output bit depends on every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x
