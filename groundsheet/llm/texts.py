"""Arrow helpers for whole texts inside tasks: bounded slices and word codes."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Text bytes worked on at a time in one task; a single longer text is a slice of its own.
SLICE_BYTES = 2 << 20
#: Bytes that Spark hands to a Python worker at a time.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Let the session hand texts to workers in batches of bounded bytes, not of 10,000 rows."""
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def give_back() -> None:
    """Return freed memory to the system, so that idle workers hold little."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds at most ``limit`` bytes in each and no more than ``rows`` rows, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            stop = min(stop, start + rows) if rows else stop
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def filled(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    return pc.fill_null(batch.column(column), "")


def split_parts(parts: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.StringArray]:
    """Row number and code of every list element, in order, with the distinct values by code."""
    counts = pc.fill_null(pc.list_value_length(parts), 0).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(parts)), counts)
    coded = parts.flatten().dictionary_encode()
    return rows, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.StringArray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of non-null texts: row numbers, codes, distinct words."""
    rows, codes, words = split_parts(pc.ascii_split_whitespace(texts))
    empty = pc.index(words, "").as_py()
    if empty >= 0:  # what stands before a leading and after a trailing space
        keep = codes != empty
        rows, codes = rows[keep], codes[keep]
    return rows, codes, words
