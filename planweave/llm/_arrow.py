"""How tasks of this package take Arrow data: in small batches, giving memory back when they end."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of an Arrow batch; a longer text still comes whole, as a batch of its own.
BATCH_BYTES = 4 << 20


def _give_back() -> None:
    """Hand freed memory to the system: workers are kept for later tasks and share an executor with the JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def _small_batches() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def batches(function: Callable, schema) -> tuple[Callable, object]:
    """Arguments of mapInArrow."""
    _small_batches()

    def run(parts):
        try:
            yield from function(parts)
        finally:
            _give_back()

    return run, schema


def groups(function: Callable, schema) -> tuple[Callable, object]:
    """Arguments of applyInArrow."""
    _small_batches()

    def run(table):
        try:
            return function(table)
        finally:
            _give_back()

    return run, schema
