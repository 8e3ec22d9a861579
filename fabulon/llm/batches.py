"""Size of the Arrow batches that carry texts."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches of this session have ROWS rows at most: a batch of long texts is held several times over by
    the JVM and by Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > ROWS:
        spark.conf.set(key, str(ROWS))


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, after which a Python worker gives the memory that it no longer needs back to the system: workers are kept for later tasks."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries lack it
            ctypes.CDLL(None).malloc_trim(0)

    return wrapped
