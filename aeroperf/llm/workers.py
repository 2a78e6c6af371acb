"""What Python workers owe their executor: memory given back when a task ends, and batches of bounded bytes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import SparkSession

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, max_bytes: int = 2 << 20) -> None:
    """Arrow batches of this session hold about ``max_bytes`` from now on, a single longer row being a batch of its own; a smaller bound that is set stays.

    By rows alone (10,000) a batch of whole texts takes tens of MB, several
    times over in the executor, outside its heap, and in the worker.
    """
    jvm = spark.sparkContext._jvm
    bound = int(jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_BYTES)))
    if not 0 < bound <= max_bytes:
        spark.conf.set(BATCH_BYTES, str(max_bytes))


def release() -> None:
    """Return freed memory to the system; a worker stays alive, idle, between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # no glibc
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that releases memory after each batch and at its end."""

    def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            release()

    @wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(one_by_one(batches))
        finally:
            release()

    return tidied
