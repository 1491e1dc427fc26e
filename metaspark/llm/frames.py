"""Small helpers on frames."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def extended(df: DataFrame, ddl: str) -> StructType:
    """The schema of ``df`` with the columns of ``ddl`` after its own."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``work`` for ``mapInArrow`` that gives its memory back at the end of a task: a Python
    worker serves the tasks of later stages too, beside which its free pages would count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass

    return run


BATCH_ROWS, BATCH_BYTES = 250, 2 << 20
_LIMITS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS,
    "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES,
}


def small_batches(spark: SparkSession) -> None:
    """Python tasks of the session get texts in batches of some megabytes: both sides of a
    task hold a batch and its result, and their buffers double as they grow.  Smaller limits stay."""
    for name, most in _LIMITS.items():
        now = int(re.match(r"-?\d+", spark.conf.get(name))[0])
        if now <= 0 or now > most:
            spark.conf.set(name, str(most))
