"""What the operators share: the engine's tables in the cluster's shared folder, and small column helpers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import Scratch, discard, materialize, release, shared_dir  # noqa: F401

#: Characters that separate words and are stripped from lines: space, tab, LF, VT, FF, CR.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Rows of an Arrow batch, see small_batches().
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def quoted(name: str) -> str:
    """A column's name as part of an expression, whatever is in it."""
    return "`" + name.replace("`", "``") + "`"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Texts are long, so Python workers get BATCH_ROWS of them at a time, not Spark's 10,000: with documents of some
    kilobytes that keeps a batch to megabytes on both sides. A session's own number stays."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def trimmed(work: Callable) -> Callable:
    """A function for mapInArrow that gives the memory it has freed back to the system when its task ends, as workers live
    on beside those of later stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:  # glibc
                trim(0)

    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
