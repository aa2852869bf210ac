"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtrace.functions.lineage import shared_folder

#: Words and line ends are delimited by these six ASCII characters only.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Stands for a null doc_id wherever ids are compared or joined: smaller than every real id.
NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text with null read as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def id_of(df: DataFrame, column: str = "doc_id") -> Column:
    return F.coalesce(df[column].cast("long"), F.lit(NO_ID))


def shown_id(column: str) -> Column:
    """The inverse of id_of."""
    return F.when(F.col(column) != NO_ID, F.col(column))


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """``docs`` with columns c0, c1 ... so that no name clashes with an operator's own; the new name
    of each old one, of equal ones the first's; and what selects the columns by their old names."""
    new = [f"c{i}" for i in range(len(docs.columns))]
    of: dict[str, str] = {}
    for old, c in zip(docs.columns, new, strict=True):
        of.setdefault(old, c)
    return docs.toDF(*new), of, [F.col(c).alias(old) for old, c in zip(docs.columns, new, strict=True)]


#: Checkpoint folders made within ``scratch``, if one is open.
_MADE: list[list[str]] = []


def cut(df: DataFrame) -> DataFrame:
    """The rows, kept in the shared checkpoint folder, so that what follows neither
    recomputes them nor depends on an executor's own disk.

    The folder is the session's ``spark.checkpoint.dir``; see ``shared_folder``.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    done = df.checkpoint(eager=True)
    del df
    if _MADE:
        folder = done._jdf.queryExecution().logical().rdd().getCheckpointFile()
        _MADE[-1].extend([folder.get()] if folder.isDefined() else [])
    freed()
    return done


def freed() -> None:
    """Spark removes shuffle files and checkpoints of frames that nothing refers to only when the driver collects its garbage."""
    gc.collect()
    SparkContext._active_spark_context._jvm.System.gc()


@contextmanager
def scratch() -> Iterator[list[str]]:
    """The folders of checkpoints made within, for ``forget`` once what needs them is written."""
    _MADE.append([])
    try:
        yield _MADE[-1]
    finally:
        _MADE.pop()


def forget(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, for mapInArrow, followed by ``trim``."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        trim()

    return whole


def trim() -> None:
    """Gives memory that is no longer used back to the system. A worker goes on to other tasks, and idle
    ones stay for a minute beside those of the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # GNU's C library only
        ctypes.CDLL(None).malloc_trim(0)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches of few rows: documents differ in length by four orders of
    magnitude, so a batch is bounded in rows and, where Spark can, in bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hashed(*columns: Column, seed: int = 0) -> Column:
    """64 bits of a row's columns; nulls count as values. Another seed gives independent bits."""
    return F.xxhash64(F.lit(seed), *columns)
