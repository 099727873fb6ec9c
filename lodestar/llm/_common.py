"""Helpers shared by the training-data operators.

Words are maximal runs of bytes other than space and ``\\t \\n \\v \\f \\r``. In
SQL that is ``WORD``; in Python tasks it is ``bytes.split()``, which splits on
exactly those six bytes. ``bytes.lower()`` changes A-Z only.
"""

from __future__ import annotations

import contextlib
import ctypes
import sys
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.sources.files import ensure_checkpoint_dir, materialize

_LIBC = ctypes.CDLL(None) if sys.platform == "linux" else None


def return_large_blocks(least: int = 1 << 20) -> None:
    """Let this process give freed blocks of at least ``least`` bytes back to the system at once.

    By default glibc raises its limit to 32 MB after the first large free and
    keeps smaller blocks, and Arrow's own allocator keeps what it had, so Python
    workers, which live on between tasks, would hold the largest arrays they
    ever had. The first has no effect elsewhere.
    """
    if hasattr(_LIBC, "mallopt"):
        _LIBC.mallopt(-3, least)  # M_MMAP_THRESHOLD
    pa.set_memory_pool(pa.system_memory_pool())


def return_freed() -> None:
    """Give back what this process has freed in small blocks; for the end of a task."""
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


return_large_blocks()

#: Bytes of an Arrow batch between Spark and Python in the stages of the operators.
BATCH_BYTES = "4m"

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    """The words of a text as an array; empty for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
                      F.array().cast("array<string>"))


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder for one run under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/lodestar-llm/{label}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def _set(spark: SparkSession, **values: str):
    """Runtime settings for the executions in this block (underscores stand for dots)."""
    keys = {k.replace("_", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def few_files(df: DataFrame) -> DataFrame:
    """``df`` in at most four partitions a core, merged without a shuffle, so that writing it makes few files.

    A task that writes a file costs more than its rows where a partition is small (on file systems without
    native permissions every file starts a process beside the executor); where partitions are
    large there are far more than four a core only by choice, and merging them keeps all cores busy.
    """
    return df.coalesce(4 * max(1, df.sparkSession.sparkContext.defaultParallelism))


def stage(spark: SparkSession, df: DataFrame, root: str, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors.

    Spark deletes the shuffle files when the stage is written, since nobody reads them again (by
    default they stay until the driver happens to collect its garbage). Rows go to Python
    in batches of a few megabytes.
    """
    with _set(spark, spark_sql_classic_shuffleDependency_fileCleanup_enabled="true",
              spark_sql_execution_arrow_maxBytesPerBatch=BATCH_BYTES):
        return materialize(spark, few_files(df), f"{root}/{name}")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` (a written stage of narrow rows) with a broadcast hint if it has at most ``max_rows`` rows.

    Beyond the bound the hint is left out, and the join is a shuffle join
    whose hot keys adaptive execution splits.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def hash_sample(rows: DataFrame, n: int) -> DataFrame:
    """At most ``n`` rows of ``rows``, whose first column is an id, chosen by a hash of it.

    A hash range that holds about 1.5 n rows is cut out first, so the final
    ordering handles a bounded number of rows however many partitions there are.
    """
    key = F.xxhash64(rows.columns[0])
    total = rows.count()
    if total > 2 * n:
        parts = 1 << 24
        rows = rows.where(F.pmod(key, F.lit(parts)) < int(1.5 * n / total * parts) + 64)
    return rows.orderBy(key, rows.columns[0]).limit(n)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has in any letter case."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name
