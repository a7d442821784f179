"""Small helpers shared by the text operators."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import time
import uuid
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: The white space of the contracts: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows in an Arrow batch of texts.
TEXT_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Make the session ready for operators with Python tasks.

    The package is sent to the workers, once per application (what
    ``--py-files`` does), so that functions used in tasks can be imported there
    however the driver found the package. Spark's default of 10,000 rows to an
    Arrow batch is meant for short rows: for texts it is lowered to
    ``TEXT_ROWS``; another value set by the user stays."""
    sc = spark.sparkContext
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(TEXT_ROWS))
    if getattr(sc, "_spendstar_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.join(tempfile.mkdtemp(prefix="spendstar-py-"), "spendstar")
    sc.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package)))
    sc._spendstar_shipped = True


@lru_cache(1)
def _memory():
    """The C library of a worker, set to give large blocks back at once; None elsewhere."""
    import ctypes
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, 16 << 20)      # M_MMAP_THRESHOLD
        libc.mallopt(-1, 16 << 20)      # M_TRIM_THRESHOLD
        libc.mallopt(-8, 2)             # M_ARENA_MAX
        return libc
    except (OSError, AttributeError):
        return None


def discard(spark: SparkSession, path: str) -> None:
    """Remove an intermediate folder of an operator, once everything read from it is stored."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps whose results are stored.

    Its context cleaner does so once their plans are collected on the driver,
    by itself every half hour; an operator that shuffles whole texts
    afterwards asks for it first."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_trimmed = [0.0]


def _give_back(every: float = 0.0) -> None:
    libc = _memory()
    if libc is not None and time.monotonic() - _trimmed[0] >= every:
        libc.malloc_trim(0)
        _trimmed[0] = time.monotonic()


def lean(run):
    """``run`` for mapInArrow in a worker that Spark keeps for later tasks: its
    arrays come from the C library, and what a task has freed goes back to the
    system instead of staying beside the JVM."""
    def task(batches):
        pa.set_memory_pool(pa.system_memory_pool())
        _memory()
        yield from run(batches)
        _give_back()

    return task


def lean_group(run):
    """The same for the (key, table) functions of applyInArrow, once a second at most."""
    def group(key, table):
        pa.set_memory_pool(pa.system_memory_pool())
        _memory()
        out = run(key, table)
        del table
        _give_back(1.0)
        return out

    return group


def cut(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and stored in ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, _UPPER, _UPPER.lower()))


def md5_number(c: Column) -> Column:
    """The first 32 bits of the MD5 of a string column, as a long."""
    return F.conv(F.substring(F.md5(c.cast("binary")), 1, 8), 16, 10).cast("long")


def word_count(c: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
