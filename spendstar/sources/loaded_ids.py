"""Index of loaded transactions: their ids only, bucketed by hash, beside the facts.

Whether a transaction is loaded depends on every fact ever loaded, whatever its
day. Reading that from the facts makes each daily load and each micro-batch scan
the fact table. The index holds one short row per loaded transaction instead:

* ``find_loaded`` asks it with the new ids: a semi join, in which Spark
  broadcasts the new ids while they are measured small, so the index is read
  where it lies; for a large batch the index side needs no shuffle either,
  since it is bucketed by the id (only the batch moves);
* every row names the load that wrote it, and rows count only for the loads
  that the caller knows as committed. So a load writes its ids first, its facts
  next, and becomes visible by committing the facts: a stop in between leaves
  ids that nobody counts, and a rerun of the same load ignores its own ids and
  may write them again (repeated ids do no harm).

The bucketed files are an external table of Spark's session catalog, declared
again in every session from the folder's fixed layout.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ID = "source_transaction_id"
BUCKETS = 64


def _declared(spark: SparkSession, path: str, buckets: int) -> str:
    name = f"loaded_ids_{zlib.crc32(f'{path}|{buckets}'.encode()):08x}"
    if not spark.catalog.tableExists(name):
        spark.sql(f"create table {name} ({ID} string, load_run string) using parquet "
                  f"clustered by ({ID}) into {int(buckets)} buckets location '{path}'")
    return name


def add_ids(spark: SparkSession, path: str, ids: DataFrame, load_run: str, buckets: int = BUCKETS) -> None:
    """Append the ids of one load (a column ``source_transaction_id``; NULLs are left out)."""
    name = _declared(spark, path, buckets)
    rows = ids.filter(F.col(ID).isNotNull()).select(F.col(ID).cast("string"), F.lit(load_run).alias("load_run"))
    rows.repartition(buckets, ID).write.insertInto(name)
    spark.catalog.refreshTable(name)


def loaded_ids(spark: SparkSession, path: str, committed: Iterable[str] | None = None, without: str | None = None,
               buckets: int = BUCKETS) -> DataFrame:
    """The index: ids of the ``committed`` loads (None: of all), without those of the load ``without``."""
    rows = spark.table(_declared(spark, path, buckets))
    if without is not None:
        rows = rows.filter(F.col("load_run") != without)
    if committed is not None:
        rows = rows.filter(F.col("load_run").isin(sorted(set(committed))))
    return rows.select(ID)


def find_loaded(index: DataFrame, new: DataFrame) -> DataFrame:
    """The distinct ids of ``new`` that the index holds."""
    return index.join(new.select(ID).filter(F.col(ID).isNotNull()), ID, "left_semi").distinct()
