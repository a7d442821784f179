"""Ordered index and running sum without a single-task window.

``Window.orderBy(...)`` with no (or a coarse) partition key moves a whole group
into one task. Here the rows are range-partitioned on (group, order) instead,
so each task holds one contiguous slice of the total order. Each slice computes
its local row number / running sum with a window keyed by the slice id, the
per-slice totals (one row per slice and group, so at most
``num_partitions x groups`` rows) give each slice its offset, and one join adds
the offset back. The work per task is bounded by the slice size, whatever the
size of the largest group.

The slices feed two branches (local positions, per-slice totals). Range bounds
are sampled per exchange, so two exchanges over the same rows may cut them
differently; the slices are therefore stored once in the shared checkpoint
folder (``spark.checkpoint.dir``) and both branches read that copy. A task
recomputed after an executor loss reads the stored slices too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ordered_running(df: DataFrame, order: Sequence, group: Sequence[str] = (), value: str | None = None,
                    index_col: str = "row_index", sum_col: str = "running_sum",
                    num_partitions: int | None = None) -> DataFrame:
    """Add ``index_col`` (1-based position in ``order`` within ``group``) and,
    when ``value`` is given, ``sum_col`` (inclusive running sum of ``value``).

    ``order`` must be a total order within each group (end it with a unique
    key) for the result to be deterministic.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = list(group)
    order_cols = [_col(c) for c in order]
    keys = [F.col(g) for g in group] + order_cols
    ensure_checkpoint_dir(spark)
    sliced = df.repartitionByRange(n, *keys).withColumn("_slice", F.spark_partition_id()).checkpoint(eager=True)

    w_local = Window.partitionBy("_slice", *group).orderBy(*order_cols)
    local = sliced.withColumn("_lidx", F.row_number().over(w_local))
    aggs = [F.count(F.lit(1)).alias("_scnt")]
    if value is not None:
        local = local.withColumn(
            "_lsum", F.sum(_col(value)).over(w_local.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        aggs.append(F.sum(_col(value)).alias("_ssum"))

    totals = sliced.groupBy("_slice", *group).agg(*aggs)
    # ``totals`` has at most num_partitions rows per group.
    w_prev = (Window.partitionBy(*group).orderBy("_slice") if group else Window.orderBy("_slice"))
    w_prev = w_prev.rowsBetween(Window.unboundedPreceding, -1)
    offs = [F.coalesce(F.sum("_scnt").over(w_prev), F.lit(0)).alias("_ocnt")]
    if value is not None:
        offs.append(F.sum("_ssum").over(w_prev).alias("_osum"))
    offsets = totals.select("_slice", *group, *offs)

    out = local.join(offsets, ["_slice", *group], "inner")
    out = out.withColumn(index_col, (F.col("_ocnt") + F.col("_lidx")).cast("long"))
    if value is not None:
        out = out.withColumn(sum_col, F.coalesce(F.col("_osum") + F.col("_lsum"), F.col("_lsum")))
    drop = ["_slice", "_lidx", "_ocnt", "_osum", "_lsum"]
    return out.drop(*[c for c in drop if c in out.columns])


def assign_keys(new: DataFrame, existing: DataFrame | None, key: str, order: Sequence,
                num_partitions: int | None = None) -> DataFrame:
    """Surrogate keys ``max(existing.key) + 1, + 2, ...`` in ``order``
    (auto-increment semantics), computed without a global window. The
    current maximum is a scalar subquery (evaluated once)."""
    if existing is not None:
        base = existing.agg(F.coalesce(F.max(key), F.lit(0)).cast("long")).scalar()
    else:
        base = F.lit(0).cast("long")
    ranked = ordered_running(new, order, index_col="_pos", num_partitions=num_partitions)
    out = ranked.withColumn(key, base + F.col("_pos"))
    return out.select(key, *[c for c in new.columns if c != key])
