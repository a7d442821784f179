"""Slowly changing dimension (type 2) for vendors, as snapshot functions.

``scd2_apply(dim, vendors, profiles, as_of)`` returns the next snapshot of
the dimension; nothing is updated in place. Publishing the snapshot (staged
write, then pointer swap) is ``sources.io.publish``.

Semantics kept from the source system:

* change detection is an OR of ``!=`` comparisons, which is not null-safe: a
  change from NULL to a value (or back) is not a change. ``null_safe=True``
  uses ``<=>`` instead;
* the close step only closes current rows that started *before* ``as_of``,
  so two changes on the same day leave two current rows;
* new versions carry no ESG score (the insert does not set it).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..params import as_date
from ..plans.prefix import assign_keys
from ..session import ensure_checkpoint_dir
from .dims import VENDOR_DIM_COLS, new_dim_vendors

# Vendor attributes compared for a type-2 change.
TRACKED = ["vendor_name", "vendor_tier", "diversity_classification", "risk_rating", "country", "region"]


def _differs(a: Column, b: Column, null_safe: bool) -> Column:
    return ~a.eqNullSafe(b) if null_safe else (a != b)


def scd2_changes(vendors: DataFrame, profiles: DataFrame, dim: DataFrame, as_of,
                 null_safe: bool = False) -> DataFrame:
    """New versions for vendors whose current dimension row differs in a
    tracked attribute (no is_active filter here)."""
    src = (vendors.join(profiles.select("vendor_id", "risk_rating"), "vendor_id", "left")
                  .select("vendor_id", *[F.col(c).alias("s_" + c) for c in TRACKED if c != "risk_rating"],
                          F.coalesce(F.col("risk_rating"), F.lit("Medium")).alias("s_risk_rating")))
    cur = dim.filter(F.col("is_current_record")).select("vendor_id", *[F.col(c).alias("d_" + c) for c in TRACKED])
    j = src.join(cur, "vendor_id")
    changed = None
    for c in TRACKED:
        d = _differs(F.col("s_" + c), F.col("d_" + c), null_safe)
        changed = d if changed is None else (changed | d)
    return j.filter(changed).select(
        "vendor_id", *[F.col("s_" + c).alias(c) for c in TRACKED],
        D.lit_date(as_of).alias("effective_start_date"), F.lit(True).alias("is_current_record")
    ).select(*VENDOR_DIM_COLS)


def scd2_close(dim: DataFrame, as_of, run_ts=None) -> DataFrame:
    """Close the older current rows of every vendor that has a current
    row starting on ``as_of``: ``is_current_record = false``,
    ``effective_end_date = as_of - 1``; when the dimension carries
    ``updated_date``, closed rows get ``run_ts`` (the update trigger).

    The set of vendors changed today is joined as a flag (semi-join shape);
    Spark broadcasts it when it is measured small.
    """
    day = as_date(as_of)
    today = D.lit_date(day)
    changed = (dim.filter((F.col("effective_start_date") == today) & F.col("is_current_record"))
                  .select("vendor_id").distinct().withColumn("_changed", F.lit(True)))
    j = dim.join(changed, "vendor_id", "left")
    closing = F.col("_changed").isNotNull() & F.col("is_current_record") & (F.col("effective_start_date") < today)
    out = (j.withColumn("effective_end_date",
                        F.when(closing, F.lit(day - _dt.timedelta(days=1))).otherwise(F.col("effective_end_date")))
            .withColumn("is_current_record", F.when(closing, F.lit(False)).otherwise(F.col("is_current_record"))))
    if "updated_date" in dim.columns and run_ts is not None:
        out = out.withColumn("updated_date", F.when(closing, F.lit(run_ts).cast("timestamp"))
                             .otherwise(F.col("updated_date")))
    return out.select(*dim.columns)


def _as_dim_rows(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Shape inserted rows like ``dim`` (missing columns as typed NULLs)."""
    types = dict((f.name, f.dataType) for f in dim.schema.fields)
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(types[c]).alias(c) for c in dim.columns])


def scd2_apply(dim: DataFrame, vendors: DataFrame, profiles: DataFrame, as_of, null_safe: bool = False,
               materialize: bool = False) -> DataFrame:
    """Next snapshot = dim + new vendors (D1) + changed vendors (D4),
    surrogate keys continuing after the current maximum in (new vendors
    first, then changes; each by vendor_id) order, then the close step (D5).

    The snapshot's plan references ``dim`` several times, so applying many
    days in a row without storing the snapshots (a backfill loop) grows the
    plan exponentially. ``materialize=True`` cuts the lineage: the snapshot is
    checkpointed to the shared checkpoint folder (``spark.checkpoint.dir``).
    A daily job that reads the last published snapshot does not need it."""
    new = new_dim_vendors(vendors, profiles, dim, as_of).withColumn("_batch", F.lit(1))
    chg = scd2_changes(vendors, profiles, dim, as_of, null_safe).withColumn("_batch", F.lit(2))
    keyed = assign_keys(new.unionByName(chg), dim, "vendor_key", ["_batch", "vendor_id"]).drop("_batch")
    out = scd2_close(dim.unionByName(_as_dim_rows(keyed, dim)), as_of)
    if materialize:
        ensure_checkpoint_dir(out.sparkSession)
        out = out.checkpoint(eager=True)
    return out


def scd2_closed_rows(dim: DataFrame, vendors: DataFrame, profiles: DataFrame, as_of, null_safe: bool = False) -> DataFrame:
    """The versions closed by today's run, from the vendors that get a new
    version (D4) or have one of today; the next snapshot and its surrogate keys
    are not built for it (new vendors have nothing to close)."""
    day = as_date(as_of)
    today, before = D.lit_date(day), F.lit(day - _dt.timedelta(days=1))
    cols = ["vendor_key", "vendor_id", "effective_start_date", "effective_end_date", "is_current_record"]
    changed = scd2_changes(vendors, profiles, dim, as_of, null_safe).select("vendor_id").unionByName(
        dim.filter((F.col("effective_start_date") == today) & F.col("is_current_record")).select("vendor_id"))
    closing = (dim.filter(F.col("is_current_record") & (F.col("effective_start_date") < today))
                  .join(changed, "vendor_id", "left_semi")
                  .withColumns({"effective_end_date": before, "is_current_record": F.lit(False)}).select(*cols))
    closed = dim.filter((F.col("effective_end_date") == before) & ~F.col("is_current_record")).select(*cols)
    return closing.unionByName(closed)
