"""Dimension builders: new vendors and commodities, calendar, contract and
business-unit dimensions, point-in-time lookup.

Dimension inputs are the operational master tables. They are small next to
the facts but not bounded, so no join here forces a broadcast: Spark chooses
broadcast or sort-merge from the (measured, with AQE) size. The calendar is
the exception: its size is fixed by the date range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..params import CALENDAR_END, CALENDAR_START, as_date
from ..plans.prefix import assign_keys
from ..session import ensure_checkpoint_dir

VENDOR_DIM_COLS = ["vendor_id", "vendor_name", "vendor_tier", "diversity_classification", "risk_rating",
                   "country", "region", "effective_start_date", "is_current_record"]


def _current_ids(dim: DataFrame, id_col: str) -> DataFrame:
    return dim.filter(F.col("is_current_record") & F.col(id_col).isNotNull()).select(id_col)


def new_dim_vendors(vendors: DataFrame, profiles: DataFrame, dim: DataFrame, as_of) -> DataFrame:
    """Active vendors with no current dimension row.

    Risk comes from the supplier profile, 'Medium' when there is none.
    ``NOT IN`` over the NOT NULL ``vendor_id`` is a plain anti join (a NULL
    source id can never qualify, so it is filtered first).
    """
    v = vendors.filter(F.col("is_active") & F.col("vendor_id").isNotNull())
    p = profiles.select("vendor_id", "risk_rating")
    rows = (v.join(p, "vendor_id", "left")
             .select("vendor_id", "vendor_name", "vendor_tier", "diversity_classification",
                     F.coalesce(F.col("risk_rating"), F.lit("Medium")).alias("risk_rating"),
                     "country", "region",
                     D.lit_date(as_of).alias("effective_start_date"),
                     F.lit(True).alias("is_current_record"))
             .distinct())
    return rows.join(_current_ids(dim, "vendor_id"), "vendor_id", "left_anti").select(*VENDOR_DIM_COLS)


def new_dim_vendors_simple(vendors: DataFrame, dim: DataFrame, as_of) -> DataFrame:
    """Every vendor (active or not) with no dimension row of any version;
    risk is the constant 'Medium' and region is not carried."""
    known = dim.filter(F.col("vendor_id").isNotNull()).select("vendor_id")
    return (vendors.filter(F.col("vendor_id").isNotNull())
            .join(known, "vendor_id", "left_anti")
            .select("vendor_id", "vendor_name", "vendor_tier", "diversity_classification",
                    F.lit("Medium").alias("risk_rating"), "country",
                    D.lit_date(as_of).alias("effective_start_date"),
                    F.lit(True).alias("is_current_record")))


def new_dim_commodities(commodities: DataFrame, profiles: DataFrame, dim: DataFrame, as_of) -> DataFrame:
    """Active commodities with no current dimension row; criticality
    defaults to 'Medium', complexity to 'Moderate'."""
    c = commodities.filter(F.col("is_active") & F.col("commodity_id").isNotNull())
    p = profiles.select("commodity_id", "business_criticality", "sourcing_complexity", "category_manager")
    rows = (c.join(p, "commodity_id", "left")
             .select("commodity_id", "commodity_description", "parent_category", "sub_category",
                     F.coalesce(F.col("business_criticality"), F.lit("Medium")).alias("business_criticality"),
                     F.coalesce(F.col("sourcing_complexity"), F.lit("Moderate")).alias("sourcing_complexity"),
                     "category_manager",
                     D.lit_date(as_of).alias("effective_start_date"),
                     F.lit(True).alias("is_current_record"))
             .distinct())
    return rows.join(_current_ids(dim, "commodity_id"), "commodity_id", "left_anti")


def calendar_days(start=CALENDAR_START, end=CALENDAR_END) -> int:
    return (as_date(end) - as_date(start)).days + 1


def dim_time(spark: SparkSession, start=CALENDAR_START, end=CALENDAR_END,
             existing: DataFrame | None = None) -> DataFrame:
    """D3: one row per day with calendar and April-March fiscal attributes.

    Generated with ``sequence`` + ``explode`` (the source used a recursive
    CTE). Its size is ``calendar_days(start, end)`` rows, known before any
    data is read, which is what makes broadcasting it safe. Keys already in
    ``existing`` are skipped.
    """
    start, end = as_date(start), as_date(end)
    n_parts = max(1, calendar_days(start, end) // 4096)
    days = (spark.range(1)
            .select(F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("date_actual"))
            .repartition(n_parts))
    return calendar_rows(days, existing)


def calendar_of(spend: DataFrame, existing: DataFrame | None = None, start=CALENDAR_START,
                end=CALENDAR_END) -> DataFrame:
    """D3 for given transactions: every day from the first transaction date to
    the last (the fiscal calendar has no gaps) within the calendar's range,
    without the days that ``existing`` already has."""
    inside = spend.filter(F.col("transaction_date").between(D.lit_date(start), D.lit_date(end)))
    span = inside.agg(F.min("transaction_date").alias("a"), F.max("transaction_date").alias("b")).filter("a is not null")
    return calendar_rows(span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("date_actual")), existing)


def calendar_rows(days: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Calendar attributes of the days in ``date_actual``; keys in ``existing`` are skipped."""
    d = F.col("date_actual")
    out = days.select(
        D.time_key(d).alias("time_key"),
        d.alias("date_actual"),
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        F.month(d).cast("int").alias("month"),
        D.fiscal_year(d).alias("fiscal_year"),
        D.fiscal_quarter(d).alias("fiscal_quarter"),
        D.fiscal_month(d).alias("fiscal_month"),
        D.month_name(d).alias("month_name"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        D.day_name(d).alias("day_of_week"),
        F.dayofweek(d).cast("int").alias("day_of_week_num"),
        D.week_of_year_monday(d).alias("week_of_year"),
        D.is_weekend(d).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.lit(None).cast("string").alias("holiday_name"),
    )
    if existing is not None:
        out = out.join(existing.select("time_key"), "time_key", "left_anti")
    return out


def calendar(dt: DataFrame, *cols: str) -> DataFrame:
    """The calendar restricted to ``cols``, marked for broadcast: its row
    count is fixed by the calendar range (8,035 days by default)."""
    return F.broadcast(dt.select(*cols))


def dim_as_of(dim: DataFrame, d) -> DataFrame:
    """The version of each dimension member valid on day ``d``."""
    day = D.lit_date(d)
    return dim.filter((F.col("effective_start_date") <= day)
                      & (F.col("effective_end_date").isNull() | (F.col("effective_end_date") >= day)))


def dim_contracts(contracts: DataFrame, risk: DataFrame, as_of, existing: DataFrame | None = None) -> DataFrame:
    """Contract dimension. ``risk_level`` is the level of the vendor's
    latest open assessment on or before ``as_of`` (ties by assessment id);
    'Critical' maps to 'High' since the dimension allows Low/Medium/High only.
    A contract without a currency has the DDL's default, 'USD'.

    The latest assessment is a ``max_by`` aggregate, so a vendor with very
    many assessments is combined map-side rather than sorted in one task.
    """
    day = D.lit_date(as_of)
    latest = (risk.filter((F.col("status") == "Open") & (F.col("assessment_date") <= day))
                  .groupBy("vendor_id")
                  .agg(F.max_by("risk_level", F.struct("assessment_date", "assessment_id")).alias("risk_level")))
    rows = (contracts.join(latest, "vendor_id", "left")
            .select("contract_id", "contract_name", "contract_type", "contract_status", "start_date", "end_date",
                    F.coalesce(F.col("auto_renewal"), F.lit(False)).alias("auto_renewal"),
                    "payment_terms",
                    (F.coalesce("currency_code", F.lit("USD")) if "currency_code" in contracts.columns
                     else F.lit(None).cast("string")).alias("currency_code"),
                    F.when(F.col("risk_level") == "Critical", "High").otherwise(F.col("risk_level")).alias("risk_level"),
                    day.alias("effective_start_date"),
                    F.lit(True).alias("is_current_record")))
    return assign_keys(rows, existing, "contract_key", ["contract_id"])


def unit_levels(bu: DataFrame) -> DataFrame:
    """(business_unit_id, level_in_hierarchy) of every unit that a root
    reaches; roots are 1. Each round doubles how far a unit has looked up its
    chain of parents, so the rounds follow the logarithm of the depth and no
    depth is cut off. Units on a parent cycle, or below an unknown parent,
    are not reached from a root and get no row."""
    ensure_checkpoint_dir(bu.sparkSession)
    at = bu.filter(F.col("business_unit_id").isNotNull()).select(
        F.col("business_unit_id").alias("unit"), F.col("parent_unit_id").alias("above"),
        F.when(F.col("parent_unit_id").isNull(), 1).otherwise(0).alias("level"),
        F.lit(1).cast("long").alias("up")).dropDuplicates(["unit"]).checkpoint(eager=True)
    units = at.count()
    reach = 1
    while reach <= 2 * units and not at.filter("level = 0 and above is not null").isEmpty():
        high = at.select(F.col("unit").alias("above"), F.col("above").alias("_above"), F.col("level").alias("_level"),
                         F.col("up").alias("_up"))
        open_ = F.col("level") == 0
        at = (at.join(high, "above", "left").select(
            "unit", F.when(open_, F.col("_above")).otherwise(F.col("above")).alias("above"),
            F.when(open_ & (F.col("_level") > 0), F.col("_level") + F.col("up")).otherwise(F.col("level")).alias("level"),
            F.when(open_, F.col("up") + F.coalesce("_up", F.lit(0))).otherwise(F.col("up")).alias("up"))
            .checkpoint(eager=True))
        reach *= 2
    return at.filter("level > 0").select(F.col("unit").alias("business_unit_id"),
                                         F.col("level").alias("level_in_hierarchy"))


def dim_business_units(bu: DataFrame, as_of, existing: DataFrame | None = None) -> DataFrame:
    """Business units with ``level_in_hierarchy`` (roots are 1, NULL for
    units that no root reaches) and their cost center, place and manager."""
    levels = unit_levels(bu)
    more = [F.col(c) if c in bu.columns else F.lit(None).cast("string").alias(c)
            for c in ("cost_center", "region", "country", "manager_name")]
    rows = (bu.join(levels, "business_unit_id", "left")
              .select("business_unit_id", "business_unit_name", "parent_unit_id",
                      F.col("level_in_hierarchy").cast("int").alias("level_in_hierarchy"), *more,
                      D.lit_date(as_of).alias("effective_start_date"),
                      F.lit(True).alias("is_current_record")))
    return assign_keys(rows, existing, "business_unit_key", ["business_unit_id"])
