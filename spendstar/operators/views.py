"""Views of the operational and star databases, as DataFrame functions.

``T`` is a mapping of table name to DataFrame (see ``sources``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.agg import real
from ..params import fiscal_year_time_keys
from .dims import calendar


def current_vendors(dim_vendors: DataFrame) -> DataFrame:
    """V1: current versions of the vendor dimension."""
    return dim_vendors.filter(F.col("is_current_record"))


def facts_in_fiscal_year(T: Mapping[str, DataFrame], fy: int, *cal_cols: str) -> DataFrame:
    """Facts of one fiscal year joined to the calendar columns ``cal_cols``.

    The fiscal year is a contiguous ``time_key`` range, so it is also put on
    the fact scan itself: Parquet min/max statistics (or fiscal-year
    partitions) skip other years before the join.
    """
    lo, hi = fiscal_year_time_keys(fy)
    facts = T["fact_spend_analytics"].filter(F.col("time_key").between(lo, hi))
    days = calendar(T["dim_time"].filter(F.col("fiscal_year") == fy), "time_key", *cal_cols)
    return facts.join(days, "time_key")


def facts_with_calendar(T: Mapping[str, DataFrame], *cal_cols: str) -> DataFrame:
    return T["fact_spend_analytics"].join(calendar(T["dim_time"], "time_key", *cal_cols), "time_key")


def vendor_measures(facts: DataFrame, *group: str) -> DataFrame:
    """Additive fact measures per ``vendor_key`` (and ``group``), computed
    before any vendor-dimension join (eager aggregation).

    Reports that group by vendor attributes join these per-vendor rows to the
    dimension instead of joining every fact: the facts are combined map-side
    first, so when the vendor dimension is too large to broadcast only one
    row per vendor (not one per fact) is shuffled, and a vendor holding a
    large share of the facts costs one row per task. Results are unchanged
    because ``vendor_key`` is the dimension's primary key. Unused measures
    are pruned by Catalyst.
    """
    def s(c, scale=2):
        return F.sum(F.col(c).cast(f"decimal(18,{scale})"))
    return facts.groupBy("vendor_key", *group).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count("fact_key").alias("_keys"),
        s("esg_weighted_spend", 4).alias("_esgw"),
        F.sum(real("unit_price")).alias("_price_s"), F.count("unit_price").alias("_price_n"),
        F.countDistinct("commodity_key").alias("_commodities"),
        s("spend_amount").alias("_spend"),
        s("savings_amount", 4).alias("_savings"),
        s("risk_weighted_spend", 3).alias("_rws"),
        F.sum(real("delivery_performance_score")).alias("_deliv_s"), F.count("delivery_performance_score").alias("_deliv_n"),
        F.sum(real("quality_score")).alias("_qual_s"), F.count("quality_score").alias("_qual_n"),
        F.sum(real("compliance_score")).alias("_comp_s"), F.count("compliance_score").alias("_comp_n"))


def mean_of(sum_col: str, n_col: str, rollup: bool = False):
    """Mean from additive (sum, count) measures; ``rollup`` re-sums them."""
    if rollup:
        return F.try_divide(F.sum(sum_col).cast("double"), F.sum(n_col))
    return F.try_divide(F.col(sum_col).cast("double"), F.col(n_col))


def monthly_spend_summary(T: Mapping[str, DataFrame]) -> DataFrame:
    """V2: spend, fact count and mean delivery score by fiscal month, vendor
    tier and parent category; current vendors only (commodities: any
    version, as in the source view). Facts are combined per vendor,
    commodity and month before the two dimension joins."""
    dv = current_vendors(T["dim_vendors"]).select("vendor_key", "vendor_tier")
    dc = T["dim_commodities"].select("commodity_key", "parent_category")
    cal = ("fiscal_year", "fiscal_month", "month_name")
    per = vendor_measures(facts_with_calendar(T, *cal), *cal, "commodity_key")
    return (per.join(dv, "vendor_key").join(dc, "commodity_key")
            .groupBy(*cal, "vendor_tier", "parent_category")
            .agg(F.sum("_spend").cast("double").alias("total_spend"),
                 F.sum("_keys").alias("transaction_count"),
                 mean_of("_deliv_s", "_deliv_n", rollup=True).alias("avg_delivery_score")))


def top_vendor_spend(T: Mapping[str, DataFrame], n: int | None = None) -> DataFrame:
    """V3: spend, distinct commodities and mean compliance per current
    vendor version, largest spend first; ``n`` keeps the top n."""
    dv = current_vendors(T["dim_vendors"]).select("vendor_key", "vendor_name", "vendor_tier", "risk_rating")
    out = (vendor_measures(T["fact_spend_analytics"]).join(dv, "vendor_key")
           .select("vendor_name", "vendor_tier", "risk_rating",
                   F.col("_spend").cast("double").alias("total_spend"),
                   F.col("_commodities").alias("commodity_count"),
                   mean_of("_comp_s", "_comp_n").alias("avg_compliance_score"))
           .orderBy(F.desc("total_spend")))
    return out.limit(n) if n else out


def active_contracts(T: Mapping[str, DataFrame], as_of) -> DataFrame:
    """V4: active contracts without an end date or ending on/after ``as_of``,
    with vendor name and tier."""
    c = T["contracts"]
    v = T["vendors"].select("vendor_id", "vendor_name", "vendor_tier")
    day = D.lit_date(as_of)
    return (c.filter((F.col("contract_status") == "Active")
                     & (F.col("end_date").isNull() | (F.col("end_date") >= day)))
             .join(v, "vendor_id")
             .select(*c.columns, "vendor_name", "vendor_tier"))


def current_fy_spend(T: Mapping[str, DataFrame]) -> DataFrame:
    """V5: transactions of the latest fiscal year present in the
    transactions, with vendor and commodity names. The latest year is a
    scalar subquery."""
    st = T["spend_transactions"]
    latest = st.agg(F.max("fiscal_year")).scalar()        # scalar subquery, evaluated once
    v = T["vendors"].select("vendor_id", "vendor_name", "vendor_tier")
    c = T["commodities"].select("commodity_id", "commodity_description", "parent_category")
    return (st.filter(F.col("fiscal_year") == latest)
              .join(v, "vendor_id").join(c, "commodity_id")
              .select(*st.columns, "vendor_name", "vendor_tier", "commodity_description", "parent_category"))


def contract_expiry_alerts(T: Mapping[str, DataFrame], as_of) -> DataFrame:
    """V6: active contracts ending on/after ``as_of``: days to expiry and
    alert level (<= 30 Critical, <= 90 Warning, else Monitor), soonest first."""
    day = D.lit_date(as_of)
    c = T["contracts"].filter((F.col("contract_status") == "Active") & F.col("end_date").isNotNull()
                              & (F.col("end_date") >= day))
    v = T["vendors"].select("vendor_id", "vendor_name")
    days = F.datediff(F.col("end_date"), day).cast("double")
    return (c.join(v, "vendor_id")
             .select("contract_id", "contract_name", "vendor_id", "vendor_name", "end_date",
                     days.alias("days_to_expiry"),
                     F.when(days <= 30, "Critical").when(days <= 90, "Warning").otherwise("Monitor")
                     .alias("alert_level"))
             .orderBy("end_date"))


def current_fy_performance(T: Mapping[str, DataFrame], literal: bool = False) -> DataFrame:
    """V7: spend and mean delivery score per current vendor in the current
    fiscal year. Default: the latest fiscal year that has facts.
    ``literal=True``: the latest fiscal year of the calendar (as the source
    view does; normally a year without facts)."""
    days = T["dim_time"].select("time_key", "fiscal_year")
    if not literal:     # the facts' days (combined map-side) that the calendar has
        days = days.join(T["fact_spend_analytics"].select("time_key").distinct(), "time_key", "left_semi")
    latest = days.agg(F.max("fiscal_year")).scalar()
    # the year as a time_key range on the fact scan (scalar subqueries, pushed when the scan starts)
    first = T["dim_time"].filter(F.col("fiscal_year") == latest).agg(F.min("time_key")).scalar()
    end = T["dim_time"].filter(F.col("fiscal_year") == latest).agg(F.max("time_key")).scalar()
    f = T["fact_spend_analytics"].filter((F.col("time_key") >= first) & (F.col("time_key") <= end))
    f = f.join(calendar(T["dim_time"].filter(F.col("fiscal_year") == latest), "time_key"), "time_key")
    dv = current_vendors(T["dim_vendors"]).select("vendor_key", "vendor_name")
    per = vendor_measures(f)
    return per.join(dv, "vendor_key").select(
        "vendor_key", "vendor_name", F.col("_spend").cast("double").alias("total_spend"),
        mean_of("_deliv_s", "_deliv_n").alias("avg_delivery"))


def supplier_performance_by_year(T: Mapping[str, DataFrame], fiscal_year: int | None = None) -> DataFrame:
    """The supplier-performance view by fiscal year (R1 without the fixed
    year), which the source's parameterised report reads; ``fiscal_year``
    restricts the fact scan to that year's days."""
    dv = current_vendors(T["dim_vendors"]).select("vendor_key", "vendor_name", "vendor_tier", "risk_rating")
    facts = facts_in_fiscal_year(T, fiscal_year, "fiscal_year") if fiscal_year else facts_with_calendar(T, "fiscal_year")
    per = vendor_measures(facts, "fiscal_year")
    return per.join(dv, "vendor_key").select(
        "fiscal_year", "vendor_key", "vendor_name", "vendor_tier", "risk_rating",
        F.col("_commodities").alias("categories_served"),
        F.col("_spend").cast("double").alias("total_spend"),
        mean_of("_deliv_s", "_deliv_n").alias("avg_otif"),
        mean_of("_qual_s", "_qual_n").alias("avg_quality"),
        mean_of("_comp_s", "_comp_n").alias("avg_compliance"),
        F.col("_savings").cast("double").alias("total_savings"))


def get_supplier_performance(T: Mapping[str, DataFrame], fiscal_year: int | None = None,
                             vendor_tier: str | None = None) -> DataFrame:
    """V8: name, OTIF and spend from the by-year view; each filter applies
    only when its parameter is given (a falsy value means no filter)."""
    v = supplier_performance_by_year(T, int(fiscal_year) if fiscal_year else None)
    if vendor_tier:
        v = v.filter(F.col("vendor_tier") == F.lit(vendor_tier))
    return v.select("vendor_name", "avg_otif", "total_spend")


def register_views(T: Mapping[str, DataFrame], as_of) -> list[str]:
    """Register the tables and the views as session temp views."""
    for name in T:
        T[name].createOrReplaceTempView(name)
    views = {
        "vw_current_vendors": current_vendors(T["dim_vendors"]),
        "vw_monthly_spend_summary": monthly_spend_summary(T),
        "vw_top_vendor_spend": top_vendor_spend(T),
        "vw_active_contracts": active_contracts(T, as_of),
        "vw_current_fy_spend": current_fy_spend(T),
        "vw_contract_expiry_alerts": contract_expiry_alerts(T, as_of),
        "vw_current_fy_performance": current_fy_performance(T),
        "vw_supplier_performance": supplier_performance_by_year(T),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(T) + list(views)

