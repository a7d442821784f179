"""Query patterns and the executive report catalogue (README numbering).

Every report is a function ``(T, params) -> DataFrame`` built from joins,
grouped aggregates and windows over aggregated rows. Shapes used throughout:

* facts join the calendar (bounded, broadcast) on ``time_key``; a fixed
  fiscal year or date window is also put on the fact scan as a ``time_key``
  range;
* dimension joins are left to Spark/AQE (broadcast when measured small,
  sort-merge otherwise);
* "share of a total" is a separate aggregate joined back on its key, never a
  correlated subquery or a window over the raw rows;
* every aggregate is partial + final (map-side combine), so a vendor or
  category holding a large part of the rows does not land in one task.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.agg import davg, dec, dsum, pct, ratio, real
from ..params import FISCAL_YEAR, as_date, fiscal_year_time_keys, time_key_of
from ..plans.prefix import ordered_running
from .dims import calendar
from .views import (contract_expiry_alerts, current_vendors, facts_in_fiscal_year, facts_with_calendar, mean_of,
                    vendor_measures)


# --------------------------------------------------------------- patterns
def monthly_spend_by_category(T: Mapping[str, DataFrame]) -> DataFrame:
    """Spend by fiscal year, month name and parent category. Facts are
    summed per commodity and month before the commodity join."""
    dc = T["dim_commodities"].select("commodity_key", "parent_category")
    per = (facts_with_calendar(T, "fiscal_year", "month_name")
           .groupBy("fiscal_year", "month_name", "commodity_key").agg(F.sum(dec("spend_amount")).alias("_spend")))
    return (per.join(dc, "commodity_key")
            .groupBy("fiscal_year", "month_name", "parent_category")
            .agg(F.sum("_spend").cast("double").alias("total_spend")))


def top_vendor_performance(T: Mapping[str, DataFrame]) -> DataFrame:
    """Spend and mean delivery/quality by vendor *name* (current
    versions), largest spend first."""
    dv = current_vendors(T["dim_vendors"]).select("vendor_key", "vendor_name")
    return (vendor_measures(T["fact_spend_analytics"]).join(dv, "vendor_key")
            .groupBy("vendor_name")
            .agg(F.sum("_spend").cast("double").alias("total_spend"),
                 mean_of("_deliv_s", "_deliv_n", rollup=True).alias("avg_delivery"),
                 mean_of("_qual_s", "_qual_n", rollup=True).alias("avg_quality"))
            .orderBy(F.desc("total_spend")))


def risk_weighted_spend(T: Mapping[str, DataFrame]) -> DataFrame:
    """Vendors, spend and risk-weighted spend by risk rating."""
    dv = current_vendors(T["dim_vendors"]).select("vendor_key", "risk_rating")
    return (vendor_measures(T["fact_spend_analytics"]).join(dv, "vendor_key")
            .groupBy("risk_rating")
            .agg(F.count(F.lit(1)).alias("vendor_count"),          # one row per vendor with facts
                 F.sum("_spend").cast("double").alias("total_spend"),
                 F.sum("_rws").cast("double").alias("risk_weighted_spend")))


# --------------------------------------------------------------- reports
def restated(facts: DataFrame, dim_vendors: DataFrame) -> DataFrame:
    """Facts re-pointed from superseded vendor versions to the vendor's current
    one; facts of vendors without a current version keep their key. One row
    per superseded version is joined, so current facts need no match."""
    now = current_vendors(dim_vendors).groupBy("vendor_id").agg(F.max("vendor_key").alias("_now"))
    old = dim_vendors.filter(~F.col("is_current_record")).select("vendor_id", "vendor_key").join(now, "vendor_id") \
                     .select("vendor_key", "_now")
    return facts.join(old, "vendor_key", "left").withColumn("vendor_key", F.coalesce("_now", "vendor_key")).drop("_now")


def supplier_performance(T: Mapping[str, DataFrame], fiscal_year: int = FISCAL_YEAR, restate: bool = False) -> DataFrame:
    """R1 (flagship): per current vendor version in one fiscal year:
    distinct commodities, spend, mean OTIF / quality / compliance, savings;
    largest spend first. Facts booked on superseded vendor versions are not
    counted (the report filters the vendor dimension to current rows) unless
    ``restate`` is set: they then count for the vendor's current version."""
    dv = current_vendors(T["dim_vendors"]).select("vendor_key", "vendor_name", "vendor_tier", "risk_rating")
    facts = facts_in_fiscal_year(T, fiscal_year)
    per = vendor_measures(restated(facts, T["dim_vendors"]) if restate else facts)
    return (per.join(dv, "vendor_key")
               .select("vendor_name", "vendor_tier", "risk_rating",
                       F.col("_commodities").alias("categories_served"),
                       F.col("_spend").cast("double").alias("total_spend"),
                       mean_of("_deliv_s", "_deliv_n").alias("avg_otif"),
                       mean_of("_qual_s", "_qual_n").alias("avg_quality"),
                       mean_of("_comp_s", "_comp_n").alias("avg_compliance"),
                       F.col("_savings").cast("double").alias("total_savings"))
               .orderBy(F.desc("total_spend")))


def savings_realization(T: Mapping[str, DataFrame], years=(2023, 2024)) -> DataFrame:
    """R2: facts with positive savings in the given fiscal years, by year,
    fiscal quarter and parent category: spend, savings, baseline spend
    (sum of baseline price x quantity) and savings rate %."""
    years = [int(y) for y in years]
    days = calendar(T["dim_time"].filter(F.col("fiscal_year").isin(years)), "time_key", "fiscal_year",
                    "fiscal_quarter")
    dc = T["dim_commodities"].select("commodity_key", "parent_category")
    baseline = dec("baseline_price", 4) * F.col("quantity").cast("decimal(18,4)")
    lo, hi = fiscal_year_time_keys(min(years))[0], fiscal_year_time_keys(max(years))[1]
    per = (T["fact_spend_analytics"].filter(F.col("time_key").between(lo, hi) & (F.col("savings_amount") > 0))
           .join(days, "time_key")
           .groupBy("fiscal_year", "fiscal_quarter", "commodity_key")
           .agg(F.sum(dec("spend_amount")).alias("_spend"), F.sum(dec("savings_amount", 4)).alias("_savings"),
                F.sum(baseline).alias("_baseline")))
    out = per.join(dc, "commodity_key").groupBy("fiscal_year", "fiscal_quarter", "parent_category").agg(
        F.sum("_spend").cast("double").alias("actual_spend"),
        F.sum("_savings").cast("double").alias("realized_savings"),
        F.sum("_baseline").cast("double").alias("baseline_spend"))
    return (out.withColumn("savings_rate", pct("realized_savings", "actual_spend"))
               .orderBy("fiscal_year", "fiscal_quarter", F.desc("realized_savings")))


def pipeline_plan(T: Mapping[str, DataFrame], as_of) -> DataFrame:
    """Forecasts starting on/after ``as_of`` by fiscal year and quarter
    of the period start and parent category: value, quantity, value at each
    confidence level, number of forecasts."""
    day = D.lit_date(as_of)
    fc = T["demand_forecasts"].filter(F.col("forecast_period_start") >= day)
    c = T["commodities"].select("commodity_id", "parent_category")
    f = (fc.join(c, "commodity_id", "left")
           .withColumn("fiscal_year", D.fiscal_year("forecast_period_start"))
           .withColumn("fiscal_quarter", D.fiscal_quarter("forecast_period_start")))

    def at(level):
        return F.coalesce(F.sum(F.when(F.col("confidence_level") == level, dec("forecasted_value"))),
                          F.lit(0).cast("decimal(28,2)")).cast("double")

    return f.groupBy("fiscal_year", "fiscal_quarter", "parent_category").agg(
        dsum("forecasted_value").alias("forecast_value"),
        dsum("forecasted_quantity", 4).alias("forecast_quantity"),
        at("High").alias("high_confidence_value"),
        at("Medium").alias("medium_confidence_value"),
        at("Low").alias("low_confidence_value"),
        F.count(F.lit(1)).alias("forecasts"))


def contract_renewals(T: Mapping[str, DataFrame], as_of) -> DataFrame:
    """The expiry alerts with contract value and auto-renewal, totalled
    per alert level: contracts, value, auto-renewing contracts."""
    alerts = contract_expiry_alerts(T, as_of).select("contract_id", "alert_level")
    c = T["contracts"].select("contract_id", "contract_value", "auto_renewal")
    return (alerts.join(c, "contract_id")
            .groupBy("alert_level")
            .agg(F.count(F.lit(1)).alias("contracts"),
                 dsum("contract_value").alias("contract_value"),
                 F.count(F.when(F.col("auto_renewal"), 1)).alias("auto_renewing_contracts")))


def risk_exposure(T: Mapping[str, DataFrame], as_of) -> DataFrame:
    """Facts of the last 12 months (day >= as_of - 12 months) of current
    vendor versions by risk rating, country and region: vendors, spend,
    risk-weighted spend, risk factor, and the number of fact rows of
    Strategic vendors."""
    since = F.add_months(D.lit_date(as_of), -12)
    lo = _months_back_key(as_of, 12)
    dv = current_vendors(T["dim_vendors"]).select("vendor_key", "risk_rating", "country", "region", "vendor_tier")
    days = calendar(T["dim_time"].filter(F.col("date_actual") >= since), "time_key")
    per = vendor_measures(T["fact_spend_analytics"].filter(F.col("time_key") >= lo).join(days, "time_key"))
    out = per.join(dv, "vendor_key").groupBy("risk_rating", "country", "region").agg(
        F.count(F.lit(1)).alias("vendor_count"),
        F.sum("_spend").cast("double").alias("total_spend"),
        F.sum("_rws").cast("double").alias("risk_weighted_spend"),
        F.coalesce(F.sum(F.when(F.col("vendor_tier") == "Strategic", F.col("_rows"))), F.lit(0)).cast("long")
        .alias("strategic_vendors"))
    return (out.withColumn("avg_risk_factor", ratio("risk_weighted_spend", "total_spend"))
               .orderBy(F.desc("risk_weighted_spend")))


def _months_back_key(as_of, months: int) -> int:
    """time_key lower bound for ``as_of - months`` (day clamped to month end)."""
    d = as_date(as_of)
    y, m = divmod(d.year * 12 + d.month - 1 - months, 12)
    m += 1
    last = (_dt.date(y + (m == 12), m % 12 + 1, 1) - _dt.timedelta(days=1)).day
    return time_key_of(_dt.date(y, m, min(d.day, last)))


def esg_diversity(T: Mapping[str, DataFrame]) -> DataFrame:
    """By fiscal year and diversity classification (current vendor
    versions with a classification): vendors, spend, ESG-weighted spend,
    mean vendor ESG score per fact row, and share of the year's spend, where
    the year total covers all facts of the year."""
    dv = (current_vendors(T["dim_vendors"]).filter(F.col("diversity_classification").isNotNull())
          .select("vendor_key", "diversity_classification", "esg_score"))
    per = vendor_measures(facts_with_calendar(T, "fiscal_year"), "fiscal_year")
    esg = real("esg_score")
    # One pass over the facts: vendors without a (current, classified) row
    # fall into a NULL group that only feeds the year total; the total is a
    # window over the few groups of each year.
    g = (per.join(dv, "vendor_key", "left")
            .groupBy("fiscal_year", "diversity_classification")
            .agg(F.count(F.lit(1)).alias("vendor_count"),       # one row per vendor and year
                 F.sum("_spend").alias("_spend"),
                 F.sum("_esgw").cast("double").alias("esg_weighted_spend"),
                 # mean of the vendor's score over its fact rows
                 F.try_divide(F.sum(esg * F.col("_rows")).cast("double"),
                              F.sum(F.when(F.col("esg_score").isNotNull(), F.col("_rows")))).alias("avg_esg_score")))
    fy_spend = F.sum("_spend").over(Window.partitionBy("fiscal_year"))
    return (g.withColumn("_fy_spend", fy_spend)
             .filter(F.col("diversity_classification").isNotNull())
             .select("fiscal_year", "diversity_classification", "vendor_count",
                     F.col("_spend").cast("double").alias("total_spend"), "esg_weighted_spend", "avg_esg_score",
                     pct("_spend", "_fy_spend").alias("spend_percentage"))
             .orderBy("fiscal_year", F.desc("total_spend")))


def maverick_spend(T: Mapping[str, DataFrame], fiscal_year: int = FISCAL_YEAR, threshold: float = 5.0) -> DataFrame:
    """By parent category and fiscal quarter of one year: spend,
    off-contract spend, distinct off-contract vendors and off-contract %;
    only groups above ``threshold`` %. All vendor versions count."""
    dc = T["dim_commodities"].select("commodity_key", "parent_category")
    dv = T["dim_vendors"].select("vendor_key")
    off = F.col("contract_key").isNull()
    per = (facts_in_fiscal_year(T, fiscal_year, "fiscal_quarter")
           .groupBy("fiscal_quarter", "commodity_key", "vendor_key")
           .agg(F.sum(dec("spend_amount")).alias("_spend"),
                F.sum(F.when(off, dec("spend_amount")).otherwise(F.lit(0).cast("decimal(18,2)"))).alias("_off"),
                F.count(F.when(off, 1)).alias("_off_rows")))
    out = (per.join(dc, "commodity_key").join(dv, "vendor_key")
              .groupBy("parent_category", "fiscal_quarter")
              .agg(F.sum("_spend").cast("double").alias("total_spend"),
                   F.sum("_off").cast("double").alias("off_contract_spend"),
                   F.countDistinct(F.when(F.col("_off_rows") > 0, F.col("vendor_key"))).alias("maverick_vendors")))
    out = out.withColumn("maverick_percentage", pct("off_contract_spend", "total_spend"))
    return out.filter(F.col("maverick_percentage") > F.lit(float(threshold))).orderBy(F.desc("maverick_percentage"))


def forecast_alignment(T: Mapping[str, DataFrame], as_of) -> DataFrame:
    """Each forecast whose period ended before ``as_of`` against the
    actual transactions of its commodity dated inside the period: actual
    quantity and value (0 if none) and variance % of value.

    Transactions are first reduced to one row per commodity and day, so the
    range join sees at most one row per calendar day per commodity however
    hot the commodity is; forecasts without actuals are kept (left join).
    """
    day = D.lit_date(as_of)
    fc = T["demand_forecasts"].filter(F.col("forecast_period_end") < day)
    # every period ends before as_of, so later transactions can never match:
    # the bound is pushed into the scan
    daily = (T["spend_transactions"].filter(F.col("transaction_date") < day)
             .groupBy("commodity_id", "transaction_date")
             .agg(F.sum(dec("total_amount")).alias("_amt"), F.sum(dec("quantity", 4)).alias("_qty")))
    cond = ((fc.commodity_id == daily.commodity_id)
            & (daily.transaction_date >= fc.forecast_period_start)
            & (daily.transaction_date <= fc.forecast_period_end))
    j = fc.join(daily, cond, "left").drop(daily.commodity_id)
    out = j.groupBy("forecast_id", "commodity_id", "forecast_period_start", "forecast_period_end",
                    "forecasted_quantity", "forecasted_value").agg(
        F.coalesce(F.sum("_qty"), F.lit(0).cast("decimal(28,4)")).cast("double").alias("actual_quantity"),
        F.coalesce(F.sum("_amt"), F.lit(0).cast("decimal(28,2)")).cast("double").alias("actual_value"))
    fv = F.col("forecasted_value").cast("double")
    return out.select("forecast_id", "commodity_id", "forecast_period_start", "forecast_period_end",
                      "forecasted_quantity", fv.alias("forecasted_value"), "actual_quantity", "actual_value",
                      (F.try_divide(F.col("actual_value") - fv, fv) * 100.0).alias("variance_pct"))


def procurement_roi(T: Mapping[str, DataFrame], cost_rate: float = 0.01) -> DataFrame:
    """Per fiscal year: managed spend, savings, savings rate, vendors and
    commodities managed, mean compliance, estimated cost (``cost_rate`` of
    spend) and ROI % = (savings - cost) / cost x 100."""
    per = facts_with_calendar(T, "fiscal_year").groupBy("fiscal_year", "vendor_key", "commodity_key").agg(
        F.sum(dec("spend_amount")).alias("_spend"), F.sum(dec("savings_amount", 4)).alias("_savings"),
        F.sum(real("compliance_score")).alias("_comp_s"), F.count("compliance_score").alias("_comp_n"))
    m = per.groupBy("fiscal_year").agg(
        F.sum("_spend").cast("double").alias("total_managed_spend"),
        F.sum("_savings").cast("double").alias("total_savings"),
        F.countDistinct("vendor_key").alias("vendors_managed"),
        F.countDistinct("commodity_key").alias("categories_managed"),
        mean_of("_comp_s", "_comp_n", rollup=True).alias("avg_compliance"))
    cost = F.col("total_managed_spend") * F.lit(float(cost_rate))
    return (m.select("fiscal_year", "total_managed_spend", "total_savings",
                     pct("total_savings", "total_managed_spend").alias("savings_rate"),
                     "vendors_managed", "categories_managed", "avg_compliance",
                     cost.alias("estimated_procurement_cost"),
                     (F.try_divide(F.col("total_savings") - cost, cost) * 100.0).alias("procurement_roi"))
             .orderBy("fiscal_year"))


def tail_spend(T: Mapping[str, DataFrame], cutoff: float = 0.8, num_partitions: int | None = None) -> DataFrame:
    """Vendors ranked by spend within each fiscal year (ties by vendor
    key); a vendor is in the tail when the spend of the vendors ranked
    before it is at least ``cutoff`` of the year's spend. Per year: vendors,
    tail vendors, tail spend, tail share %, tail fact rows.

    The running sum is computed over range-partitioned slices of the
    (year, spend desc, vendor) order, so a year with very many vendors is
    spread over many tasks.
    """
    vy = (facts_with_calendar(T, "fiscal_year")
          .groupBy("fiscal_year", "vendor_key")
          .agg(F.sum(dec("spend_amount")).alias("v_spend"), F.count(F.lit(1)).alias("v_rows")))
    # The slices feed two branches (local positions and per-slice totals);
    # materializing them once keeps the fact aggregation above from running
    # twice.
    ranked = ordered_running(vy, [F.desc("v_spend"), F.col("vendor_key")], group=["fiscal_year"],
                             value="v_spend", index_col="rank", sum_col="cum_spend",
                             num_partitions=num_partitions)
    totals = ranked.groupBy("fiscal_year").agg(F.sum("v_spend").alias("fy_spend"))   # reads the slices
    before = (F.col("cum_spend") - F.col("v_spend")).cast("double")
    tail = F.try_divide(before, F.col("fy_spend").cast("double")) >= F.lit(float(cutoff))
    out = (ranked.join(totals, "fiscal_year")
           .withColumn("_tail", tail)
           .groupBy("fiscal_year")
           .agg(F.count(F.lit(1)).alias("vendors"),
                F.count(F.when(F.col("_tail"), 1)).alias("tail_vendors"),
                F.coalesce(F.sum(F.when(F.col("_tail"), F.col("v_spend"))), F.lit(0).cast("decimal(28,2)"))
                .cast("double").alias("tail_spend"),
                F.sum(F.col("v_spend")).cast("double").alias("total_spend"),
                F.coalesce(F.sum(F.when(F.col("_tail"), F.col("v_rows"))), F.lit(0)).cast("long")
                .alias("tail_transactions")))
    return out.withColumn("tail_share", pct("tail_spend", "total_spend"))


def strategic_roadmap(T: Mapping[str, DataFrame]) -> DataFrame:
    """Current vendor versions, by fiscal year x vendor tier x business
    criticality x sourcing complexity x sourcing strategy of the commodity
    ('None' without an active strategy; the smallest type name when there
    are several): vendors, spend, share of the year's spend in this report,
    and growth % vs the previous fiscal year present for the same segment.
    The ``lag`` window runs over aggregated segment-years only."""
    dv = current_vendors(T["dim_vendors"]).select("vendor_key", "vendor_tier")
    dc = T["dim_commodities"].select("commodity_key", "commodity_id", "business_criticality", "sourcing_complexity")
    strat = (T["sourcing_strategies"].filter(F.col("status") == "Active")
             .groupBy("commodity_id").agg(F.min("strategy_type").alias("strategy_type")))
    per = (facts_with_calendar(T, "fiscal_year").groupBy("fiscal_year", "vendor_key", "commodity_key")
           .agg(F.sum(dec("spend_amount")).alias("_s")))
    f = (per.join(dv, "vendor_key").join(dc, "commodity_key")
         .join(strat, "commodity_id", "left")
         .withColumn("strategy_type", F.coalesce(F.col("strategy_type"), F.lit("None"))))
    keys = ["vendor_tier", "business_criticality", "sourcing_complexity", "strategy_type"]
    seg = f.groupBy("fiscal_year", *keys).agg(F.countDistinct("vendor_key").alias("vendors"),
                                              F.sum("_s").alias("_spend"))
    # year totals and lag are windows over segment rows (bounded by the
    # number of segment combinations), so the facts are aggregated once
    w = Window.partitionBy(*keys).orderBy("fiscal_year")
    prev = F.lag(F.col("_spend").cast("double")).over(w)
    spend = F.col("_spend").cast("double")
    return (seg.withColumn("_fy_spend", F.sum("_spend").over(Window.partitionBy("fiscal_year")))
               .select("fiscal_year", *keys, "vendors", spend.alias("total_spend"),
                       pct("_spend", "_fy_spend").alias("spend_share"),
                       (F.try_divide(spend - prev, prev) * 100.0).alias("growth_pct")))


def compliance_scorecard(T: Mapping[str, DataFrame], floor: float = 80.0) -> DataFrame:
    """By fiscal year and parent category: mean compliance score, % of
    scored facts under ``floor``, % of spend with a contract, facts,
    unscored facts."""
    dc = T["dim_commodities"].select("commodity_key", "parent_category")
    score = F.col("compliance_score")
    per = facts_with_calendar(T, "fiscal_year").groupBy("fiscal_year", "commodity_key").agg(
        F.sum(real("compliance_score")).alias("_cs"),
        F.count(F.when(score < F.lit(float(floor)), 1)).alias("_u"),
        F.count(score).alias("_n"),
        F.sum(F.when(F.col("contract_key").isNotNull(), dec("spend_amount"))).alias("_o"),
        F.sum(dec("spend_amount")).alias("_a"),
        F.count(F.lit(1)).alias("_f"))
    out = per.join(dc, "commodity_key").groupBy("fiscal_year", "parent_category").agg(
        F.try_divide(F.sum("_cs").cast("double"), F.sum("_n")).alias("avg_compliance"),
        F.sum("_u").alias("_under"),
        F.sum("_n").alias("_scored"),
        F.sum("_o").alias("_on"),
        F.sum("_a").alias("_all"),
        F.sum("_f").alias("facts"))
    return out.select("fiscal_year", "parent_category", "avg_compliance",
                      pct("_under", "_scored").alias("pct_under_floor"),
                      pct(F.coalesce(F.col("_on"), F.lit(0).cast("decimal(28,2)")), "_all").alias("on_contract_pct"),
                      "facts", (F.col("facts") - F.col("_scored")).alias("unscored_facts"))


def working_capital(T: Mapping[str, DataFrame]) -> DataFrame:
    """Paid transactions by fiscal year and quarter of the transaction
    date: spend-weighted days payable (payment - invoice), mean payment
    terms of the contract (unknown terms left out), and % of contract-backed
    spend paid later than the terms."""
    st = T["spend_transactions"].filter(F.col("payment_date").isNotNull())
    terms = T["contracts"].select("contract_id", "payment_terms")
    # combined per contract, quarter and days first: the join sees one row of
    # each, so transactions without a contract are no hot key
    f = (st.withColumn("fiscal_year", D.fiscal_year("transaction_date"))
           .withColumn("fiscal_quarter", D.fiscal_quarter("transaction_date"))
           .withColumn("_days", F.datediff("payment_date", "invoice_date"))
           .groupBy("fiscal_year", "fiscal_quarter", "contract_id", "_days")
           .agg(F.sum(dec("total_amount")).alias("_a"), F.count(F.lit(1)).alias("_n"))
           .join(terms, "contract_id", "left"))
    amt, n = F.col("_a"), F.col("_n")
    known = F.col("payment_terms").isNotNull()
    out = f.groupBy("fiscal_year", "fiscal_quarter").agg(
        F.sum(amt * F.col("_days")).alias("_wdays"),
        F.sum(amt).alias("_amt"),
        F.try_divide(F.sum(real("payment_terms") * n).cast("double"), F.sum(F.when(known, n))).alias("avg_payment_terms"),
        F.sum(F.when(known & (F.col("_days") > F.col("payment_terms")), amt)).alias("_late"),
        F.sum(F.when(known, amt)).alias("_backed"),
        F.sum(n).alias("transactions"))
    return out.select("fiscal_year", "fiscal_quarter",
                      ratio("_wdays", "_amt").alias("days_payable"),
                      "avg_payment_terms",
                      pct(F.coalesce(F.col("_late"), F.lit(0).cast("decimal(28,2)")), "_backed")
                      .alias("late_payment_pct"),
                      "transactions")


def digital_maturity(T: Mapping[str, DataFrame]) -> DataFrame:
    """Loaded transactions (joined to their fact) by fiscal year and
    quarter of the transaction date: % with a PO, % with a contract, % of
    facts invoiced the same day, mean PO cycle time."""
    st = T["spend_transactions"].select(F.col("transaction_id").cast("string").alias("source_transaction_id"),
                                        "po_id", "contract_id", "transaction_date")
    fa = T["fact_spend_analytics"].select("source_transaction_id", "invoice_processing_time_days",
                                          "po_cycle_time_days")
    f = (st.join(fa, "source_transaction_id")
           .withColumn("fiscal_year", D.fiscal_year("transaction_date"))
           .withColumn("fiscal_quarter", D.fiscal_quarter("transaction_date")))
    out = f.groupBy("fiscal_year", "fiscal_quarter").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count("po_id").alias("_po"), F.count("contract_id").alias("_k"),
        F.count(F.when(F.col("invoice_processing_time_days") == 0, 1)).alias("_same"),
        davg("po_cycle_time_days").alias("avg_po_cycle_days"))
    return out.select("fiscal_year", "fiscal_quarter", "transactions",
                      pct("_po", "transactions").alias("po_backed_pct"),
                      pct("_k", "transactions").alias("on_contract_pct"),
                      pct("_same", "transactions").alias("same_day_invoice_pct"),
                      "avg_po_cycle_days")


def global_sourcing(T: Mapping[str, DataFrame], fiscal_year: int = FISCAL_YEAR) -> DataFrame:
    """One fiscal year, current vendor versions, by region, country
    and parent category: vendors, spend, mean delivery score, mean unit
    price, risk factor, and share of the category's spend over all years
    and all vendor versions (a NULL category gets a NULL share)."""
    dv = current_vendors(T["dim_vendors"]).select("vendor_key", "region", "country")
    dc = T["dim_commodities"].select("commodity_key", "parent_category")
    per = vendor_measures(facts_in_fiscal_year(T, fiscal_year), "commodity_key")
    cat = (T["fact_spend_analytics"].groupBy("commodity_key").agg(F.sum(dec("spend_amount")).alias("_c"))
           .join(dc, "commodity_key")
           .groupBy("parent_category").agg(F.sum("_c").cast("double").alias("_cat_spend")))
    out = per.join(dv, "vendor_key").join(dc, "commodity_key").groupBy("region", "country", "parent_category").agg(
        F.countDistinct("vendor_key").alias("vendor_count"),
        F.sum("_spend").cast("double").alias("total_spend"),
        mean_of("_deliv_s", "_deliv_n", rollup=True).alias("avg_delivery_performance"),
        mean_of("_price_s", "_price_n", rollup=True).alias("avg_unit_price"),
        F.sum("_rws").cast("double").alias("_rws"))
    return (out.join(cat, "parent_category", "left")
               .select("region", "country", "parent_category", "vendor_count", "total_spend",
                       "avg_delivery_performance", "avg_unit_price",
                       ratio("_rws", "total_spend").alias("avg_risk_factor"),
                       pct("total_spend", "_cat_spend").alias("category_share"))
               .orderBy(F.desc("total_spend")))


def talent_coverage(T: Mapping[str, DataFrame]) -> DataFrame:
    """Per category manager ('Unassigned' when none), over current
    commodity versions: commodities, parent categories, fact spend, share of
    all spend in the report, high or critical commodities. Spend is summed
    per commodity before the join."""
    dc = (T["dim_commodities"].filter(F.col("is_current_record"))
          .select("commodity_key", "commodity_id", "parent_category", "business_criticality",
                  F.coalesce(F.col("category_manager"), F.lit("Unassigned")).alias("category_manager")))
    spend = (T["fact_spend_analytics"].groupBy("commodity_key")
             .agg(F.sum(dec("spend_amount")).alias("_spend")))
    j = dc.join(spend, "commodity_key", "left")
    out = j.groupBy("category_manager").agg(
        F.countDistinct("commodity_id").alias("commodities"),
        F.countDistinct("parent_category").alias("categories"),
        F.coalesce(F.sum("_spend"), F.lit(0).cast("decimal(28,2)")).alias("_mgr"),
        F.countDistinct(F.when(F.col("business_criticality").isin("High", "Critical"), F.col("commodity_id")))
        .alias("high_critical_commodities"))
    total = j.agg(F.sum("_spend")).scalar()          # scalar subquery, evaluated once
    return out.select("category_manager", "commodities", "categories",
                      F.col("_mgr").cast("double").alias("total_spend"),
                      pct(F.col("_mgr"), total).alias("spend_share"), "high_critical_commodities")


def category_plan(T: Mapping[str, DataFrame]) -> DataFrame:
    """``rollup(fiscal_year, parent_category, sub_category)`` of spend
    and savings, with ``level`` = grouping id (0 detail, 1 category, 3 year,
    7 total) so NULL categories are not confused with subtotals; target =
    savings targets of the commodities in the group for the year (rolled up
    the same way, joined on the null-safe key incl. level); attainment % =
    savings / target."""
    dc = T["dim_commodities"].filter(F.col("is_current_record")).select(
        "commodity_key", "commodity_id", "parent_category", "sub_category")
    keys = ["fiscal_year", "parent_category", "sub_category"]
    per = (facts_with_calendar(T, "fiscal_year").groupBy("fiscal_year", "commodity_key")
           .agg(F.sum(dec("spend_amount")).alias("_s"), F.sum(dec("savings_amount", 4)).alias("_v")))
    f = per.join(dc, "commodity_key")
    spend = f.rollup(*keys).agg(F.grouping_id().alias("level"),
                                F.sum("_s").alias("_spend"),
                                F.sum("_v").alias("_savings"))
    tg = (T["savings_targets"].join(dc.select("commodity_id", "parent_category", "sub_category"), "commodity_id")
          .rollup(*keys).agg(F.grouping_id().alias("level"), F.sum(dec("target_amount")).alias("_target")))
    cond = [spend[k].eqNullSafe(tg[k]) for k in keys] + [spend["level"] == tg["level"]]
    j = spend.join(tg, cond, "left")
    return j.select(*[spend[k] for k in keys], spend["level"].cast("int").alias("level"),
                    F.col("_spend").cast("double").alias("total_spend"),
                    F.col("_savings").cast("double").alias("total_savings"),
                    F.col("_target").cast("double").alias("savings_target"),
                    pct("_savings", "_target").alias("attainment_pct"))


# --------------------------------------------------------------- JSON
def vendor_certifications(profiles: DataFrame) -> DataFrame:
    """Certifications JSON array exploded to vendor x certification."""
    return (profiles.select("vendor_id", F.explode(F.from_json("certifications", "array<string>"))
                            .alias("certification")))


def vendors_per_certification(profiles: DataFrame) -> DataFrame:
    """Vendors per certification."""
    return (vendor_certifications(profiles).groupBy("certification")
            .agg(F.countDistinct("vendor_id").alias("vendor_count")))


def market_data_kv(mi: DataFrame) -> DataFrame:
    """Market-data JSON object to one row per key."""
    return mi.select("commodity_id", "report_date",
                     F.explode(F.from_json("market_data", "map<string,string>")).alias("data_key", "data_value"))


# --------------------------------------------------------------- catalogue
def run_reports(T: Mapping[str, DataFrame], as_of, fiscal_year: int = FISCAL_YEAR) -> dict[str, DataFrame]:
    """The 17 executive reports (README numbering R1-R17) as lazy
    DataFrames; ``sources.io.write_reports`` stores them."""
    return {
        "supplier_performance": supplier_performance(T, fiscal_year),
        "savings_realization": savings_realization(T, (fiscal_year - 1, fiscal_year)),
        "pipeline_plan": pipeline_plan(T, as_of),
        "contract_renewals": contract_renewals(T, as_of),
        "risk_exposure": risk_exposure(T, as_of),
        "esg_diversity": esg_diversity(T),
        "maverick_spend": maverick_spend(T, fiscal_year),
        "forecast_alignment": forecast_alignment(T, as_of),
        "procurement_roi": procurement_roi(T),
        "tail_spend": tail_spend(T),
        "strategic_roadmap": strategic_roadmap(T),
        "compliance_scorecard": compliance_scorecard(T),
        "working_capital": working_capital(T),
        "digital_maturity": digital_maturity(T),
        "global_sourcing": global_sourcing(T, fiscal_year),
        "talent_coverage": talent_coverage(T),
        "category_plan": category_plan(T),
    }
