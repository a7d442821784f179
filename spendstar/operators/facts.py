"""Fact builders: spend facts (backlog, incremental, award-dated), supplier
performance, savings realization, KPI enrichment, fiscal fill, archive split.

The spend fact has one row per source transaction and ``fact_key`` is the
transaction id, so no global row numbering is ever needed on the fact side.
Calendar lookups join on the date column itself (``date_actual``) rather than
on a formatted ``YYYYMMDD`` of the transaction date: same rows, but the date
predicate stays pushable to the Parquet scan.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.agg import dec, real
from ..params import as_date, fiscal_year_time_keys
from ..session import ensure_checkpoint_dir
from ..sources.loaded_ids import find_loaded
from .dims import calendar

SPEND_FACT_COLS = ["fact_key", "vendor_key", "commodity_key", "time_key", "spend_amount", "transaction_count",
                   "quantity", "unit_price", "source_transaction_id", "load_date"]


def _loaded_ids(existing: DataFrame) -> DataFrame:
    return existing.filter(F.col("source_transaction_id").isNotNull()).select("source_transaction_id")


def _not_loaded(st: DataFrame, existing: DataFrame | None, index: DataFrame | None = None) -> DataFrame:
    """Rows of ``st`` whose transaction is not loaded yet: by the index of
    loaded ids if there is one (the facts are not read), else by the facts.
    Ids are compared whatever their day, so re-dated transactions and those of
    the award-dated variant are found."""
    key = "source_transaction_id"
    known = _loaded_ids(existing) if index is None else find_loaded(index, st)
    return st.join(known, key, "left_anti")


def fact_spend_new(spend: DataFrame, dim_vendors: DataFrame, dim_commodities: DataFrame, dim_time: DataFrame,
                   existing: DataFrame | None, as_of, since=None, index: DataFrame | None = None) -> DataFrame:
    """F1 (and F2 with ``since``): transactions not loaded yet, keyed to the
    current vendor and commodity versions and to the calendar.

    Transactions with no current vendor, no current commodity or a day outside
    the calendar drop out (inner joins). "Already loaded" compares the
    transaction id as text with ``source_transaction_id`` (an anti join; the
    loaded side is filtered to non-NULL ids, so it is not the null-aware
    ``NOT IN`` plan that would broadcast the whole fact table). With ``index``
    (``sources.loaded_ids``) only ids are read, and ``existing`` is not used.
    """
    st = spend.filter(F.col("transaction_id").isNotNull())
    if since is not None:
        st = st.filter(F.col("transaction_date") >= D.lit_date(since))
    # The "not loaded yet" test depends on the transaction alone, so it runs
    # first: a daily run joins only its new transactions to the dimensions.
    st = _not_loaded(st.withColumn("source_transaction_id", F.col("transaction_id").cast("string")), existing, index)
    dv = dim_vendors.filter(F.col("is_current_record")).select("vendor_id", "vendor_key")
    dc = dim_commodities.filter(F.col("is_current_record")).select("commodity_id", "commodity_key")
    days = calendar(dim_time, "date_actual", "time_key")
    rows = (st.join(dv, "vendor_id").join(dc, "commodity_id")
              .join(days, st.transaction_date == days.date_actual))
    return rows.select(
        F.col("transaction_id").alias("fact_key"), "vendor_key", "commodity_key", "time_key",
        F.col("total_amount").alias("spend_amount"), F.lit(1).alias("transaction_count"),
        "quantity", "unit_price", "source_transaction_id", D.lit_date(as_of).alias("load_date"))


def fact_spend_incremental(spend, dim_vendors, dim_commodities, dim_time, existing, as_of, days: int = 7,
                           index: DataFrame | None = None) -> DataFrame:
    """as F1 for transactions dated on or after ``as_of - days``."""
    since = as_date(as_of) - _dt.timedelta(days=days)
    return fact_spend_new(spend, dim_vendors, dim_commodities, dim_time, existing, as_of, since=since, index=index)


def fact_spend_award(spend: DataFrame, dim_vendors: DataFrame, dim_commodities: DataFrame, dim_time: DataFrame,
                     existing: DataFrame, as_of) -> DataFrame:
    """the variant dated by ``award_date`` that joins every dimension
    version (one fact per vendor version and commodity version) and carries
    no quantity or unit price. A NULL award date drops the transaction."""
    st = (spend.filter(F.col("transaction_id").isNotNull())
               .withColumn("source_transaction_id", F.col("transaction_id").cast("string"))
               .join(_loaded_ids(existing), "source_transaction_id", "left_anti"))
    dv = dim_vendors.select("vendor_id", "vendor_key")
    dc = dim_commodities.select("commodity_id", "commodity_key")
    days = calendar(dim_time, "date_actual", "time_key")
    rows = (st.join(dv, "vendor_id").join(dc, "commodity_id")
              .join(days, st.award_date == days.date_actual))
    return rows.select("vendor_key", "commodity_key", "time_key", F.col("total_amount").alias("spend_amount"),
                       F.lit(1).alias("transaction_count"), "source_transaction_id",
                       D.lit_date(as_of).alias("load_date"))


# Metric names that become columns of fact_supplier_performance.
PERFORMANCE_METRICS = [
    "on_time_delivery_rate", "in_full_delivery_rate", "defect_rate", "return_rate", "response_time_hours",
    "resolution_time_hours", "customer_satisfaction_score", "sustainability_score", "diversity_spend_percentage",
]


def fact_supplier_performance(metrics: DataFrame, dim_vendors: DataFrame, dim_time: DataFrame, as_of) -> DataFrame:
    """one row per current vendor and measurement period end day; each
    known metric name is averaged into its own column (conditional
    aggregates, combined map-side). ``otif_rate = on_time * in_full / 100``.
    ``performance_key`` is composed from the grain (vendor_key, time_key)."""
    dv = dim_vendors.filter(F.col("is_current_record")).select("vendor_id", "vendor_key")
    days = calendar(dim_time, "date_actual", "time_key")
    m = (metrics.filter(F.col("metric_name").isin(PERFORMANCE_METRICS))
                .join(dv, "vendor_id")
                .join(days, F.col("measurement_period_end") == days.date_actual))
    aggs = [F.try_divide(F.sum(F.when(F.col("metric_name") == name, real("metric_value"))).cast("double"),
                         F.count(F.when(F.col("metric_name") == name, F.col("metric_value")))).alias(name)
            for name in PERFORMANCE_METRICS]
    out = m.groupBy("vendor_key", "time_key").agg(*aggs)
    return out.select(
        (F.col("vendor_key") * F.lit(100000000) + F.col("time_key")).alias("performance_key"),
        "vendor_key", "time_key", *PERFORMANCE_METRICS[:2],
        (F.col("on_time_delivery_rate") * F.col("in_full_delivery_rate") / F.lit(100.0)).alias("otif_rate"),
        *PERFORMANCE_METRICS[2:], D.lit_date(as_of).alias("load_date"))


# Savings target types of the source system and their columns.
TARGET_TYPE_COLUMNS = [("Hard Savings", "hard_savings_amount"), ("Soft Savings", "soft_savings_amount"),
                       ("Cost Avoidance", "cost_avoidance_amount")]


def fact_savings_realization(facts: DataFrame, dim_commodities: DataFrame, dim_time: DataFrame,
                             targets: DataFrame, as_of, years: Sequence[int] | None = None) -> DataFrame:
    """per fiscal year x commodity x vendor with a savings target; with
    ``years`` for these fiscal years only, read from their days' facts.

    realized = the vendor's savings on the commodity that year; forecast =
    the commodity's target for the year x the vendor's share of the
    commodity's spend that year; the three amount columns split the realized
    savings by the commodity's target-type mix; realization_rate =
    100 * realized / forecast when forecast > 0, else 0; time_key = last day
    of the fiscal year. Commodity totals are a separate aggregate joined back
    (no window over a commodity's vendors).
    """
    if years is not None:
        ranges = F.lit(False)
        for a, b in map(fiscal_year_time_keys, years):
            ranges = ranges | F.col("time_key").between(a, b)
        facts, targets = facts.filter(ranges), targets.filter(F.col("fiscal_year").isin(list(years)))
    days = calendar(dim_time, "time_key", "fiscal_year")
    dc = dim_commodities.select("commodity_key", "commodity_id")
    vc = (facts.join(days, "time_key")
               .groupBy("fiscal_year", "commodity_key", "vendor_key")
               .agg(F.sum(dec("savings_amount", 4)).alias("realized"), F.sum(dec("spend_amount")).alias("v_spend"))
               .join(dc, "commodity_key"))
    # the aggregate feeds two branches (vendor rows, commodity totals);
    # materialized once in the shared checkpoint folder, the facts are read once
    ensure_checkpoint_dir(vc.sparkSession)
    vc = vc.checkpoint(eager=True)
    cs = vc.groupBy("fiscal_year", "commodity_key").agg(F.sum("v_spend").alias("c_spend"))   # from the smaller aggregate
    tg = targets.groupBy("commodity_id", "fiscal_year").agg(
        F.sum(dec("target_amount")).cast("double").alias("target_total"),
        *[F.sum(F.when(F.col("target_type") == t, dec("target_amount"))).cast("double").alias("_t_" + c)
          for t, c in TARGET_TYPE_COLUMNS])
    j = vc.join(cs, ["fiscal_year", "commodity_key"]).join(tg, ["commodity_id", "fiscal_year"])
    share = F.try_divide(F.col("v_spend").cast("double"), F.col("c_spend").cast("double"))
    realized = F.col("realized").cast("double")
    forecast = F.coalesce(F.col("target_total") * share, F.lit(0.0))
    out = j.select(
        # the grain: fiscal year, vendor, commodity
        F.concat_ws("-", "fiscal_year", "vendor_key", "commodity_key").alias("savings_key"),
        "vendor_key", "commodity_key",
        D.time_key(F.make_date(F.col("fiscal_year"), F.lit(3), F.lit(31))).alias("time_key"),
        "fiscal_year",
        *[F.coalesce(realized * F.try_divide(F.col("_t_" + c), F.col("target_total")), F.lit(0.0)).alias(c)
          for _, c in TARGET_TYPE_COLUMNS],
        F.lit(0.0).alias("working_capital_improvement"),
        forecast.alias("forecasted_savings"),
        realized.alias("realized_savings"),
        D.lit_date(as_of).alias("load_date"))
    return out.withColumn("realization_rate", F.when(F.col("forecasted_savings") > 0,
                                                     F.col("realized_savings") / F.col("forecasted_savings") * 100.0)
                          .otherwise(F.lit(0.0)))


# Risk factor per risk rating and ESG factor = esg_score / 100
# (the source names these KPIs but gives no factors).
RISK_FACTORS = [("Low", "1.0"), ("Medium", "1.5"), ("High", "2.0"), ("Critical", "3.0")]


def risk_factor(rating_col) -> F.Column:
    expr = None
    for rating, factor in RISK_FACTORS:
        expr = (F.when(rating_col == rating, F.lit(factor).cast("decimal(3,1)")) if expr is None
                else expr.when(rating_col == rating, F.lit(factor).cast("decimal(3,1)")))
    return expr


def enrich_facts(facts: DataFrame, spend: DataFrame, dim_vendors: DataFrame, dim_contracts: DataFrame,
                 contracts: DataFrame, purchase_orders: DataFrame, dim_business_units: DataFrame) -> DataFrame:
    """KPI columns of spend facts that the loads leave NULL.

    risk_weighted_spend = spend x risk factor of the fact's own vendor
    version; esg_weighted_spend = spend x esg_score / 100; baseline_price =
    unit_price x (1 + discount); savings_amount = (baseline - unit_price) x
    quantity; contract_key by contract id; business_unit_key by unit id;
    po_cycle_time_days = approved - PO date; invoice_processing_time_days =
    invoice - transaction date; payment_delay_days = payment - invoice -
    payment terms. NULL inputs give NULL.
    """
    st = spend.select(F.col("transaction_id").cast("string").alias("source_transaction_id"),
                      "contract_id", "business_unit_id", "po_id", "transaction_date", "invoice_date",
                      "payment_date", "discount")
    dv = dim_vendors.select("vendor_key", "risk_rating", "esg_score")
    dk = dim_contracts.filter(F.col("is_current_record")).select("contract_id", "contract_key")
    terms = contracts.select("contract_id", "payment_terms")
    po = purchase_orders.select("po_id", F.datediff("approved_date", "po_date").alias("po_cycle_time_days"))
    bu = dim_business_units.filter(F.col("is_current_record")).select("business_unit_id", "business_unit_key")
    base = facts.drop(*[c for c in ("contract_key", "business_unit_key", "risk_weighted_spend",
                                    "esg_weighted_spend", "savings_amount", "baseline_price",
                                    "po_cycle_time_days", "invoice_processing_time_days",
                                    "payment_delay_days") if c in facts.columns])
    j = (base.join(st, "source_transaction_id", "left")
             .join(dv, "vendor_key", "left")
             .join(dk, "contract_id", "left")
             .join(terms, "contract_id", "left")
             .join(po, "po_id", "left")
             .join(bu, "business_unit_id", "left"))
    disc = F.col("discount").cast("decimal(13,10)")
    baseline = (F.col("unit_price") * (F.lit(1).cast("decimal(1,0)") + disc)).cast("decimal(18,4)")
    return j.select(
        *base.columns, "contract_key", "business_unit_key",
        (F.col("spend_amount") * risk_factor(F.col("risk_rating"))).cast("decimal(18,3)").alias("risk_weighted_spend"),
        (F.col("spend_amount") * F.col("esg_score").cast("decimal(13,10)") * F.lit(0.01).cast("decimal(2,2)"))
        .cast("decimal(20,4)").alias("esg_weighted_spend"),
        ((baseline - F.col("unit_price")) * F.col("quantity").cast("decimal(18,4)")).cast("decimal(18,4)")
        .alias("savings_amount"),
        baseline.alias("baseline_price"),
        F.col("po_cycle_time_days").cast("int").alias("po_cycle_time_days"),
        F.datediff("invoice_date", "transaction_date").alias("invoice_processing_time_days"),
        (F.datediff("payment_date", "invoice_date") - F.col("payment_terms")).alias("payment_delay_days"))


def fill_fiscal(spend: DataFrame) -> DataFrame:
    """when ``fiscal_year`` is NULL, set fiscal year and quarter from the
    transaction date; other rows keep theirs (a missing ``fiscal_quarter``
    column is added as NULL first)."""
    if "fiscal_quarter" not in spend.columns:
        spend = spend.withColumn("fiscal_quarter", F.lit(None).cast("int"))
    missing = F.col("fiscal_year").isNull()
    return (spend.withColumn("fiscal_quarter", F.when(missing, D.fiscal_quarter("transaction_date"))
                             .otherwise(F.col("fiscal_quarter")))
                 .withColumn("fiscal_year", F.when(missing, D.fiscal_year("transaction_date"))
                             .otherwise(F.col("fiscal_year"))))


def archive_split(facts: DataFrame, cutoff_time_key: int) -> tuple[DataFrame, DataFrame]:
    """F8: (kept, archived) where archived = ``time_key < cutoff``. Both are
    filters on the same scan; with facts partitioned by fiscal year the
    archived side is a directory prune."""
    old = F.col("time_key") < F.lit(int(cutoff_time_key))
    return facts.filter(~old | F.col("time_key").isNull()), facts.filter(old)
