"""Named query plans: ``key -> f(T) -> DataFrame``.

``T`` maps table names to DataFrames (fixture tables in tests, Parquet tables
in production). Parameters are the fixture values of ``params``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import AS_OF, FISCAL_YEAR, time_key_of
from ..operators import asof, dims, facts, monitor, quality, reports, risk, scd2, views
from ..operators.profile import profile
from ..session import ensure_checkpoint_dir
from ..sources import io
from ..streaming.fact_stream import streamed_backlog
from ..streaming.vendor_cdc import streamed_dimension

Tables = Mapping[str, DataFrame]

# Fixed parameters of the registered runs.
AS_OF_HISTORY = "2019-06-30"          # D7: a day inside the closed vendor versions
ARCHIVE_CUTOFF = time_key_of(AS_OF.replace(year=AS_OF.year - 5))   # F8: older than 5 years


def _new_facts(T: Tables) -> DataFrame:
    return facts.fact_spend_new(T["spend_transactions"], T["dim_vendors"], T["dim_commodities"], T["dim_time"],
                                T["fact_spend_analytics"], AS_OF)


def _archive_summary(T: Tables) -> DataFrame:
    keep, old = facts.archive_split(T["fact_spend_analytics"], ARCHIVE_CUTOFF)

    def summary(df, name):
        return df.agg(F.lit(name).alias("segment"), F.count(F.lit(1)).alias("row_count"),
                      F.sum(F.col("spend_amount")).cast("double").alias("total_spend"))
    return summary(keep, "keep").unionByName(summary(old, "archive"))


def _enriched(T: Tables) -> DataFrame:
    dk = dims.dim_contracts(T["contracts"], T["risk_assessments"], AS_OF)
    dbu = dims.dim_business_units(T["business_units"], AS_OF)
    return facts.enrich_facts(_new_facts(T), T["spend_transactions"], T["dim_vendors"], dk, T["contracts"],
                              T["purchase_orders"], dbu)


def _as_of(T: Tables) -> DataFrame:
    """The stored facts and the backlog, which the load keys to the vendor's current version."""
    cols = ["fact_key", "time_key", "vendor_key", "spend_amount"]
    both = T["fact_spend_analytics"].select(*cols).unionByName(_new_facts(T).select(*cols))
    return asof.fact_as_of_versions(both, T["dim_vendors"], T["contracts"], T["dim_time"])


def _closed(T: Tables) -> DataFrame:
    return scd2.scd2_closed_rows(T["dim_vendors"], T["vendors"], T["supplier_profiles"], AS_OF)


def _alerts(T: Tables) -> DataFrame:
    # rules and totals in one scan of each table; the profile is a few rows, stored for its several uses
    of = profile(T, rules=quality.declared(T)[0]["rules"], totals=quality.ALERT_TOTALS)
    ensure_checkpoint_dir(of.sparkSession)
    return monitor.dq_alerts(monitor.results_of_profile(T, of.checkpoint(eager=True)))


PLANS: dict[str, Callable[[Tables], DataFrame]] = {
    # sources
    "scan_spend_transactions": lambda T: T["spend_transactions"],
    "copy_star_counts": io.copy_star_counts,
    "table_info": io.table_info,
    # dimensions
    "dim_vendors_new": lambda T: dims.new_dim_vendors(T["vendors"], T["supplier_profiles"], T["dim_vendors"], AS_OF),
    "dim_vendors_new_simple": lambda T: dims.new_dim_vendors_simple(T["vendors"], T["dim_vendors"], AS_OF),
    "dim_commodities_new": lambda T: dims.new_dim_commodities(T["commodities"], T["commodity_profiles"],
                                                              T["dim_commodities"], AS_OF),
    "dim_time": lambda T: dims.calendar_of(T["spend_transactions"]),
    "dim_vendors_as_of": lambda T: dims.dim_as_of(T["dim_vendors"], AS_OF_HISTORY),
    "dim_contracts": lambda T: dims.dim_contracts(T["contracts"], T["risk_assessments"], AS_OF),
    "dim_business_units": lambda T: dims.dim_business_units(T["business_units"], AS_OF),
    # SCD2
    "scd2_vendor_changes": lambda T: scd2.scd2_changes(T["vendors"], T["supplier_profiles"], T["dim_vendors"], AS_OF),
    "scd2_closed": _closed,
    "scd2_apply": lambda T: scd2.scd2_apply(T["dim_vendors"], T["vendors"], T["supplier_profiles"], AS_OF),
    "vendor_cdc_dimension": lambda T: streamed_dimension(T, AS_OF),
    # facts
    "fact_spend_backlog": _new_facts,
    "fact_spend_incremental": lambda T: facts.fact_spend_incremental(
        T["spend_transactions"], T["dim_vendors"], T["dim_commodities"], T["dim_time"],
        T["fact_spend_analytics"], AS_OF),
    "fact_spend_award": lambda T: facts.fact_spend_award(
        T["spend_transactions"], T["dim_vendors"], T["dim_commodities"], T["dim_time"],
        T["fact_spend_analytics"], AS_OF),
    "fact_supplier_performance": lambda T: facts.fact_supplier_performance(
        T["performance_metrics"], T["dim_vendors"], T["dim_time"], AS_OF),
    "fact_savings_realization": lambda T: facts.fact_savings_realization(
        T["fact_spend_analytics"], T["dim_commodities"], T["dim_time"], T["savings_targets"], AS_OF),
    "fact_enriched": _enriched,
    "fact_as_of_versions": _as_of,
    "spend_fiscal_filled": lambda T: facts.fill_fiscal(T["spend_transactions"]).select(
        "transaction_id", "transaction_date", "fiscal_year", "fiscal_quarter"),
    "fact_archive_split": _archive_summary,
    "stream_fact_load": lambda T: streamed_backlog(T, AS_OF),
    # quality, reconciliation, monitoring
    "recon_vendor_count": quality.recon_vendors,
    "recon_spend_amount": quality.recon_spend,
    "recon_spend_status": lambda T: quality.recon_spend_status(T, 1000.0),
    "recon_txn_by_fy": quality.recon_fy,
    "orphan_facts": quality.orphan_facts,
    "consistency_check": quality.check_consistency,
    "health_check": quality.health_check,
    "dq_check_violations": quality.dq_check_violations,
    "dq_duplicate_keys": quality.dq_duplicate_keys,
    "dq_null_columns": quality.dq_null_columns,
    "dq_fk_violations": quality.dq_fk_violations,
    "dq_po_line_amount": lambda T: quality.po_line_amount_violations(T["po_line_items"], 0.01),
    "etl_summary": lambda T: monitor.etl_summary(T["fact_spend_analytics"]),
    "etl_daily_volume": lambda T: monitor.etl_daily_volume(T["fact_spend_analytics"], AS_OF, 30),
    "data_freshness": lambda T: monitor.data_freshness(T["fact_spend_analytics"], T["dim_time"], AS_OF),
    "dq_alerts": _alerts,
    # views
    "vw_current_vendors": lambda T: views.current_vendors(T["dim_vendors"]),
    "vw_monthly_spend_summary": views.monthly_spend_summary,
    "vw_top_vendor_spend": views.top_vendor_spend,
    "vw_active_contracts": lambda T: views.active_contracts(T, AS_OF),
    "vw_current_fy_spend": views.current_fy_spend,
    "vw_contract_expiry_alerts": lambda T: views.contract_expiry_alerts(T, AS_OF),
    "vw_current_fy_performance": views.current_fy_performance,
    "supplier_performance_filtered": lambda T: views.get_supplier_performance(T, FISCAL_YEAR, "Strategic"),
    # patterns and reports
    "monthly_spend_by_category": reports.monthly_spend_by_category,
    "top_vendor_performance": reports.top_vendor_performance,
    "risk_weighted_spend": reports.risk_weighted_spend,
    "supplier_performance": lambda T: reports.supplier_performance(T, FISCAL_YEAR),
    "supplier_performance_restated": lambda T: reports.supplier_performance(T, 2019, restate=True),
    "savings_realization": lambda T: reports.savings_realization(T, (2023, 2024)),
    "pipeline_plan": lambda T: reports.pipeline_plan(T, AS_OF),
    "contract_renewals": lambda T: reports.contract_renewals(T, AS_OF),
    "risk_exposure": lambda T: reports.risk_exposure(T, AS_OF),
    "esg_diversity": reports.esg_diversity,
    "maverick_spend": lambda T: reports.maverick_spend(T, FISCAL_YEAR, 5.0),
    "forecast_alignment": lambda T: reports.forecast_alignment(T, AS_OF),
    "procurement_roi": lambda T: reports.procurement_roi(T, 0.01),
    "tail_spend": lambda T: reports.tail_spend(T, 0.8),
    "strategic_roadmap": reports.strategic_roadmap,
    "compliance_scorecard": lambda T: reports.compliance_scorecard(T, 80.0),
    "working_capital": reports.working_capital,
    "digital_maturity": reports.digital_maturity,
    "global_sourcing": lambda T: reports.global_sourcing(T, FISCAL_YEAR),
    "talent_coverage": reports.talent_coverage,
    "category_plan": reports.category_plan,
    "vendor_certifications": lambda T: reports.vendors_per_certification(T["supplier_profiles"]),
    "market_data_kv": lambda T: reports.market_data_kv(T["market_intelligence"]),
    # roadmap analytics
    "spend_anomalies": lambda T: risk.spend_anomalies(T, 5, 3.0),
    "spend_anomalies_pairs": lambda T: risk.spend_anomalies(T, 2, 0.7),
    "supplier_risk_score": lambda T: risk.supplier_risk_score(T, AS_OF),
}
