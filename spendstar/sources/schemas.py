"""Fixed schemas of the operational and star tables.

Tables are read with these schemas (never inferred), so a drifted file is
detected (``operators.quality.schema_drift``) instead of silently retyped.
Money is ``decimal(18,2)``; scores and quantities are ``double``; business
dates are ``date``; surrogate keys are ``bigint``; ``time_key`` is ``int``.
"""

from __future__ import annotations

import re

from pyspark.sql.types import (BooleanType, DataType, DateType, DecimalType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType)

_TYPES: dict[str, DataType] = {"string": StringType(), "boolean": BooleanType(), "int": IntegerType(),
                               "bigint": LongType(), "double": DoubleType(), "date": DateType()}


def _type(name: str) -> DataType:
    m = re.fullmatch(r"decimal\((\d+),(\d+)\)", name)
    return DecimalType(int(m.group(1)), int(m.group(2))) if m else _TYPES[name]


def _st(cols: str) -> StructType:
    """``"name type, name type, ..."`` column lists (fixed, simple types)."""
    fields = []
    for item in re.split(r",\s*(?=[a-z_]+ )", cols.strip()):
        name, typ = item.split()
        fields.append(StructField(name, _type(typ), True))
    return StructType(fields)


OPERATIONAL = {
    "vendors": _st("vendor_id string, vendor_name string, vendor_tier string, diversity_classification string, "
                   "country string, region string, is_active boolean"),
    "supplier_profiles": _st("vendor_id string, risk_rating string, esg_score double, audit_score double, "
                             "certifications string"),
    "commodities": _st("commodity_id string, commodity_description string, parent_category string, "
                       "sub_category string, unit_of_measure string, is_active boolean"),
    "commodity_profiles": _st("commodity_id string, business_criticality string, sourcing_complexity string, "
                              "category_manager string, market_volatility string, supply_risk string"),
    "time_periods": _st("period_id int, period_name string, start_date date, end_date date, fiscal_year int, "
                        "fiscal_quarter int, fiscal_month int, is_current_period boolean"),
    "business_units": _st("business_unit_id string, business_unit_name string, parent_unit_id string, "
                          "cost_center string, region string, country string, manager_name string"),
    "contracts": _st("contract_id string, vendor_id string, contract_name string, contract_type string, "
                     "contract_status string, start_date date, end_date date, contract_value decimal(18,2), "
                     "auto_renewal boolean, payment_terms int, currency_code string"),
    "purchase_orders": _st("po_id string, business_unit_id string, po_date date, approved_date date, "
                           "po_status string, total_amount decimal(18,2), vendor_id string, contract_id string"),
    "po_line_items": _st("po_line_id bigint, po_id string, commodity_id string, line_number int, quantity double, "
                         "unit_price decimal(18,2), line_amount decimal(18,2)"),
    "spend_transactions": _st("transaction_id bigint, line_number int, vendor_id string, commodity_id string, "
                              "contract_id string, business_unit_id string, po_id string, transaction_date date, "
                              "award_date date, total_amount decimal(18,2), quantity double, "
                              "unit_price decimal(18,2), discount double, fiscal_year int, invoice_date date, "
                              "payment_date date, currency_code string, transaction_type string, fiscal_quarter int"),
    "savings_targets": _st("target_id string, commodity_id string, fiscal_year int, target_amount decimal(18,2), "
                           "target_type string, business_unit_id string, target_percentage double, status string"),
    "demand_forecasts": _st("forecast_id string, commodity_id string, forecast_period_start date, "
                            "forecast_period_end date, forecasted_quantity double, forecasted_value decimal(18,2), "
                            "confidence_level string, business_unit_id string"),
    "risk_assessments": _st("assessment_id string, vendor_id string, risk_type string, risk_level string, "
                            "assessment_date date, status string, commodity_id string"),
    "sourcing_strategies": _st("strategy_id string, commodity_id string, strategy_name string, "
                               "strategy_type string, status string"),
    "market_intelligence": _st("intelligence_id string, commodity_id string, price_trend string, "
                               "market_data string, report_date date, supply_outlook string"),
    "performance_metrics": _st("metric_id string, vendor_id string, metric_type string, metric_name string, "
                               "metric_value double, target_value double, measurement_period_end date, "
                               "commodity_id string"),
}

STAR = {
    "dim_vendors": _st("vendor_key bigint, vendor_id string, vendor_name string, vendor_tier string, "
                       "diversity_classification string, risk_rating string, esg_score double, country string, "
                       "region string, effective_start_date date, effective_end_date date, "
                       "is_current_record boolean, supplier_size string, certification_status string"),
    "dim_commodities": _st("commodity_key bigint, commodity_id string, commodity_description string, "
                           "parent_category string, sub_category string, business_criticality string, "
                           "sourcing_complexity string, category_manager string, effective_start_date date, "
                           "is_current_record boolean, commodity_level int, spend_category string, "
                           "unit_of_measure string"),
    "dim_time": _st("time_key int, date_actual date, year int, quarter int, month int, fiscal_year int, "
                    "fiscal_quarter int, fiscal_month int, month_name string, quarter_name string, "
                    "day_of_week string, day_of_week_num int, week_of_year int, is_weekend boolean, "
                    "is_holiday boolean, holiday_name string"),
    "dim_contracts": _st("contract_key bigint, contract_id string, contract_name string, contract_type string, "
                         "contract_status string, start_date date, end_date date, auto_renewal boolean, "
                         "payment_terms int, currency_code string, risk_level string, effective_start_date date, "
                         "is_current_record boolean"),
    "dim_business_units": _st("business_unit_key bigint, business_unit_id string, business_unit_name string, "
                              "parent_unit_id string, level_in_hierarchy int, effective_start_date date, "
                              "is_current_record boolean, cost_center string, region string, country string, "
                              "manager_name string, budget_amount double"),
    "fact_spend_analytics": _st("fact_key bigint, vendor_key bigint, commodity_key bigint, contract_key bigint, "
                                "business_unit_key bigint, "
                                "time_key int, spend_amount decimal(18,2), transaction_count int, quantity double, "
                                "unit_price decimal(18,2), delivery_performance_score double, quality_score double, "
                                "compliance_score double, risk_weighted_spend decimal(18,3), "
                                "esg_weighted_spend decimal(20,4), savings_amount decimal(18,4), "
                                "baseline_price decimal(18,4), po_cycle_time_days int, "
                                "invoice_processing_time_days int, payment_delay_days int, "
                                "source_transaction_id string, load_date date, carbon_footprint_kg double, "
                                "discount_amount decimal(18,4), source_system string"),
    "fact_supplier_performance": _st("performance_key bigint, vendor_key bigint, time_key int, "
                                     "on_time_delivery_rate double, in_full_delivery_rate double, otif_rate double, "
                                     "defect_rate double, return_rate double, response_time_hours double, "
                                     "resolution_time_hours double, customer_satisfaction_score double, "
                                     "sustainability_score double, diversity_spend_percentage double, "
                                     "load_date date, warranty_claims_count int"),
    "fact_savings_realization": _st("savings_key string, vendor_key bigint, commodity_key bigint, time_key int, fiscal_year int, "
                                    "hard_savings_amount double, soft_savings_amount double, "
                                    "cost_avoidance_amount double, working_capital_improvement double, "
                                    "forecasted_savings double, realized_savings double, load_date date, "
                                    "realization_rate double, initiative_id string, initiative_type string, "
                                    "business_case_reference string"),
}

ALL = {**OPERATIONAL, **STAR}

# Column defaults applied on append (the DDL DEFAULT clauses).
DEFAULTS = {
    "dim_vendors": {"is_current_record": True},
    "dim_commodities": {"is_current_record": True},
    "dim_contracts": {"auto_renewal": False, "is_current_record": True},
    "dim_business_units": {"is_current_record": True},
    "dim_time": {"is_weekend": False, "is_holiday": False},
    "fact_spend_analytics": {"transaction_count": 1, "discount_amount": 0},
    "fact_supplier_performance": {"warranty_claims_count": 0},
    "spend_transactions": {"currency_code": "USD"},
    "contracts": {"currency_code": "USD", "auto_renewal": False},
    "time_periods": {"is_current_period": False},
}
