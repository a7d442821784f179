"""Fixed values of the source's DDL, listed here for the oracle alone: CHECK
rules, keys and foreign keys in source order."""

CHECK_RULES = [
    ('vendors', 'vendor_tier_allowed', "vendor_tier IN ('Strategic', 'Preferred', 'Approved', 'Tactical')"),
    ('contracts', 'contract_type_allowed', "contract_type IN ('MSA', 'SOW', 'PO', 'Framework', 'Spot')"),
    ('contracts', 'contract_status_allowed', "contract_status IN ('Active', 'Expired', 'Terminated', 'Draft')"),
    ('purchase_orders', 'po_status_allowed', "po_status IN ('Draft', 'Approved', 'Sent', 'Acknowledged', 'Delivered', 'Invoiced', 'Paid', 'Cancelled')"),
    ('purchase_orders', 'total_amount_non_negative', 'total_amount >= 0'),
    ('po_line_items', 'quantity_positive', 'quantity > 0'),
    ('po_line_items', 'unit_price_non_negative', 'unit_price >= 0'),
    ('po_line_items', 'line_amount_non_negative', 'line_amount >= 0'),
    ('spend_transactions', 'total_amount_non_negative', 'total_amount >= 0'),
    ('spend_transactions', 'transaction_type_allowed', "transaction_type IN ('PO', 'Invoice', 'Payment', 'Credit')"),
    ('supplier_profiles', 'audit_score_range', 'audit_score >= 0 AND audit_score <= 100'),
    ('supplier_profiles', 'risk_rating_allowed', "risk_rating IN ('Low', 'Medium', 'High', 'Critical')"),
    ('supplier_profiles', 'esg_score_range', 'esg_score >= 0 AND esg_score <= 100'),
    ('commodity_profiles', 'business_criticality_allowed', "business_criticality IN ('Critical', 'High', 'Medium', 'Low')"),
    ('commodity_profiles', 'sourcing_complexity_allowed', "sourcing_complexity IN ('Simple', 'Moderate', 'Complex', 'Strategic')"),
    ('commodity_profiles', 'market_volatility_allowed', "market_volatility IN ('Low', 'Medium', 'High')"),
    ('commodity_profiles', 'supply_risk_allowed', "supply_risk IN ('Low', 'Medium', 'High')"),
    ('sourcing_strategies', 'strategy_type_allowed', "strategy_type IN ('Single Source', 'Multi Source', 'Sole Source', 'Competitive')"),
    ('sourcing_strategies', 'status_allowed', "status IN ('Active', 'Under Review', 'Deprecated')"),
    ('time_periods', 'fiscal_quarter_range', 'fiscal_quarter >= 1 AND fiscal_quarter <= 4'),
    ('time_periods', 'fiscal_month_range', 'fiscal_month >= 1 AND fiscal_month <= 12'),
    ('savings_targets', 'target_amount_non_negative', 'target_amount >= 0'),
    ('savings_targets', 'target_percentage_range', 'target_percentage >= 0 AND target_percentage <= 100'),
    ('savings_targets', 'target_type_allowed', "target_type IN ('Hard Savings', 'Soft Savings', 'Cost Avoidance')"),
    ('savings_targets', 'status_allowed', "status IN ('Draft', 'Approved', 'Active', 'Achieved', 'Missed')"),
    ('demand_forecasts', 'forecasted_quantity_non_negative', 'forecasted_quantity >= 0'),
    ('demand_forecasts', 'forecasted_value_non_negative', 'forecasted_value >= 0'),
    ('demand_forecasts', 'confidence_level_allowed', "confidence_level IN ('High', 'Medium', 'Low')"),
    ('risk_assessments', 'risk_type_allowed', "risk_type IN ('Financial', 'Operational', 'Strategic', 'Compliance', 'ESG', 'Cyber')"),
    ('risk_assessments', 'risk_level_allowed', "risk_level IN ('Low', 'Medium', 'High', 'Critical')"),
    ('risk_assessments', 'status_allowed', "status IN ('Open', 'Mitigated', 'Accepted', 'Transferred')"),
    ('market_intelligence', 'price_trend_allowed', "price_trend IN ('Increasing', 'Stable', 'Decreasing', 'Volatile')"),
    ('market_intelligence', 'supply_outlook_allowed', "supply_outlook IN ('Abundant', 'Adequate', 'Tight', 'Shortage')"),
    ('performance_metrics', 'metric_type_allowed', "metric_type IN ('Delivery', 'Quality', 'Service', 'Cost', 'Innovation')"),
    ('dim_vendors', 'vendor_tier_allowed', "vendor_tier IN ('Strategic', 'Preferred', 'Approved', 'Tactical')"),
    ('dim_vendors', 'risk_rating_allowed', "risk_rating IN ('Low', 'Medium', 'High', 'Critical')"),
    ('dim_vendors', 'esg_score_range', 'esg_score >= 0 AND esg_score <= 100'),
    ('dim_vendors', 'supplier_size_allowed', "supplier_size IN ('SME', 'Large', 'Enterprise')"),
    ('dim_commodities', 'business_criticality_allowed', "business_criticality IN ('Critical', 'High', 'Medium', 'Low')"),
    ('dim_commodities', 'sourcing_complexity_allowed', "sourcing_complexity IN ('Simple', 'Moderate', 'Complex', 'Strategic')"),
    ('dim_time', 'quarter_range', 'quarter >= 1 AND quarter <= 4'),
    ('dim_time', 'month_range', 'month >= 1 AND month <= 12'),
    ('dim_time', 'fiscal_quarter_range', 'fiscal_quarter >= 1 AND fiscal_quarter <= 4'),
    ('dim_time', 'day_of_week_num_range', 'day_of_week_num >= 1 AND day_of_week_num <= 7'),
    ('dim_time', 'week_of_year_range', 'week_of_year >= 0 AND week_of_year <= 53'),
    ('dim_contracts', 'contract_type_allowed', "contract_type IN ('MSA', 'SOW', 'PO', 'Framework', 'Spot')"),
    ('dim_contracts', 'contract_status_allowed', "contract_status IN ('Active', 'Expired', 'Terminated', 'Draft')"),
    ('dim_contracts', 'risk_level_allowed', "risk_level IN ('Low', 'Medium', 'High')"),
    ('fact_spend_analytics', 'spend_amount_non_negative', 'spend_amount >= 0'),
    ('fact_spend_analytics', 'transaction_count_positive', 'transaction_count > 0'),
    ('fact_spend_analytics', 'quantity_non_negative', 'quantity >= 0'),
    ('fact_spend_analytics', 'unit_price_non_negative', 'unit_price >= 0'),
    ('fact_spend_analytics', 'delivery_performance_score_range', 'delivery_performance_score >= 0 AND delivery_performance_score <= 100'),
    ('fact_spend_analytics', 'quality_score_range', 'quality_score >= 0 AND quality_score <= 100'),
    ('fact_spend_analytics', 'compliance_score_range', 'compliance_score >= 0 AND compliance_score <= 100'),
    ('fact_spend_analytics', 'risk_weighted_spend_non_negative', 'risk_weighted_spend >= 0'),
    ('fact_spend_analytics', 'esg_weighted_spend_non_negative', 'esg_weighted_spend >= 0'),
    ('fact_spend_analytics', 'carbon_footprint_kg_non_negative', 'carbon_footprint_kg >= 0'),
    ('fact_spend_analytics', 'baseline_price_non_negative', 'baseline_price >= 0'),
    ('fact_spend_analytics', 'po_cycle_time_days_non_negative', 'po_cycle_time_days >= 0'),
    ('fact_spend_analytics', 'invoice_processing_time_days_non_negative', 'invoice_processing_time_days >= 0'),
    ('fact_supplier_performance', 'on_time_delivery_rate_range', 'on_time_delivery_rate >= 0 AND on_time_delivery_rate <= 100'),
    ('fact_supplier_performance', 'in_full_delivery_rate_range', 'in_full_delivery_rate >= 0 AND in_full_delivery_rate <= 100'),
    ('fact_supplier_performance', 'otif_rate_range', 'otif_rate >= 0 AND otif_rate <= 100'),
    ('fact_supplier_performance', 'defect_rate_range', 'defect_rate >= 0 AND defect_rate <= 100'),
    ('fact_supplier_performance', 'return_rate_range', 'return_rate >= 0 AND return_rate <= 100'),
    ('fact_supplier_performance', 'response_time_hours_non_negative', 'response_time_hours >= 0'),
    ('fact_supplier_performance', 'resolution_time_hours_non_negative', 'resolution_time_hours >= 0'),
    ('fact_supplier_performance', 'customer_satisfaction_score_range', 'customer_satisfaction_score >= 0 AND customer_satisfaction_score <= 10'),
    ('fact_supplier_performance', 'sustainability_score_range', 'sustainability_score >= 0 AND sustainability_score <= 100'),
    ('fact_supplier_performance', 'diversity_spend_percentage_range', 'diversity_spend_percentage >= 0 AND diversity_spend_percentage <= 100'),
    ('fact_spend_analytics', 'time_key_format', 'time_key >= 20090101 AND time_key <= 99991231'),
    ('po_line_items', 'line_amount_matches', 'abs(line_amount - quantity * unit_price) <= 0.01'),
]

KEYS = [
    ('vendors', ('vendor_id',)),
    ('commodities', ('commodity_id',)),
    ('business_units', ('business_unit_id',)),
    ('contracts', ('contract_id',)),
    ('purchase_orders', ('po_id',)),
    ('po_line_items', ('po_line_id',)),
    ('po_line_items', ('po_id', 'line_number')),
    ('spend_transactions', ('transaction_id',)),
    ('supplier_profiles', ('vendor_id',)),
    ('commodity_profiles', ('commodity_id',)),
    ('sourcing_strategies', ('strategy_id',)),
    ('time_periods', ('period_id',)),
    ('savings_targets', ('target_id',)),
    ('demand_forecasts', ('forecast_id',)),
    ('risk_assessments', ('assessment_id',)),
    ('market_intelligence', ('intelligence_id',)),
    ('performance_metrics', ('metric_id',)),
    ('dim_vendors', ('vendor_key',)),
    ('dim_commodities', ('commodity_key',)),
    ('dim_time', ('time_key',)),
    ('dim_time', ('date_actual',)),
    ('dim_contracts', ('contract_key',)),
    ('dim_business_units', ('business_unit_key',)),
    ('fact_spend_analytics', ('fact_key',)),
    ('fact_supplier_performance', ('performance_key',)),
    ('fact_savings_realization', ('savings_key',)),
]

FOREIGN_KEYS = [
    ('business_units', 'parent_unit_id', 'business_units', 'business_unit_id'),
    ('contracts', 'vendor_id', 'vendors', 'vendor_id'),
    ('purchase_orders', 'vendor_id', 'vendors', 'vendor_id'),
    ('purchase_orders', 'contract_id', 'contracts', 'contract_id'),
    ('purchase_orders', 'business_unit_id', 'business_units', 'business_unit_id'),
    ('po_line_items', 'po_id', 'purchase_orders', 'po_id'),
    ('po_line_items', 'commodity_id', 'commodities', 'commodity_id'),
    ('spend_transactions', 'vendor_id', 'vendors', 'vendor_id'),
    ('spend_transactions', 'commodity_id', 'commodities', 'commodity_id'),
    ('spend_transactions', 'contract_id', 'contracts', 'contract_id'),
    ('spend_transactions', 'business_unit_id', 'business_units', 'business_unit_id'),
    ('spend_transactions', 'po_id', 'purchase_orders', 'po_id'),
    ('supplier_profiles', 'vendor_id', 'vendors', 'vendor_id'),
    ('commodity_profiles', 'commodity_id', 'commodities', 'commodity_id'),
    ('sourcing_strategies', 'commodity_id', 'commodities', 'commodity_id'),
    ('savings_targets', 'commodity_id', 'commodities', 'commodity_id'),
    ('savings_targets', 'business_unit_id', 'business_units', 'business_unit_id'),
    ('demand_forecasts', 'commodity_id', 'commodities', 'commodity_id'),
    ('demand_forecasts', 'business_unit_id', 'business_units', 'business_unit_id'),
    ('risk_assessments', 'vendor_id', 'vendors', 'vendor_id'),
    ('risk_assessments', 'commodity_id', 'commodities', 'commodity_id'),
    ('market_intelligence', 'commodity_id', 'commodities', 'commodity_id'),
    ('performance_metrics', 'vendor_id', 'vendors', 'vendor_id'),
    ('performance_metrics', 'commodity_id', 'commodities', 'commodity_id'),
    ('fact_spend_analytics', 'vendor_key', 'dim_vendors', 'vendor_key'),
    ('fact_spend_analytics', 'commodity_key', 'dim_commodities', 'commodity_key'),
    ('fact_spend_analytics', 'contract_key', 'dim_contracts', 'contract_key'),
    ('fact_spend_analytics', 'time_key', 'dim_time', 'time_key'),
    ('fact_spend_analytics', 'business_unit_key', 'dim_business_units', 'business_unit_key'),
    ('fact_supplier_performance', 'vendor_key', 'dim_vendors', 'vendor_key'),
    ('fact_supplier_performance', 'time_key', 'dim_time', 'time_key'),
    ('fact_savings_realization', 'vendor_key', 'dim_vendors', 'vendor_key'),
    ('fact_savings_realization', 'commodity_key', 'dim_commodities', 'commodity_key'),
    ('fact_savings_realization', 'time_key', 'dim_time', 'time_key'),
]

# NOT NULL columns of the DDL that are no keys, by table.
NOT_NULL = [
    ('vendors', ['vendor_name']),
    ('commodities', ['commodity_description']),
    ('business_units', ['business_unit_name']),
    ('contracts', ['vendor_id']),
    ('purchase_orders', ['vendor_id', 'po_date', 'total_amount']),
    ('po_line_items', ['po_id', 'commodity_id', 'line_number', 'quantity', 'unit_price', 'line_amount']),
    ('spend_transactions', ['vendor_id', 'commodity_id', 'transaction_date', 'total_amount']),
    ('sourcing_strategies', ['commodity_id', 'strategy_name']),
    ('time_periods', ['period_name', 'start_date', 'end_date', 'fiscal_year']),
    ('savings_targets', ['fiscal_year', 'target_amount']),
    ('demand_forecasts', ['commodity_id', 'forecast_period_start', 'forecast_period_end']),
    ('risk_assessments', ['assessment_date']),
    ('market_intelligence', ['commodity_id', 'report_date']),
    ('performance_metrics', ['metric_name']),
    ('dim_vendors', ['vendor_id', 'vendor_name', 'effective_start_date', 'is_current_record']),
    ('dim_commodities', ['commodity_id', 'commodity_description', 'effective_start_date', 'is_current_record']),
    ('dim_time', ['date_actual', 'year', 'quarter', 'month', 'fiscal_year', 'fiscal_quarter', 'fiscal_month', 'month_name', 'quarter_name', 'day_of_week', 'day_of_week_num', 'week_of_year', 'is_weekend']),
    ('dim_contracts', ['contract_id', 'effective_start_date', 'is_current_record']),
    ('dim_business_units', ['business_unit_id', 'business_unit_name', 'effective_start_date', 'is_current_record']),
    ('fact_spend_analytics', ['vendor_key', 'commodity_key', 'time_key', 'spend_amount', 'load_date']),
    ('fact_supplier_performance', ['vendor_key', 'time_key', 'load_date']),
    ('fact_savings_realization', ['vendor_key', 'commodity_key', 'time_key', 'forecasted_savings', 'realized_savings', 'load_date']),
]
