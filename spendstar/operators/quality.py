"""Data quality, reconciliation and health checks.

Every check returns a small DataFrame (counts and statuses); nothing is
collected to the driver. Counts over large tables are single aggregates, so
each table is scanned once per check with map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.agg import dec
from .dims import calendar
from .profile import profile

# --------------------------------------------------------------------------
# CHECK rules of the source DDL, as (table, rule name, SQL
# predicate). NULL passes a CHECK. week_of_year is relaxed to 0..53 (week
# numbers start at 0 before the first Monday). Trigger rules at the end.
CHECK_RULES: list[tuple[str, str, str]] = [
    ("vendors", "vendor_tier_allowed", "vendor_tier IN ('Strategic', 'Preferred', 'Approved', 'Tactical')"),
    ("contracts", "contract_type_allowed", "contract_type IN ('MSA', 'SOW', 'PO', 'Framework', 'Spot')"),
    ("contracts", "contract_status_allowed", "contract_status IN ('Active', 'Expired', 'Terminated', 'Draft')"),
    ("purchase_orders", "po_status_allowed", "po_status IN ('Draft', 'Approved', 'Sent', 'Acknowledged', 'Delivered', 'Invoiced', 'Paid', 'Cancelled')"),
    ("purchase_orders", "total_amount_non_negative", "total_amount >= 0"),
    ("po_line_items", "quantity_positive", "quantity > 0"),
    ("po_line_items", "unit_price_non_negative", "unit_price >= 0"),
    ("po_line_items", "line_amount_non_negative", "line_amount >= 0"),
    ("spend_transactions", "total_amount_non_negative", "total_amount >= 0"),
    ("spend_transactions", "transaction_type_allowed", "transaction_type IN ('PO', 'Invoice', 'Payment', 'Credit')"),
    ("supplier_profiles", "audit_score_range", "audit_score >= 0 AND audit_score <= 100"),
    ("supplier_profiles", "risk_rating_allowed", "risk_rating IN ('Low', 'Medium', 'High', 'Critical')"),
    ("supplier_profiles", "esg_score_range", "esg_score >= 0 AND esg_score <= 100"),
    ("commodity_profiles", "business_criticality_allowed", "business_criticality IN ('Critical', 'High', 'Medium', 'Low')"),
    ("commodity_profiles", "sourcing_complexity_allowed", "sourcing_complexity IN ('Simple', 'Moderate', 'Complex', 'Strategic')"),
    ("commodity_profiles", "market_volatility_allowed", "market_volatility IN ('Low', 'Medium', 'High')"),
    ("commodity_profiles", "supply_risk_allowed", "supply_risk IN ('Low', 'Medium', 'High')"),
    ("sourcing_strategies", "strategy_type_allowed", "strategy_type IN ('Single Source', 'Multi Source', 'Sole Source', 'Competitive')"),
    ("sourcing_strategies", "status_allowed", "status IN ('Active', 'Under Review', 'Deprecated')"),
    ("time_periods", "fiscal_quarter_range", "fiscal_quarter >= 1 AND fiscal_quarter <= 4"),
    ("time_periods", "fiscal_month_range", "fiscal_month >= 1 AND fiscal_month <= 12"),
    ("savings_targets", "target_amount_non_negative", "target_amount >= 0"),
    ("savings_targets", "target_percentage_range", "target_percentage >= 0 AND target_percentage <= 100"),
    ("savings_targets", "target_type_allowed", "target_type IN ('Hard Savings', 'Soft Savings', 'Cost Avoidance')"),
    ("savings_targets", "status_allowed", "status IN ('Draft', 'Approved', 'Active', 'Achieved', 'Missed')"),
    ("demand_forecasts", "forecasted_quantity_non_negative", "forecasted_quantity >= 0"),
    ("demand_forecasts", "forecasted_value_non_negative", "forecasted_value >= 0"),
    ("demand_forecasts", "confidence_level_allowed", "confidence_level IN ('High', 'Medium', 'Low')"),
    ("risk_assessments", "risk_type_allowed", "risk_type IN ('Financial', 'Operational', 'Strategic', 'Compliance', 'ESG', 'Cyber')"),
    ("risk_assessments", "risk_level_allowed", "risk_level IN ('Low', 'Medium', 'High', 'Critical')"),
    ("risk_assessments", "status_allowed", "status IN ('Open', 'Mitigated', 'Accepted', 'Transferred')"),
    ("market_intelligence", "price_trend_allowed", "price_trend IN ('Increasing', 'Stable', 'Decreasing', 'Volatile')"),
    ("market_intelligence", "supply_outlook_allowed", "supply_outlook IN ('Abundant', 'Adequate', 'Tight', 'Shortage')"),
    ("performance_metrics", "metric_type_allowed", "metric_type IN ('Delivery', 'Quality', 'Service', 'Cost', 'Innovation')"),
    ("dim_vendors", "vendor_tier_allowed", "vendor_tier IN ('Strategic', 'Preferred', 'Approved', 'Tactical')"),
    ("dim_vendors", "risk_rating_allowed", "risk_rating IN ('Low', 'Medium', 'High', 'Critical')"),
    ("dim_vendors", "esg_score_range", "esg_score >= 0 AND esg_score <= 100"),
    ("dim_vendors", "supplier_size_allowed", "supplier_size IN ('SME', 'Large', 'Enterprise')"),
    ("dim_commodities", "business_criticality_allowed", "business_criticality IN ('Critical', 'High', 'Medium', 'Low')"),
    ("dim_commodities", "sourcing_complexity_allowed", "sourcing_complexity IN ('Simple', 'Moderate', 'Complex', 'Strategic')"),
    ("dim_time", "quarter_range", "quarter >= 1 AND quarter <= 4"),
    ("dim_time", "month_range", "month >= 1 AND month <= 12"),
    ("dim_time", "fiscal_quarter_range", "fiscal_quarter >= 1 AND fiscal_quarter <= 4"),
    ("dim_time", "day_of_week_num_range", "day_of_week_num >= 1 AND day_of_week_num <= 7"),
    ("dim_time", "week_of_year_range", "week_of_year >= 0 AND week_of_year <= 53"),
    ("dim_contracts", "contract_type_allowed", "contract_type IN ('MSA', 'SOW', 'PO', 'Framework', 'Spot')"),
    ("dim_contracts", "contract_status_allowed", "contract_status IN ('Active', 'Expired', 'Terminated', 'Draft')"),
    ("dim_contracts", "risk_level_allowed", "risk_level IN ('Low', 'Medium', 'High')"),
    ("fact_spend_analytics", "spend_amount_non_negative", "spend_amount >= 0"),
    ("fact_spend_analytics", "transaction_count_positive", "transaction_count > 0"),
    ("fact_spend_analytics", "quantity_non_negative", "quantity >= 0"),
    ("fact_spend_analytics", "unit_price_non_negative", "unit_price >= 0"),
    ("fact_spend_analytics", "delivery_performance_score_range", "delivery_performance_score >= 0 AND delivery_performance_score <= 100"),
    ("fact_spend_analytics", "quality_score_range", "quality_score >= 0 AND quality_score <= 100"),
    ("fact_spend_analytics", "compliance_score_range", "compliance_score >= 0 AND compliance_score <= 100"),
    ("fact_spend_analytics", "risk_weighted_spend_non_negative", "risk_weighted_spend >= 0"),
    ("fact_spend_analytics", "esg_weighted_spend_non_negative", "esg_weighted_spend >= 0"),
    ("fact_spend_analytics", "carbon_footprint_kg_non_negative", "carbon_footprint_kg >= 0"),
    ("fact_spend_analytics", "baseline_price_non_negative", "baseline_price >= 0"),
    ("fact_spend_analytics", "po_cycle_time_days_non_negative", "po_cycle_time_days >= 0"),
    ("fact_spend_analytics", "invoice_processing_time_days_non_negative", "invoice_processing_time_days >= 0"),
    ("fact_supplier_performance", "on_time_delivery_rate_range", "on_time_delivery_rate >= 0 AND on_time_delivery_rate <= 100"),
    ("fact_supplier_performance", "in_full_delivery_rate_range", "in_full_delivery_rate >= 0 AND in_full_delivery_rate <= 100"),
    ("fact_supplier_performance", "otif_rate_range", "otif_rate >= 0 AND otif_rate <= 100"),
    ("fact_supplier_performance", "defect_rate_range", "defect_rate >= 0 AND defect_rate <= 100"),
    ("fact_supplier_performance", "return_rate_range", "return_rate >= 0 AND return_rate <= 100"),
    ("fact_supplier_performance", "response_time_hours_non_negative", "response_time_hours >= 0"),
    ("fact_supplier_performance", "resolution_time_hours_non_negative", "resolution_time_hours >= 0"),
    ("fact_supplier_performance", "customer_satisfaction_score_range", "customer_satisfaction_score >= 0 AND customer_satisfaction_score <= 10"),
    ("fact_supplier_performance", "sustainability_score_range", "sustainability_score >= 0 AND sustainability_score <= 100"),
    ("fact_supplier_performance", "diversity_spend_percentage_range", "diversity_spend_percentage >= 0 AND diversity_spend_percentage <= 100"),
    # trigger rules
    ("fact_spend_analytics", "time_key_format", "time_key >= 20090101 AND time_key <= 99991231"),
    ("po_line_items", "line_amount_matches", "abs(line_amount - quantity * unit_price) <= 0.01"),
]

# Trigger messages of the source system, raised in strict mode.
TRIGGER_MESSAGES = {
    ("fact_spend_analytics", "time_key_format"): "Invalid time_key format. Must be YYYYMMDD.",
    ("fact_spend_analytics", "spend_amount_non_negative"): "Spend amount cannot be negative.",
    ("po_line_items", "line_amount_matches"): "Line amount must equal quantity * unit_price",
}

# Primary keys / unique keys of the DDL.
KEYS: list[tuple[str, tuple[str, ...]]] = [
    ("vendors", ("vendor_id",)), ("commodities", ("commodity_id",)), ("business_units", ("business_unit_id",)),
    ("contracts", ("contract_id",)), ("purchase_orders", ("po_id",)), ("po_line_items", ("po_line_id",)),
    ("po_line_items", ("po_id", "line_number")), ("spend_transactions", ("transaction_id",)),
    ("supplier_profiles", ("vendor_id",)), ("commodity_profiles", ("commodity_id",)),
    ("sourcing_strategies", ("strategy_id",)), ("time_periods", ("period_id",)), ("savings_targets", ("target_id",)),
    ("demand_forecasts", ("forecast_id",)), ("risk_assessments", ("assessment_id",)),
    ("market_intelligence", ("intelligence_id",)), ("performance_metrics", ("metric_id",)),
    ("dim_vendors", ("vendor_key",)), ("dim_commodities", ("commodity_key",)), ("dim_time", ("time_key",)),
    ("dim_time", ("date_actual",)), ("dim_contracts", ("contract_key",)),
    ("dim_business_units", ("business_unit_key",)), ("fact_spend_analytics", ("fact_key",)),
    ("fact_supplier_performance", ("performance_key",)), ("fact_savings_realization", ("savings_key",)),
]

# NOT NULL columns of the DDL that are no keys, by table.
NOT_NULL: list[tuple[str, tuple[str, ...]]] = [
    ("vendors", ("vendor_name",)),
    ("commodities", ("commodity_description",)),
    ("business_units", ("business_unit_name",)),
    ("contracts", ("vendor_id",)),
    ("purchase_orders", ("vendor_id", "po_date", "total_amount")),
    ("po_line_items", ("po_id", "commodity_id", "line_number", "quantity", "unit_price", "line_amount")),
    ("spend_transactions", ("vendor_id", "commodity_id", "transaction_date", "total_amount")),
    ("sourcing_strategies", ("commodity_id", "strategy_name")),
    ("time_periods", ("period_name", "start_date", "end_date", "fiscal_year")),
    ("savings_targets", ("fiscal_year", "target_amount")),
    ("demand_forecasts", ("commodity_id", "forecast_period_start", "forecast_period_end")),
    ("risk_assessments", ("assessment_date",)),
    ("market_intelligence", ("commodity_id", "report_date")),
    ("performance_metrics", ("metric_name",)),
    ("dim_vendors", ("vendor_id", "vendor_name", "effective_start_date", "is_current_record")),
    ("dim_commodities", ("commodity_id", "commodity_description", "effective_start_date", "is_current_record")),
    ("dim_time", ("date_actual", "year", "quarter", "month", "fiscal_year", "fiscal_quarter", "fiscal_month", "month_name", "quarter_name", "day_of_week", "day_of_week_num", "week_of_year", "is_weekend")),
    ("dim_contracts", ("contract_id", "effective_start_date", "is_current_record")),
    ("dim_business_units", ("business_unit_id", "business_unit_name", "effective_start_date", "is_current_record")),
    ("fact_spend_analytics", ("vendor_key", "commodity_key", "time_key", "spend_amount", "load_date")),
    ("fact_supplier_performance", ("vendor_key", "time_key", "load_date")),
    ("fact_savings_realization", ("vendor_key", "commodity_key", "time_key", "forecasted_savings", "realized_savings", "load_date")),
]

# Foreign keys (child table, column, parent table, column).
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("business_units", "parent_unit_id", "business_units", "business_unit_id"),
    ("contracts", "vendor_id", "vendors", "vendor_id"),
    ("purchase_orders", "vendor_id", "vendors", "vendor_id"),
    ("purchase_orders", "contract_id", "contracts", "contract_id"),
    ("purchase_orders", "business_unit_id", "business_units", "business_unit_id"),
    ("po_line_items", "po_id", "purchase_orders", "po_id"),
    ("po_line_items", "commodity_id", "commodities", "commodity_id"),
    ("spend_transactions", "vendor_id", "vendors", "vendor_id"),
    ("spend_transactions", "commodity_id", "commodities", "commodity_id"),
    ("spend_transactions", "contract_id", "contracts", "contract_id"),
    ("spend_transactions", "business_unit_id", "business_units", "business_unit_id"),
    ("spend_transactions", "po_id", "purchase_orders", "po_id"),
    ("supplier_profiles", "vendor_id", "vendors", "vendor_id"),
    ("commodity_profiles", "commodity_id", "commodities", "commodity_id"),
    ("sourcing_strategies", "commodity_id", "commodities", "commodity_id"),
    ("savings_targets", "commodity_id", "commodities", "commodity_id"),
    ("savings_targets", "business_unit_id", "business_units", "business_unit_id"),
    ("demand_forecasts", "commodity_id", "commodities", "commodity_id"),
    ("demand_forecasts", "business_unit_id", "business_units", "business_unit_id"),
    ("risk_assessments", "vendor_id", "vendors", "vendor_id"),
    ("risk_assessments", "commodity_id", "commodities", "commodity_id"),
    ("market_intelligence", "commodity_id", "commodities", "commodity_id"),
    ("performance_metrics", "vendor_id", "vendors", "vendor_id"),
    ("performance_metrics", "commodity_id", "commodities", "commodity_id"),
    ("fact_spend_analytics", "vendor_key", "dim_vendors", "vendor_key"),
    ("fact_spend_analytics", "commodity_key", "dim_commodities", "commodity_key"),
    ("fact_spend_analytics", "contract_key", "dim_contracts", "contract_key"),
    ("fact_spend_analytics", "time_key", "dim_time", "time_key"),
    ("fact_spend_analytics", "business_unit_key", "dim_business_units", "business_unit_key"),
    ("fact_supplier_performance", "vendor_key", "dim_vendors", "vendor_key"),
    ("fact_supplier_performance", "time_key", "dim_time", "time_key"),
    ("fact_savings_realization", "vendor_key", "dim_vendors", "vendor_key"),
    ("fact_savings_realization", "commodity_key", "dim_commodities", "commodity_key"),
    ("fact_savings_realization", "time_key", "dim_time", "time_key"),
]

# Tables the health check requires.
REQUIRED_STAR = ["dim_vendors", "dim_commodities", "dim_time", "fact_spend_analytics"]
REQUIRED_OPERATIONAL = ["vendors", "spend_transactions", "contracts", "commodities"]


class CheckViolation(Exception):
    """Raised by strict mode when a rule fails (the source aborts the insert)."""


def _columns_of(sql: str) -> set[str]:
    import re
    words = set(re.findall(r"\b[a-z_][a-z0-9_]*\b", re.sub(r"'[^']*'", "", sql)))
    return words - {"in", "and", "or", "abs", "not", "null", "is"}


def rules_for(table: str, df: DataFrame) -> list[tuple[str, str]]:
    """Rules of ``table`` whose columns are all present in ``df``."""
    cols = set(df.columns)
    return [(name, sql) for t, name, sql in CHECK_RULES if t == table and _columns_of(sql) <= cols]


def tag_failures(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``df`` with ``failed_rules``: the names of the rules that each row fails."""
    fails = [F.when(~F.coalesce(F.expr(sql), F.lit(True)), F.lit(name)) for name, sql in rules]
    return df.withColumn("failed_rules", F.filter(F.array(*fails), lambda x: x.isNotNull()) if fails
                         else F.array().cast("array<string>"))


def apply_checks(df: DataFrame, rules: Sequence[tuple[str, str]], strict: bool = False,
                 table: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Q9/Q12: split ``df`` into (valid, rejected). A rule holds when its
    predicate is true or NULL. Rejected rows carry ``failed_rules`` (array of
    rule names). ``strict=True`` raises on the first failing rule instead
    (one aggregate over ``df``; only counts reach the driver)."""
    tagged = tag_failures(df, rules)
    if strict and rules:
        counts = violation_counts(df, rules).filter(F.col("violations") > 0).take(1)
        if counts:
            name = counts[0]["rule_name"]
            raise CheckViolation(TRIGGER_MESSAGES.get((table, name), f"CHECK constraint failed: {name}"))
    valid = tagged.filter(F.size("failed_rules") == 0).drop("failed_rules")
    rejected = tagged.filter(F.size("failed_rules") > 0)
    return valid, rejected


def violation_counts(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(rule_name, violations) for every rule, from one aggregate pass."""
    aggs = [F.count(F.when(~F.coalesce(F.expr(sql), F.lit(True)), 1)).alias(f"r{i}") for i, (_, sql) in enumerate(rules)]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{name}', r{i}" for i, (name, _) in enumerate(rules))
    return wide.selectExpr(f"stack({len(rules)}, {pairs}) as (rule_name, violations)")


#: Status of a declared check: it ran, or what it needs is not there.
CHECKED, NO_TABLE, NO_COLUMN = "CHECKED", "TABLE_MISSING", "COLUMN_MISSING"


def _absent(T: Mapping[str, DataFrame], rows: Sequence[tuple], columns: str, counts: Sequence[str]) -> DataFrame:
    """Rows of checks that cannot run, with NULL counts."""
    out = T[next(iter(T))].sparkSession.createDataFrame(list(rows), columns)
    return out.withColumns({c: F.lit(None).cast("long") for c in counts})


def declared(T: Mapping[str, DataFrame]) -> tuple[dict, dict]:
    """The declared checks that can run, as arguments of ``profile``, and the
    status of those that cannot."""
    rules, nulls, keys, references, absent = [], [], [], [], {"rules": [], "nulls": [], "keys": [], "references": []}
    have = {t: set(T[t].columns) for t in T}

    def status(table, columns):
        return NO_TABLE if table not in have else CHECKED if columns <= have[table] else NO_COLUMN

    for table, name, sql in CHECK_RULES:
        state = status(table, _columns_of(sql))
        rules.append((table, name, sql)) if state == CHECKED else absent["rules"].append((table, name, state))
    for table, columns in NOT_NULL:
        state = {c: status(table, {c}) for c in columns}
        nulls.append((table, [c for c in columns if state[c] == CHECKED]))
        absent["nulls"] += [(table, c, state[c]) for c in columns if state[c] != CHECKED]
    for table, key in KEYS:
        state = status(table, set(key))
        keys.append((table, key)) if state == CHECKED else absent["keys"].append((table, ",".join(key), state))
    for c, col, p, pcol in FOREIGN_KEYS:
        state = status(c, {col}) if status(c, {col}) != CHECKED else status(p, {pcol})
        references.append((c, col, p, pcol)) if state == CHECKED else absent["references"].append((c, col, p, pcol, state))
    return {"rules": rules, "nulls": [(t, c) for t, c in nulls if c], "keys": keys, "references": references}, absent


def quality_profile(T: Mapping[str, DataFrame]) -> DataFrame:
    """Everything that Q9, Q10, Q11 and the alerts (M5) count, from one scan
    of each table; give it to those operators (stored or not)."""
    return profile(T, **declared(T)[0], totals=ALERT_TOTALS)


# What the alerts need beside the rules: (table, rows to count, column to sum).
ALERT_TOTALS = [("vendors", ["is_active"], None), ("dim_vendors", ["is_current_record"], None),
                ("spend_transactions", [], "total_amount"), ("fact_spend_analytics", [], "spend_amount")]


def dq_check_violations(T: Mapping[str, DataFrame], of: DataFrame | None = None) -> DataFrame:
    """Q9: one row per declared rule: (table_name, rule_name, status,
    violations). Each table is read once for all its rules, or not at all with
    a profile. A rule whose table or column is absent has a status that says so
    and NULL violations."""
    can, absent = declared(T)
    of = profile(T, rules=can["rules"]) if of is None else of
    ran = of.filter("kind = 'rule'").select("table_name", F.col("name").alias("rule_name"), F.lit(CHECKED).alias("status"),
                                            F.col("n").alias("violations"))
    return ran.unionByName(_absent(T, absent["rules"], "table_name string, rule_name string, status string", ["violations"]))


def check_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Q10: one row: rows, rows with a NULL key column, key values occurring
    more than once, and rows in such groups. One scan and one shuffle: the
    per-key counts are combined map-side (a key repeated very often costs one
    row per task), then summed."""
    key = list(key)
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    null_group = None
    for k in key:
        null_group = F.col(k).isNull() if null_group is None else (null_group | F.col(k).isNull())
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("row_count"),
        F.coalesce(F.sum(F.when(null_group, F.col("_n"))), F.lit(0)).cast("long").alias("null_key_rows"),
        F.count(F.when(F.col("_n") > 1, 1)).alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).cast("long").alias("duplicate_rows"))


def dq_duplicate_keys(T: Mapping[str, DataFrame], of: DataFrame | None = None) -> DataFrame:
    """Q10: one row per declared key: (table_name, key_columns, status, counts
    as in ``check_keys``). All keys are grouped in one pass, or read from a
    profile; a key whose table or column is absent has a status that says so
    and NULL counts."""
    can, absent = declared(T)
    of = profile(T, keys=can["keys"]) if of is None else of
    counts = {"rows": "row_count", "null_rows": "null_key_rows", "groups": "duplicate_groups", "group_rows": "duplicate_rows"}
    ran = of.filter(F.col("kind").isin(*counts) & (F.col("name") != "")).groupBy("table_name", F.col("name").alias("key_columns")).agg(
        F.lit(CHECKED).alias("status"), *[F.max(F.when(F.col("kind") == k, F.col("n"))).alias(c) for k, c in counts.items()])
    return ran.unionByName(_absent(T, absent["keys"], "table_name string, key_columns string, status string", list(counts.values())))


def dq_null_columns(T: Mapping[str, DataFrame], of: DataFrame | None = None) -> DataFrame:
    """Q10: one row per declared NOT NULL column (those of the keys are in
    ``dq_duplicate_keys``): (table_name, column_name, status, null_rows). Each
    table is read once for all its columns, or not at all with a profile."""
    can, absent = declared(T)
    of = profile(T, nulls=can["nulls"]) if of is None else of
    ran = of.filter("kind = 'null'").select("table_name", F.col("name").alias("column_name"), F.lit(CHECKED).alias("status"),
                                            F.col("n").alias("null_rows"))
    return ran.unionByName(_absent(T, absent["nulls"], "table_name string, column_name string, status string", ["null_rows"]))


def check_fk(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Q11: child rows whose non-NULL ``col`` has no parent row."""
    keys = parent.select(F.col(parent_col).alias(col)).filter(F.col(col).isNotNull())
    return child.filter(F.col(col).isNotNull()).join(keys, col, "left_anti")


def dq_fk_violations(T: Mapping[str, DataFrame], of: DataFrame | None = None) -> DataFrame:
    """Q11: one row per declared foreign key: (child_table, child_column,
    parent_table, parent_column, status, violations).

    Every table is read once: its references and the keys that they refer to
    are grouped together by value, and references to values without a row are
    the violations (``profile``). A key whose table or column is absent has a
    status that says so and NULL violations."""
    can, absent = declared(T)
    of = profile(T, references=can["references"]) if of is None else of
    parts = F.split("name", "[>.]")
    ran = of.filter("kind = 'reference'").select(
        F.col("table_name").alias("child_table"), F.get(parts, F.lit(0)).alias("child_column"),
        F.get(parts, F.lit(1)).alias("parent_table"), F.get(parts, F.lit(2)).alias("parent_column"),
        F.lit(CHECKED).alias("status"), F.col("n").alias("violations"))
    columns = "child_table string, child_column string, parent_table string, parent_column string, status string"
    return ran.unionByName(_absent(T, absent["references"], columns, ["violations"]))


def po_line_amount_violations(po_lines: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Q12: PO lines whose amount differs from quantity x unit price by more
    than ``tolerance``."""
    expected = F.col("quantity") * F.col("unit_price")
    diff = F.abs(F.col("line_amount") - expected)
    return po_lines.filter(diff > F.lit(tolerance)).select(
        "po_line_id", "po_id", "line_number", "line_amount", expected.alias("expected_amount"),
        diff.alias("difference"))


def schema_drift(df: DataFrame, expected: StructType) -> DataFrame:
    """Q13: columns added, missing or retyped against ``expected``.
    Compares schemas (metadata only) and returns the differences as rows."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = []
    for name, t in want.items():
        if name not in actual:
            rows.append((name, "missing", t, None))
        elif actual[name] != t:
            rows.append((name, "retyped", t, actual[name]))
    for name, t in actual.items():
        if name not in want:
            rows.append((name, "added", None, t))
    return df.sparkSession.createDataFrame(
        rows, "column_name string, change string, expected_type string, actual_type string")


# --------------------------------------------------------------------------
# reconciliation
def _one_row(T: Mapping[str, DataFrame]) -> DataFrame:
    """A one-row frame to select scalar subqueries from."""
    return T[next(iter(T))].sparkSession.range(1)


def _count(df: DataFrame):
    return df.agg(F.count(F.lit(1))).scalar()


def recon_vendors(T: Mapping[str, DataFrame]) -> DataFrame:
    """Q1: active vendors vs current dimension rows (two scalar counts)."""
    op = _count(T["vendors"].filter(F.col("is_active")))
    an = _count(T["dim_vendors"].filter(F.col("is_current_record")))
    return _one_row(T).select(F.lit("Vendor Count Check").alias("check_name"), op.alias("operational_count"),
                              an.alias("analytics_count"), (op - an).alias("variance"))


def recon_spend(T: Mapping[str, DataFrame]) -> DataFrame:
    """Q2: transaction spend from the calendar start vs fact spend, variance
    and coverage % (rounded to 2)."""
    op = (T["spend_transactions"].filter(F.col("transaction_date") >= F.lit("2009-01-01").cast("date"))
          .agg(F.sum(dec("total_amount"))).scalar())
    an = T["fact_spend_analytics"].agg(F.sum(dec("spend_amount"))).scalar()
    return _one_row(T).select(
        F.lit("Spend Amount Check").alias("check_name"),
        op.cast("double").alias("operational_spend"),
        an.cast("double").alias("analytics_spend"),
        (op - an).cast("double").alias("variance"),
        F.round(F.try_divide(an.cast("double"), op.cast("double")) * 100.0, 2).alias("coverage_percentage"))


def recon_spend_status(T: Mapping[str, DataFrame], tolerance: float = 1000.0) -> DataFrame:
    """Q3: abs(all transaction spend - fact spend), PASS below ``tolerance``."""
    op = T["spend_transactions"].agg(F.sum(dec("total_amount"))).scalar()
    an = T["fact_spend_analytics"].agg(F.sum(dec("spend_amount"))).scalar()
    var = F.abs(op - an)
    return _one_row(T).select(
        F.lit("Spend Reconciliation").alias("validation"), var.cast("double").alias("variance"),
        F.when(var < F.lit(tolerance), "PASS").otherwise("FAIL").alias("status"))


def recon_fy(T: Mapping[str, DataFrame]) -> DataFrame:
    """Q4: transactions per fiscal year, operational vs facts (full outer
    join; the year comes from the operational side, the variance is NULL
    where a side is missing)."""
    op = T["spend_transactions"].groupBy("fiscal_year").agg(F.count(F.lit(1)).alias("operational_count"))
    an = (T["fact_spend_analytics"].join(calendar(T["dim_time"], "time_key", "fiscal_year"), "time_key")
          .groupBy("fiscal_year").agg(F.count(F.lit(1)).alias("analytics_count"))
          .withColumnRenamed("fiscal_year", "_an_fy"))
    return (op.join(an, op.fiscal_year == an._an_fy, "full_outer")
              .select(F.lit("Transaction Count by FY").alias("check_name"), "fiscal_year", "operational_count",
                      "analytics_count", (F.col("operational_count") - F.col("analytics_count")).alias("variance"))
              .orderBy("fiscal_year"))


def orphan_facts(T: Mapping[str, DataFrame]) -> DataFrame:
    """Q5: facts whose vendor, commodity or day is missing from its
    dimension (a NULL key counts as missing).

    One scan: a fact's day is looked up where it is read (the calendar is
    bounded), and the facts are combined to one row per vendor and commodity
    (map-side) with the number of all rows and of those without a day; only
    these rows meet the dimensions' distinct keys. A hot key costs one row per
    task; Spark broadcasts a dimension that is measured small."""
    days = calendar(T["dim_time"].select("time_key").distinct().withColumn("_day", F.lit(True)), "time_key", "_day")
    flagged = (T["fact_spend_analytics"].select("vendor_key", "commodity_key", "time_key").join(days, "time_key", "left")
               .groupBy("vendor_key", "commodity_key")
               .agg(F.count(F.lit(1)).alias("_n"), F.count(F.when(F.col("_day").isNull(), 1)).alias("_lost")))
    missing_any = F.lit(False)
    for key, table in (("vendor_key", "dim_vendors"), ("commodity_key", "dim_commodities")):
        there = T[table].select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_has_" + key, F.lit(True))
        flagged = flagged.join(there, key, "left")
        missing_any = missing_any | F.col("_has_" + key).isNull()
    return flagged.agg(F.lit("Orphaned Fact Records").alias("check_name"),
                       F.coalesce(F.sum(F.when(missing_any, F.col("_n")).otherwise(F.col("_lost"))), F.lit(0))
                       .cast("long").alias("orphaned_count"))


def check_consistency(T: Mapping[str, DataFrame], vendor_tolerance: int = 10, ratio_floor: float = 0.9) -> DataFrame:
    """Q7: all vendors vs all dimension versions (within ``vendor_tolerance``)
    and facts / transactions > ``ratio_floor`` -> PASSED, else WARNING."""
    counts = _one_row(T).select(
        _count(T["vendors"]).alias("operational_vendors"),
        _count(T["dim_vendors"]).alias("analytics_vendors"),
        _count(T["spend_transactions"]).alias("operational_transactions"),
        _count(T["fact_spend_analytics"]).alias("analytics_facts"))
    ratio = F.when(F.col("operational_transactions") > 0,
                   F.col("analytics_facts").cast("double") / F.col("operational_transactions").cast("double")) \
        .otherwise(F.lit(0.0))
    consistent = F.abs(F.col("operational_vendors") - F.col("analytics_vendors")) <= vendor_tolerance
    return counts.select(
        F.when(consistent & (ratio > ratio_floor), "PASSED").otherwise("WARNING").alias("status"),
        "operational_vendors", "analytics_vendors", "operational_transactions", "analytics_facts",
        consistent.alias("vendor_consistency"), F.round(ratio, 3).alias("transaction_ratio"))


def verify_schema(T: Mapping[str, DataFrame], required: Sequence[str], schema_name: str) -> DataFrame:
    """Q6: PASSED when every required table is present (catalog metadata
    only), with the list of missing ones and the number of foreign keys that
    are declared for the required tables."""
    spark = next(iter(T.values())).sparkSession if len(T) else None
    missing = [t for t in required if t not in T]
    return spark.createDataFrame(
        [(schema_name, "PASSED" if not missing else "FAILED", ",".join(missing),
          sum(child in required for child, *_ in FOREIGN_KEYS))],
        "schema_name string, status string, missing_tables string, foreign_keys int")


def health_check(T: Mapping[str, DataFrame]) -> DataFrame:
    """Q8: HEALTHY iff both schema checks pass and consistency is PASSED or
    WARNING; ISSUES_DETECTED otherwise."""
    star_ok = all(t in T for t in REQUIRED_STAR)
    op_ok = all(t in T for t in REQUIRED_OPERATIONAL)
    cons = check_consistency(T).select(F.col("status").alias("consistency_status"), "transaction_ratio")
    healthy = F.lit(star_ok and op_ok) & F.col("consistency_status").isin("PASSED", "WARNING")
    return cons.select(
        F.lit("PASSED" if star_ok else "FAILED").alias("star_schema_status"),
        F.lit("PASSED" if op_ok else "FAILED").alias("operational_schema_status"),
        "consistency_status", "transaction_ratio",
        F.when(healthy, "HEALTHY").otherwise("ISSUES_DETECTED").alias("overall_status"))

