"""Oracle SQL for SCD2, reconciliation, rules, monitoring, table counts and
the roadmap analytics. Rule, key and FK lists are the fixed DDL values; the
SQL around them is written here independently."""

from __future__ import annotations

from spendstar.sources.fixtures import OPERATIONAL_TABLES, STAR_TABLES
from spendstar.sources.schemas import ALL

from .fixed_rules import CHECK_RULES, FOREIGN_KEYS, KEYS, NOT_NULL
from .queries import AS_OF, DSUM

TABLES = list(OPERATIONAL_TABLES) + list(STAR_TABLES)
SQL_WORDS = {"in", "and", "or", "abs", "not", "null", "is"}


def _cols(pred: str) -> set[str]:
    import re
    return set(re.findall(r"\b[a-z_][a-z0-9_]*\b", re.sub(r"'[^']*'", "", pred))) - SQL_WORDS


def _has(table: str, cols) -> bool:
    return table in ALL and set(cols) <= set(ALL[table].fieldNames())


def _state(*needs) -> str:
    """What a check needs: (table, columns) pairs, in the order in which they are missed."""
    for table, cols in needs:
        if table not in TABLES:
            return "TABLE_MISSING"
        if not _has(table, cols):
            return "COLUMN_MISSING"
    return "CHECKED"


def _violations(t, name, pred) -> str:
    state = _state((t, _cols(pred)))
    count = (f"(select count(*) from {t} where not coalesce({pred}, true))" if state == "CHECKED" else "cast(null as bigint)")
    return f"select '{t}' as table_name, '{name}' as rule_name, '{state}' as status, {count} as violations"


def _duplicates(t, k) -> str:
    state, names, cols = _state((t, k)), ",".join(k), ", ".join(k)
    if state != "CHECKED":
        nulls = ", ".join(f"cast(null as bigint) as {c}" for c in ("row_count", "null_key_rows", "duplicate_groups", "duplicate_rows"))
        return f"select '{t}' as table_name, '{names}' as key_columns, '{state}' as status, {nulls}"
    return f"""select '{t}' as table_name, '{names}' as key_columns, '{state}' as status,
  (select count(*) from {t}) as row_count,
  (select count(*) from {t} where {" or ".join(c + " is null" for c in k)}) as null_key_rows,
  (select count(*) from (select 1 from {t} group by {cols} having count(*) > 1) g) as duplicate_groups,
  (select cast(coalesce(sum(n), 0) as bigint) from (select count(*) as n from {t} group by {cols}
     having count(*) > 1) g) as duplicate_rows"""


def _fk(c, col, p, pcol) -> str:
    state = _state((c, [col]), (p, [pcol]))
    count = (f"(select count(*) from {c} ch where ch.{col} is not null and not exists "
             f"(select 1 from {p} pa where pa.{pcol} = ch.{col}))" if state == "CHECKED" else "cast(null as bigint)")
    return (f"select '{c}' as child_table, '{col}' as child_column, '{p}' as parent_table, '{pcol}' as parent_column, "
            f"'{state}' as status, {count} as violations")


def _nulls(t, c) -> str:
    state = _state((t, [c]))
    count = f"(select count(*) - count({c}) from {t})" if state == "CHECKED" else "cast(null as bigint)"
    return f"select '{t}' as table_name, '{c}' as column_name, '{state}' as status, {count} as null_rows"


NULL_ROWS = "\nunion all\n".join(_nulls(t, c) for t, columns in NOT_NULL for c in columns)
VIOLATIONS = "\nunion all\n".join(_violations(*r) for r in CHECK_RULES)
DUPLICATES = "\nunion all\n".join(_duplicates(*r) for r in KEYS)
FK_VIOLATIONS = "\nunion all\n".join(_fk(*r) for r in FOREIGN_KEYS)

RATED = """
select v.* exclude (is_active), v.is_active,
  coalesce((select max(p.risk_rating) from supplier_profiles p where p.vendor_id = v.vendor_id), 'Medium') as risk_rating
from vendors v"""
SHOWN = "vendor_id, vendor_name, vendor_tier, diversity_classification, risk_rating, country, region"

D1 = f"""
select distinct {SHOWN} from ({RATED}) r
where is_active and not exists (select 1 from dim_vendors d where d.is_current_record and d.vendor_id = r.vendor_id)"""

# a tracked attribute differs if both sides are known and not equal
D4 = f"""
select {", ".join("r." + c for c in SHOWN.split(", "))} from ({RATED}) r, dim_vendors d
where d.is_current_record and d.vendor_id = r.vendor_id and len(list_filter([
  {", ".join(f"r.{c} <> d.{c}" for c in SHOWN.split(", ")[1:])}], lambda x: x)) > 0"""

D6 = f"""
with ins as (select *, 1 as b from ({D1}) a union all select *, 2 as b from ({D4}) c),
keyed as (
  select (select max(vendor_key) from dim_vendors) + row_number() over (order by b, vendor_id) as vendor_key, *
  from ins),
alld as (
  select vendor_key, vendor_id, vendor_name, vendor_tier, diversity_classification, risk_rating, esg_score, country,
    region, effective_start_date, effective_end_date, is_current_record, supplier_size, certification_status from dim_vendors
  union all
  select vendor_key, vendor_id, vendor_name, vendor_tier, diversity_classification, risk_rating,
    cast(null as double), country, region, {AS_OF}, cast(null as date), true, cast(null as varchar), cast(null as varchar)
  from keyed),
chg as (select distinct vendor_id from alld where effective_start_date = {AS_OF} and is_current_record)
select vendor_key, vendor_id, vendor_name, vendor_tier, diversity_classification, risk_rating, esg_score, country, region,
  effective_start_date, supplier_size, certification_status,
  case when closing then cast({AS_OF} - interval 1 day as date) else effective_end_date end as effective_end_date,
  case when closing then false else is_current_record end as is_current_record
from (select alld.*, (alld.vendor_id in (select vendor_id from chg) and alld.is_current_record
                      and alld.effective_start_date < {AS_OF}) as closing from alld) x"""

# the last word of every vendor in the change feed, whatever the order of arrival
CDC = f"""
with feed as (
  select cast(substr(po_id, 2) as bigint) as n, vendor_id as of_order, total_amount as amount from purchase_orders),
told as (
  select n, n % 13 = 5 as ends, case when n % 11 = 3 then 'W' || lpad(cast(n % 211 as varchar), 6, '0') else of_order end as vendor_id,
    case when amount > 200000 then 'Strategic' when amount > 120000 then 'Preferred' when amount > 60000 then 'Approved'
         else 'Tactical' end as vendor_tier,
    case when n % 2 = 0 then 'Women' end as diversity_classification, 'Country ' || (n % 7) as country,
    'Region ' || (n % 3) as region, n % 17 <> 2 as awake
  from feed),
spoken as (
  select vendor_id, max(n) as n_any, max(n) filter (where not ends) as n_row from told where vendor_id is not null group by vendor_id),
master as (
  select coalesce(v.vendor_id, k.vendor_id) as vendor_id,
    case when k.n_row is null then v.vendor_name else 'Vendor ' || k.vendor_id end as vendor_name,
    case when k.n_row is null then v.vendor_tier else r.vendor_tier end as vendor_tier,
    case when k.n_row is null then v.diversity_classification else r.diversity_classification end as diversity_classification,
    case when k.n_row is null then v.country else r.country end as country,
    case when k.n_row is null then v.region else r.region end as region,
    case when k.n_any is null then v.is_active when a.ends then false else a.awake end as is_active
  from vendors v full join spoken k on k.vendor_id = v.vendor_id
  left join told r on r.n = k.n_row left join told a on a.n = k.n_any),
rated as (select m.*, coalesce(p.risk_rating, 'Medium') as risk_rating from master m left join supplier_profiles p using (vendor_id)),
today as (
  select r.* from rated r left join dim_vendors d on d.vendor_id = r.vendor_id and d.is_current_record
  where case when d.vendor_id is null then r.is_active
             else coalesce(r.vendor_name <> d.vendor_name, false) or coalesce(r.vendor_tier <> d.vendor_tier, false)
               or coalesce(r.diversity_classification <> d.diversity_classification, false)
               or coalesce(r.risk_rating <> d.risk_rating, false) or coalesce(r.country <> d.country, false)
               or coalesce(r.region <> d.region, false) end)
select d.vendor_id, d.vendor_name, d.vendor_tier, d.diversity_classification, d.risk_rating, d.esg_score, d.country, d.region,
  d.effective_start_date, case when d.is_current_record and t.vendor_id is not null
    then cast({AS_OF} - interval 1 day as date) else d.effective_end_date end as effective_end_date,
  d.is_current_record and t.vendor_id is null as is_current_record, d.supplier_size, d.certification_status
from dim_vendors d left join today t using (vendor_id)
union all
select vendor_id, vendor_name, vendor_tier, diversity_classification, risk_rating, null, country, region, {AS_OF}, null, true, null, null
from today"""

RECON_VENDORS = """
select 'Vendor Count Check' as check_name, operational_count, analytics_count, operational_count - analytics_count as variance
from (select (select count(*) from vendors where is_active) as operational_count,
             (select count(*) from dim_vendors where is_current_record) as analytics_count) counts"""

SPEND_STATUS = """
with gap as (
  select abs(sum(money)) as off from (
    select cast(total_amount as decimal(18,2)) as money from spend_transactions
    union all
    select -cast(spend_amount as decimal(18,2)) from fact_spend_analytics) entries)
select 'Spend Reconciliation' as validation, cast(off as double) as variance, if(off < 1000, 'PASS', 'FAIL') as status from gap"""

ORPHANS = """
select 'Orphaned Fact Records' as check_name, (select count(*) from fact_spend_analytics) - (
  select count(*) from fact_spend_analytics b
  where exists (select 1 from dim_vendors x where x.vendor_key = b.vendor_key)
    and exists (select 1 from dim_commodities x where x.commodity_key = b.commodity_key)
    and exists (select 1 from dim_time x where x.time_key = b.time_key)) as orphaned_count"""

CONSISTENCY = """
select case when abs(ov - av) <= 10 and ratio > 0.9 then 'PASSED' else 'WARNING' end as status,
  ov as operational_vendors, av as analytics_vendors, ot as operational_transactions, af as analytics_facts,
  abs(ov - av) <= 10 as vendor_consistency, round(ratio, 3) as transaction_ratio
from (select *, case when ot > 0 then cast(af as double) / cast(ot as double) else 0.0 end as ratio
      from (select (select count(*) from vendors) as ov, (select count(*) from dim_vendors) as av,
                   (select count(*) from spend_transactions) as ot,
                   (select count(*) from fact_spend_analytics) as af) c) r"""



def _row_text(table: str) -> str:
    """Integers, strings and dates of a row as one text, in table order."""
    cols = [f.name for f in ALL[table].fields if f.dataType.typeName() in ("integer", "long", "string", "date")]
    return "concat_ws('|', " + ", ".join(f"coalesce(cast({c} as varchar), '~')" for c in cols) + ")"


def _anomalies(least: int, limit: float) -> str:
    return f"""
with h as (
  select *, cast(spend_amount as double) as x,
    cast(sum(cast(spend_amount as decimal(38,12))) over pair as double) / count(*) over pair as mean,
    stddev_samp(cast(spend_amount as double)) over pair as sd, count(*) over pair as n
  from fact_spend_analytics window pair as (partition by vendor_key, commodity_key))
select fact_key, vendor_key, commodity_key, x as spend_amount, round(mean, 6) as mean_spend, round(sd, 6) as stddev_spend,
  round((x - mean) / nullif(sd, 0), 6) as z_score, coalesce(abs((x - mean) / nullif(sd, 0)) > {limit}, false) as is_anomaly
from h where n >= {least}"""


QUALITY_QUERIES: dict[str, str] = {
    "copy_star_counts": "\nunion all\n".join(
        f"select '{t}' as table_name, count(*) as row_count, "
        f"cast(coalesce(sum(cast('0x' || substr(md5({_row_text(t)}), 1, 8) as bigint)), 0) as bigint) as value_sum from {t}"
        for t in STAR_TABLES),
    "table_info": "\nunion all\n".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in TABLES),
    "scd2_vendor_changes": f"""
select *, {AS_OF} as effective_start_date, true as is_current_record from ({D4}) x""",
    "scd2_apply": D6,
    "vendor_cdc_dimension": CDC,
    "scd2_closed": f"""
select vendor_key, vendor_id, effective_start_date, effective_end_date, is_current_record from ({D6}) s
where effective_end_date = cast({AS_OF} - interval 1 day as date) and not is_current_record""",
    "recon_vendor_count": RECON_VENDORS,
    "recon_spend_amount": """
with side as (
  select 'op' as who, cast(total_amount as decimal(18,2)) as money from spend_transactions where transaction_date >= date '2009-01-01'
  union all
  select 'an', cast(spend_amount as decimal(18,2)) from fact_spend_analytics),
both_sides as (select sum(money) filter (where who = 'op') as op, sum(money) filter (where who = 'an') as an from side)
select 'Spend Amount Check' as check_name, cast(op as double) as operational_spend, cast(an as double) as analytics_spend,
  cast(op - an as double) as variance, round((cast(an as double) / nullif(cast(op as double), 0)) * 100.0, 2) as coverage_percentage
from both_sides""",
    "recon_spend_status": SPEND_STATUS,
    "recon_txn_by_fy": """
with n as (
  select fiscal_year, 1 as op, 0 as an from spend_transactions where fiscal_year is not null
  union all
  select y.fiscal_year, 0, 1 from fact_spend_analytics b join dim_time y using (time_key)),
g as (select fiscal_year, nullif(sum(op), 0)::bigint as o, nullif(sum(an), 0)::bigint as a from n group by fiscal_year),
unknown as (select count(*) as o from spend_transactions where fiscal_year is null having count(*) > 0)
select 'Transaction Count by FY' as check_name, case when o is not null then fiscal_year end as fiscal_year,
  o as operational_count, a as analytics_count, o - a as variance from g
union all
select 'Transaction Count by FY', null, o, null, null from unknown""",
    "orphan_facts": ORPHANS,
    "consistency_check": CONSISTENCY,
    "health_check": f"""
select 'PASSED' as star_schema_status, 'PASSED' as operational_schema_status, status as consistency_status,
  transaction_ratio, case when status in ('PASSED', 'WARNING') then 'HEALTHY' else 'ISSUES_DETECTED' end as overall_status
from ({CONSISTENCY}) c""",
    "dq_check_violations": VIOLATIONS,
    "dq_duplicate_keys": DUPLICATES,
    "dq_null_columns": NULL_ROWS,
    "dq_fk_violations": FK_VIOLATIONS,
    "dq_po_line_amount": """
select po_line_id, po_id, line_number, cast(line_amount as double) as line_amount, quantity * unit_price as expected_amount,
  abs(line_amount - quantity * unit_price) as difference
from po_line_items where abs(line_amount - quantity * unit_price) > 0.01""",
    "etl_summary": """
with per_run as (select load_date, count(*) as n from fact_spend_analytics group by load_date)
select 'ETL Summary' as report_type, (select max(load_date) from per_run) as last_etl_date,
  (select count(load_date) from per_run) as total_etl_runs, (select coalesce(sum(n), 0)::bigint from per_run) as total_records_loaded,
  (select min(load_date) from per_run) as first_etl_date""",
    "etl_daily_volume": f"""
select load_date, count(*) as records_loaded, {DSUM('spend_amount')} as total_spend_loaded,
  count(distinct vendor_key) as vendors_affected, count(distinct commodity_key) as commodities_affected
from fact_spend_analytics where load_date >= cast({AS_OF} - interval 30 day as date)
group by load_date""",
    "data_freshness": f"""
select 'Data Freshness' as check_type, d as latest_transaction_date, {AS_OF} as "current_date",
  cast({AS_OF} - d as double) as days_behind
from (select max(date_actual) as d from dim_time where time_key in (select time_key from fact_spend_analytics)) x""",
    "dq_alerts": f"""
select 'vendor_count_variance' as check_name, 'WARNING' as severity, cast(variance as double) as measured,
  10.0 as threshold from ({RECON_VENDORS}) a where abs(variance) > 10
union all
select 'spend_reconciliation', 'CRITICAL', variance, 1000.0 from ({SPEND_STATUS}) b where status = 'FAIL'
union all
select 'orphan_facts', 'WARNING', cast(orphaned_count as double), 0.0 from ({ORPHANS}) c where orphaned_count > 0
union all
select 'fact_coverage', 'WARNING', transaction_ratio, 0.9 from ({CONSISTENCY}) d where status != 'PASSED'
union all
select table_name || '.' || rule_name, 'ERROR', cast(violations as double), 0.0 from ({VIOLATIONS}) e
where violations > 0""",
    "spend_anomalies": _anomalies(5, 3.0),
    "spend_anomalies_pairs": _anomalies(2, 0.7),
    "supplier_risk_score": f"""
with a as (
  select vendor_id,
    cast(sum(case risk_level when 'Low' then 1 when 'Medium' then 2 when 'High' then 3 when 'Critical' then 4 end) as double)
      / nullif(cast(count(case risk_level when 'Low' then 1 when 'Medium' then 2 when 'High' then 3 when 'Critical' then 4 end) as double), 0)
      as assessment_component
  from risk_assessments where status = 'Open' and assessment_date <= {AS_OF} group by vendor_id),
au as (select vendor_id, (100.0 - audit_score) / 25.0 as audit_component from supplier_profiles),
l as (
  select st.vendor_id,
    4.0 * (cast(count(case when datediff('day', st.invoice_date, st.payment_date) > k.payment_terms then 1 end) as double)
           / nullif(cast(count(*) as double), 0)) as late_payment_component
  from spend_transactions st join contracts k on st.contract_id = k.contract_id
  where st.payment_date is not null and k.payment_terms is not null group by st.vendor_id)
select v.vendor_id, a.assessment_component, au.audit_component, l.late_payment_component,
  1.0 * coalesce(a.assessment_component, 0.0) + 1.0 * coalesce(au.audit_component, 0.0)
    + 1.0 * coalesce(l.late_payment_component, 0.0) as risk_score
from vendors v left join a on v.vendor_id = a.vendor_id left join au on v.vendor_id = au.vendor_id
left join l on v.vendor_id = l.vendor_id""",
}
