"""DuckDB oracle: one SQL text per registered query key.

Each text is self-contained over the driver's raw views (region, nation,
customer, supplier, part, orders, lineitem): the fixture tables of FIXTURES.md
and the calendar are prepended as CTEs, only those the query reads.
"""

from __future__ import annotations

import re

from spendstar.sources.fixtures import FIXTURE_SQL

# DuckDB calendar, written from the calendar rules (not from the Spark code).
DIM_TIME_SQL = """
select cast(strftime(d, '%Y%m%d') as integer) as time_key, d as date_actual,
  cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter, cast(month(d) as integer) as month,
  cast(case when month(d) >= 4 then year(d) + 1 else year(d) end as integer) as fiscal_year,
  cast(case when month(d) between 4 and 6 then 1 when month(d) between 7 and 9 then 2
            when month(d) between 10 and 12 then 3 else 4 end as integer) as fiscal_quarter,
  cast(case when month(d) >= 4 then month(d) - 3 else month(d) + 9 end as integer) as fiscal_month,
  strftime(d, '%B') as month_name, 'Q' || cast(quarter(d) as varchar) as quarter_name,
  strftime(d, '%A') as day_of_week, cast(dayofweek(d) + 1 as integer) as day_of_week_num,
  cast(strftime(d, '%W') as integer) as week_of_year, dayofweek(d) in (0, 6) as is_weekend,
  false as is_holiday, cast(null as varchar) as holiday_name
from (select cast(unnest(generate_series(date '2009-01-01', date '2030-12-31', interval 1 day)) as date) as d) s"""

CTE_SQL = dict(FIXTURE_SQL)
CTE_SQL["dim_time"] = DIM_TIME_SQL
# Dependency order for the WITH list.
CTE_ORDER = ["vendors", "supplier_profiles", "commodities", "commodity_profiles", "business_units", "contracts",
             "purchase_orders", "po_line_items", "time_periods", "spend_transactions", "dim_vendors", "dim_commodities",
             "fact_spend_analytics", "dim_time", "savings_targets", "demand_forecasts", "risk_assessments",
             "sourcing_strategies", "market_intelligence", "performance_metrics"]

_REF = re.compile(r"\b(" + "|".join(CTE_ORDER) + r")\b")


def _needed(sql: str) -> list[str]:
    need: set[str] = set()
    todo = set(_REF.findall(sql))
    while todo:
        name = todo.pop()
        if name in need:
            continue
        need.add(name)
        todo |= set(_REF.findall(CTE_SQL[name])) - need
    return [n for n in CTE_ORDER if n in need]


def compose(sql: str) -> str:
    """Prepend the fixture CTEs that ``sql`` reads."""
    body = sql.strip()
    recursive = False
    own = ""
    m = re.match(r"(?is)^with\s+(recursive\s+)?", body)
    if m:
        recursive = bool(m.group(1))
        own = body[m.end():]
        body = ""
    ctes = [f"{name} as ({CTE_SQL[name].strip()})" for name in _needed(sql)]
    head = "with recursive " if recursive else "with "
    if own:
        return head + ",\n".join(ctes + [own])
    if not ctes:
        return body
    return head + ",\n".join(ctes) + "\n" + body


def oracle_queries() -> dict[str, str]:
    from .quality_queries import QUALITY_QUERIES
    from .queries import QUERIES
    return {k: compose(v) for k, v in {**QUERIES, **QUALITY_QUERIES}.items()}
