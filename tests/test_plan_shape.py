"""Physical-plan guards for scale: filters reach the Parquet scans, fact scans
read only the needed columns, no cartesian products, no Python evaluation,
no nested-loop joins (one-row values are scalar subqueries)."""

from __future__ import annotations

import contextlib
import io as _io
import re

import pytest

from spendstar.plans.catalog import PLANS
from spendstar.sources import io
from spendstar.sources.fixtures import OPERATIONAL_TABLES, STAR_TABLES

@pytest.fixture(scope="module")
def stored(spark, T001, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("db"))
    names = list(OPERATIONAL_TABLES) + list(STAR_TABLES)
    for n in names:
        T001[n].write.parquet(f"{root}/{n}")
    return io.read_tables(spark, root, names)


def plan_of(df) -> str:
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def scans(plan: str, table: str) -> list[str]:
    """The scan node blocks of ``table`` in a formatted plan."""
    blocks = re.split(r"\n\(\d+\) ", plan)
    return [b for b in blocks if b.startswith("Scan parquet") and f"/{table}]" in b]


@pytest.mark.parametrize("key", sorted(PLANS))
def test_no_cartesian_no_python(stored, key):
    p = plan_of(PLANS[key](stored))
    assert "CartesianProduct" not in p
    assert "EvalPython" not in p and "PythonUDF" not in p
    assert "BroadcastNestedLoopJoin" not in p      # one-row values are scalar subqueries


def test_fiscal_year_reaches_fact_scan_and_prunes_columns(stored):
    (scan,) = scans(plan_of(PLANS["supplier_performance"](stored)), "fact_spend_analytics")
    assert "GreaterThanOrEqual(time_key,20230401)" in scan and "LessThanOrEqual(time_key,20240331)" in scan
    read = re.search(r"ReadSchema: struct<(.*)>", scan).group(1)
    assert "payment_delay_days" not in read and "load_date" not in read


def test_date_windows_reach_scans(stored):
    (f,) = scans(plan_of(PLANS["risk_exposure"](stored)), "fact_spend_analytics")
    assert "GreaterThanOrEqual(time_key,20221105)" in f
    (s,) = scans(plan_of(PLANS["fact_spend_incremental"](stored)), "spend_transactions")
    assert "GreaterThanOrEqual(transaction_date,2023-10-29)" in s
    (s,) = scans(plan_of(PLANS["forecast_alignment"](stored)), "spend_transactions")
    assert "LessThan(transaction_date,2023-11-05)" in s


def test_vendor_reports_aggregate_before_vendor_join(stored):
    p = plan_of(PLANS["supplier_performance"](stored))
    tree = p.split("\n\n")[0]
    # the vendor-dimension join sits above the fact aggregation in the tree
    join_line = next(i for i, line in enumerate(tree.splitlines()) if "Join" in line)
    agg_line = next(i for i, line in enumerate(tree.splitlines()) if "HashAggregate" in line and i > join_line)
    assert agg_line > join_line


@pytest.mark.parametrize("key", ["esg_diversity", "strategic_roadmap", "supplier_performance", "category_plan"])
def test_facts_scanned_once(stored, key):
    assert len(scans(plan_of(PLANS[key](stored)), "fact_spend_analytics")) == 1


def test_orphans_move_vendor_and_commodity_only(stored):
    """The day is looked up where a fact is read; it is no grouping key that is shuffled."""
    p = plan_of(PLANS["orphan_facts"](stored))
    assert "hashpartitioning(vendor_key" in p and not re.search(r"hashpartitioning\([^)]*time_key", "\n".join(
        b for b in re.split(r"\n\(\d+\) ", p) if b.startswith("Exchange") and "commodity_key" in b))


def test_orders_meet_customers_before_lines(spark, T001):
    """The customer key does not move with every line; the rows are those of the SQL text as written."""
    from spendstar.sources.fixtures import FIXTURE_SQL
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        T001["spend_transactions"].explain("extended")
    lines = buf.getvalue().split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0].splitlines()
    depth = [len(re.match(r"[\s:+-]*", line).group()) for line in lines]
    at = next(i for i, line in enumerate(lines) if "Join Inner, (o_custkey" in line)
    below = [line for i, line in enumerate(lines) if i > at and all(d > depth[at] for d in depth[at + 1:i + 1])]
    assert any("c_custkey" in line for line in below) and not any("l_orderkey" in line for line in below)
    text = re.sub(r"\b(from|join) (lineitem|orders|customer|part)\b", r"\1 parquet.`/root/testdata/sf0.001/\2.parquet`",
                  FIXTURE_SQL["spend_transactions"])
    want, got = spark.sql(text), T001["spend_transactions"].select(*spark.sql(text).columns)
    assert want.count() == got.count() > 1000 and want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()
