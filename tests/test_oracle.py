"""Every registered procurement query against its DuckDB oracle at sf0.01 (value match)."""

from __future__ import annotations

import pytest

from conftest import SF01

import __spark_entry__ as E
from oracle_check import compare, duck
from spendstar.plans.catalog import PLANS

KEYS = sorted(PLANS)  # the text operators are optional; their own suite covers them


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.queries())
    assert set(KEYS) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    r = compare(spark, key, SF01, con)
    assert r["status"] == "match", r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["vendor_name", "vendor_tier", "risk_rating", "categories_served", "total_spend",
                          "avg_otif", "avg_quality", "avg_compliance", "total_savings"]
    assert len(rows) > 0
