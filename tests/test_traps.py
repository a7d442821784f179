"""Hand-made frames for the semantic traps (zero denominators, text ids,
NULL handling in SCD2, same-day changes, superseded keys, fan-out, week 0,
empty literal view, NULL category share, fiscal fill, CHECK on NULL, full
outer years)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spendstar.functions.agg import pct
from spendstar.operators import dims, facts, quality, reports, scd2, views
from spendstar.sources import schemas

D = dt.date


def mk(spark, table, rows):
    """DataFrame with the fixed schema of ``table``; missing columns NULL."""
    schema = schemas.ALL[table]
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)


def star(spark, fact_rows, vendors=None, commodities=None):
    vendors = vendors or [dict(vendor_key=1, vendor_id="V1", vendor_name="A", vendor_tier="Strategic",
                               risk_rating="Low", effective_start_date=D(2017, 1, 1), is_current_record=True)]
    commodities = commodities or [dict(commodity_key=1, commodity_id="C1", parent_category="X", sub_category="x",
                                       is_current_record=True)]
    return {
        "fact_spend_analytics": mk(spark, "fact_spend_analytics", fact_rows),
        "dim_vendors": mk(spark, "dim_vendors", vendors),
        "dim_commodities": mk(spark, "dim_commodities", commodities),
        "dim_time": dims.dim_time(spark),
    }


def fact(fk, vk=1, ck=1, tk=20230501, spend="100.00", **kw):
    from decimal import Decimal
    r = dict(fact_key=fk, vendor_key=vk, commodity_key=ck, time_key=tk, spend_amount=Decimal(spend),
             transaction_count=1, source_transaction_id=str(fk), load_date=D(2023, 11, 5))
    r.update(kw)
    return r


def test_t2_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (1.0, 4.0)], "a double, b double")
    got = [r[0] for r in df.select(pct("a", "b")).collect()]
    assert got == [None, None, 25.0]


def test_t2_report_with_zero_spend(spark):
    from decimal import Decimal
    T = star(spark, [fact(1, spend="0.00", savings_amount=Decimal("0"))])
    row = reports.procurement_roi(T).collect()[0]
    assert row["savings_rate"] is None and row["procurement_roi"] is None


def test_t3_t4_loaded_ids_compared_as_text_and_null_ids_ignored(spark):
    from decimal import Decimal
    spend = mk(spark, "spend_transactions", [
        dict(transaction_id=12, vendor_id="V1", commodity_id="C1", transaction_date=D(2023, 5, 1),
             total_amount=Decimal("5.00")),
        dict(transaction_id=13, vendor_id="V1", commodity_id="C1", transaction_date=D(2023, 5, 1),
             total_amount=Decimal("6.00")),
    ])
    T = star(spark, [dict(fact(900), source_transaction_id="12abc"), dict(fact(901), source_transaction_id=None),
                     dict(fact(902), source_transaction_id="13")])
    new = facts.fact_spend_new(spend, T["dim_vendors"], T["dim_commodities"], T["dim_time"],
                               T["fact_spend_analytics"], D(2023, 11, 5))
    assert [r["fact_key"] for r in new.collect()] == [12]


def test_incremental_load_knows_redated_and_award_dated_facts(spark):
    from decimal import Decimal
    spend = mk(spark, "spend_transactions", [
        dict(transaction_id=i, vendor_id="V1", commodity_id="C1", transaction_date=D(2023, 11, 3),
             total_amount=Decimal("5.00")) for i in (12, 13, 14)])
    # 12 was loaded under an earlier date, 13 by the award date and without a key
    T = star(spark, [dict(fact(12), time_key=20230501), dict(fact(13), fact_key=None, time_key=20230401)])
    new = facts.fact_spend_incremental(spend, T["dim_vendors"], T["dim_commodities"], T["dim_time"],
                                       T["fact_spend_analytics"], D(2023, 11, 5))
    assert [r["fact_key"] for r in new.collect()] == [14]


def test_stream_load_knows_redated_facts(spark, tmp_path):
    from decimal import Decimal

    from spendstar.streaming.fact_stream import read_stream_target, stream_fact_load
    mk(spark, "spend_transactions", [
        dict(transaction_id=i, vendor_id="V1", commodity_id="C1", transaction_date=D(2023, 11, 3),
             total_amount=Decimal("5.00")) for i in (12, 14)]).write.parquet(f"{tmp_path}/source")
    T = star(spark, [dict(fact(12), time_key=20230501)])
    stream_fact_load(spark, f"{tmp_path}/source", T, f"{tmp_path}/facts", f"{tmp_path}/state", D(2023, 11, 5),
                     loaded=T["fact_spend_analytics"])
    assert [r["source_transaction_id"] for r in read_stream_target(spark, f"{tmp_path}/facts").collect()] == ["14"]


def test_current_year_ignores_facts_outside_the_calendar(spark):
    T = star(spark, [fact(1), fact(2, tk=99991231)])
    T["dim_time"] = T["dim_time"].filter("fiscal_year <= 2026")
    assert [r["total_spend"] for r in views.current_fy_performance(T).collect()] == [100.0]


def _vendor(vid, **kw):
    r = dict(vendor_id=vid, vendor_name="N", vendor_tier="Approved", diversity_classification="Women",
             country="C", region="R", is_active=True)
    r.update(kw)
    return r


def _dimrow(key, vid, start=D(2017, 1, 1), **kw):
    r = dict(vendor_key=key, vendor_id=vid, vendor_name="N", vendor_tier="Approved",
             diversity_classification="Women", risk_rating="Medium", country="C", region="R",
             effective_start_date=start, is_current_record=True)
    r.update(kw)
    return r


def test_t5_null_change_not_detected_unless_null_safe(spark):
    vendors = mk(spark, "vendors", [_vendor("V1", country=None)])
    profiles = mk(spark, "supplier_profiles", [])
    dim = mk(spark, "dim_vendors", [_dimrow(1, "V1")])
    assert scd2.scd2_changes(vendors, profiles, dim, D(2023, 11, 5)).count() == 0
    assert scd2.scd2_changes(vendors, profiles, dim, D(2023, 11, 5), null_safe=True).count() == 1


def test_t6_two_changes_same_day_leave_two_current_rows(spark):
    profiles = mk(spark, "supplier_profiles", [])
    dim = mk(spark, "dim_vendors", [_dimrow(1, "V1")])
    day = D(2023, 11, 5)
    d1 = scd2.scd2_apply(dim, mk(spark, "vendors", [_vendor("V1", vendor_tier="Strategic")]), profiles, day,
                         materialize=True)
    d2 = scd2.scd2_apply(d1, mk(spark, "vendors", [_vendor("V1", vendor_tier="Tactical")]), profiles, day,
                         materialize=True)
    cur = d2.filter("is_current_record").orderBy("vendor_key").collect()
    assert [r["vendor_tier"] for r in cur] == ["Strategic", "Tactical"]
    closed = d2.filter("not is_current_record").collect()
    assert len(closed) == 1 and closed[0]["effective_end_date"] == D(2023, 11, 4)


def test_d6_changes_on_distinct_days_leave_one_current_row_and_noop_on_unchanged(spark):
    profiles = mk(spark, "supplier_profiles", [])
    dim = mk(spark, "dim_vendors", [_dimrow(1, "V1")])
    d1 = scd2.scd2_apply(dim, mk(spark, "vendors", [_vendor("V1", vendor_tier="Strategic")]), profiles, D(2023, 11, 5),
                         materialize=True)
    d2 = scd2.scd2_apply(d1, mk(spark, "vendors", [_vendor("V1", vendor_tier="Tactical")]), profiles, D(2023, 11, 6),
                         materialize=True)
    cur = d2.filter("is_current_record").collect()
    assert len(cur) == 1 and cur[0]["vendor_tier"] == "Tactical" and cur[0]["vendor_key"] == 3
    same = scd2.scd2_apply(d2, mk(spark, "vendors", [_vendor("V1", vendor_tier="Tactical")]), profiles, D(2023, 11, 7),
                           materialize=True)
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, d2.collect()))


def test_t7_superseded_vendor_facts_not_in_current_report(spark):
    vendors = [dict(_dimrow(1, "V1", vendor_name="Old"), is_current_record=False, effective_end_date=D(2019, 12, 31)),
               _dimrow(2, "V1", start=D(2020, 1, 1), vendor_name="New")]
    T = star(spark, [fact(1, vk=1), fact(2, vk=2, spend="7.00")], vendors=vendors)
    rows = reports.supplier_performance(T, 2024).collect()
    assert [(r["vendor_name"], r["total_spend"]) for r in rows] == [("New", 7.0)]


def test_t8_award_variant_fans_out_per_version(spark):
    from decimal import Decimal
    spend = mk(spark, "spend_transactions", [
        dict(transaction_id=5, vendor_id="V1", commodity_id="C1", transaction_date=D(2023, 5, 1),
             award_date=D(2023, 4, 1), total_amount=Decimal("5.00")),
        dict(transaction_id=6, vendor_id="V1", commodity_id="C1", transaction_date=D(2023, 5, 1),
             award_date=None, total_amount=Decimal("5.00"))])
    vendors = [dict(_dimrow(1, "V1"), is_current_record=False), _dimrow(2, "V1")]
    T = star(spark, [], vendors=vendors)
    out = facts.fact_spend_award(spend, T["dim_vendors"], T["dim_commodities"], T["dim_time"],
                                 T["fact_spend_analytics"], D(2023, 11, 5))
    assert sorted(r["vendor_key"] for r in out.collect()) == [1, 2]


def test_t13_week_zero_and_fiscal_columns(spark):
    cal = dims.dim_time(spark, "2023-01-01", "2023-04-03").collect()
    by = {r["date_actual"]: r for r in cal}
    assert by[D(2023, 1, 1)]["week_of_year"] == 0          # a Sunday before the first Monday
    assert by[D(2023, 1, 2)]["week_of_year"] == 1
    assert by[D(2023, 3, 31)]["fiscal_year"] == 2023 and by[D(2023, 3, 31)]["fiscal_quarter"] == 4
    assert by[D(2023, 4, 1)]["fiscal_year"] == 2024 and by[D(2023, 4, 1)]["fiscal_month"] == 1
    assert by[D(2023, 1, 1)]["day_of_week"] == "Sunday" and by[D(2023, 1, 1)]["is_weekend"]
    assert by[D(2023, 1, 1)]["time_key"] == 20230101


def test_t14_literal_current_fy_view_is_empty(spark):
    T = star(spark, [fact(1)])
    assert views.current_fy_performance(T, literal=True).count() == 0
    assert views.current_fy_performance(T).count() == 1


def test_t16_null_category_gets_null_share(spark):
    commodities = [dict(commodity_key=1, commodity_id="C1", parent_category=None, is_current_record=True),
                   dict(commodity_key=2, commodity_id="C2", parent_category="X", is_current_record=True)]
    vendors = [dict(_dimrow(1, "V1"), region="R", country="C")]
    T = star(spark, [fact(1, ck=1), fact(2, ck=2)], vendors=vendors, commodities=commodities)
    rows = {r["parent_category"]: r for r in reports.global_sourcing(T, 2024).collect()}
    assert rows[None]["category_share"] is None and rows["X"]["category_share"] == 100.0


def test_t19_fill_fiscal_sets_both_columns(spark):
    spend = mk(spark, "spend_transactions", [dict(transaction_id=1, transaction_date=D(2023, 2, 10)),
                                             dict(transaction_id=2, transaction_date=D(2023, 7, 1), fiscal_year=2020)])
    rows = {r["transaction_id"]: r for r in facts.fill_fiscal(spend).collect()}
    assert (rows[1]["fiscal_year"], rows[1]["fiscal_quarter"]) == (2023, 4)
    assert (rows[2]["fiscal_year"], rows[2]["fiscal_quarter"]) == (2020, None)


def test_t20_null_passes_check_and_split_is_complete(spark):
    df = spark.createDataFrame([("Strategic",), ("Bogus",), (None,)], "vendor_tier string")
    rules = quality.rules_for("vendors", df)
    valid, rejected = quality.apply_checks(df, rules)
    assert sorted(r[0] or "" for r in valid.collect()) == ["", "Strategic"]
    assert [r["failed_rules"] for r in rejected.collect()] == [["vendor_tier_allowed"]]
    assert valid.count() + rejected.count() == df.count()


def test_t20_strict_mode_raises_source_message(spark):
    from decimal import Decimal
    df = mk(spark, "fact_spend_analytics", [fact(1, tk=20080101), fact(2, spend="1.00")])
    rules = quality.rules_for("fact_spend_analytics", df)
    with pytest.raises(quality.CheckViolation, match="Invalid time_key format"):
        quality.apply_checks(df, rules, strict=True, table="fact_spend_analytics")
    assert Decimal("1.00")


def test_t24_full_outer_year_on_one_side(spark):
    spend = mk(spark, "spend_transactions", [dict(transaction_id=1, fiscal_year=2020)])
    T = dict(star(spark, [fact(1, tk=20230501)]), spend_transactions=spend)
    rows = {(r["fiscal_year"], r["analytics_count"]): r for r in quality.recon_fy(T).collect()}
    assert rows[(None, 1)]["variance"] is None
    assert rows[(2020, None)]["operational_count"] == 1


def test_d7_point_in_time(spark):
    dim = mk(spark, "dim_vendors", [
        dict(_dimrow(1, "V1"), effective_end_date=D(2019, 12, 31), is_current_record=False),
        _dimrow(2, "V1", start=D(2020, 1, 1))])
    assert [r["vendor_key"] for r in dims.dim_as_of(dim, "2019-06-30").collect()] == [1]
    assert [r["vendor_key"] for r in dims.dim_as_of(dim, "2021-01-01").collect()] == [2]


def test_d10_levels(spark):
    bu = mk(spark, "business_units", [dict(business_unit_id="A", business_unit_name="a"),
                                      dict(business_unit_id="B", business_unit_name="b", parent_unit_id="A"),
                                      dict(business_unit_id="C", business_unit_name="c", parent_unit_id="B"),
                                      dict(business_unit_id="X", business_unit_name="x", parent_unit_id="Y"),
                                      dict(business_unit_id="Y", business_unit_name="y", parent_unit_id="X")])
    got = {r["business_unit_id"]: (r["level_in_hierarchy"], r["business_unit_key"])
           for r in dims.dim_business_units(bu, D(2023, 11, 5)).collect()}
    assert got == {"A": (1, 1), "B": (2, 2), "C": (3, 3), "X": (None, 4), "Y": (None, 5)}


def test_f1_twice_adds_nothing_and_no_orphans(spark, T001):
    new = facts.fact_spend_new(T001["spend_transactions"], T001["dim_vendors"], T001["dim_commodities"],
                               T001["dim_time"], T001["fact_spend_analytics"], D(2023, 11, 5))
    loaded = T001["fact_spend_analytics"].select(*new.columns).unionByName(new)
    again = facts.fact_spend_new(T001["spend_transactions"], T001["dim_vendors"], T001["dim_commodities"],
                                 T001["dim_time"], loaded, D(2023, 11, 5))
    assert new.count() > 0 and again.count() == 0
    T = dict((k, T001[k]) for k in ("dim_vendors", "dim_commodities", "dim_time"))
    T["fact_spend_analytics"] = new
    assert quality.orphan_facts(T).collect()[0]["orphaned_count"] == 0


def test_orphans_are_counted_once(spark):
    """A fact that misses several members is one orphan; a NULL key is a missing one."""
    rows = [(v, c, t) for v in (1, 9, None) for c in (2, 9, None) for t in (3, 9, None)] * 2 + [(1, 2, 3)] * 5
    T = {"fact_spend_analytics": spark.createDataFrame(rows, "vendor_key long, commodity_key long, time_key int"),
         "dim_vendors": spark.createDataFrame([(1,), (1,), (None,)], "vendor_key long"),
         "dim_commodities": spark.createDataFrame([(2,), (None,)], "commodity_key long"),
         "dim_time": spark.createDataFrame([(3,), (3,), (None,)], "time_key int")}
    assert quality.orphan_facts(T).collect()[0]["orphaned_count"] == sum(r != (1, 2, 3) for r in rows)
    assert quality.orphan_facts(dict(T, fact_spend_analytics=T["fact_spend_analytics"].limit(0))).collect()[0]["orphaned_count"] == 0


def test_f8_archive_split_is_a_partition(T001):
    f = T001["fact_spend_analytics"]
    keep, old = facts.archive_split(f, 20181105)
    assert keep.count() + old.count() == f.count()
    assert keep.intersect(old).count() == 0


def test_v3_top_n(T001):
    full = views.top_vendor_spend(T001).collect()
    top = views.top_vendor_spend(T001, 3).collect()
    assert [r["total_spend"] for r in top] == [r["total_spend"] for r in full[:3]]


def test_v8_falsy_parameters_mean_no_filter(T001):
    all_rows = views.get_supplier_performance(T001, None, None).count()
    assert views.get_supplier_performance(T001, 0, "").count() == all_rows
    assert views.get_supplier_performance(T001, 2024, None).count() < all_rows


def test_apply_checks_counts_match(T001):
    df = T001["po_line_items"]
    valid, rejected = quality.apply_checks(df, quality.rules_for("po_line_items", df))
    assert valid.count() + rejected.count() == df.count()
    assert rejected.filter(F.array_contains("failed_rules", "line_amount_matches")).count() > 0


def test_t15_strategic_vendors_counts_fact_rows(spark):
    T = star(spark, [fact(1, tk=20230501), fact(2, tk=20230601), fact(3, tk=20230701)])
    rows = reports.risk_exposure(T, D(2023, 11, 5)).collect()
    assert [(r["vendor_count"], r["strategic_vendors"]) for r in rows] == [(1, 3)]


def test_t16_esg_share_is_of_all_spend_of_the_year(spark):
    vendors = [dict(_dimrow(1, "V1"), diversity_classification="Women"),
               dict(_dimrow(2, "V2"), diversity_classification=None),
               dict(_dimrow(3, "V3", vendor_tier="Old"), diversity_classification="Women", is_current_record=False)]
    T = star(spark, [fact(1, vk=1, spend="25.00"), fact(2, vk=2, spend="50.00"), fact(3, vk=3, spend="25.00")],
             vendors=vendors)
    (row,) = reports.esg_diversity(T).collect()
    assert (row["diversity_classification"], row["total_spend"], row["spend_percentage"]) == ("Women", 25.0, 25.0)
