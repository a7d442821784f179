"""Operators checked by unit test only: view registration (S8), schema
presence (Q6), run log (M4), report catalogue (S9), checkpointed slices."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from spendstar.operators import monitor, quality, reports, risk, views


def test_register_views_and_query_them(spark, T001):
    names = views.register_views(T001, dt.date(2023, 11, 5))
    assert "vw_monthly_spend_summary" in names and "fact_spend_analytics" in names
    n = spark.sql("select count(*) from vw_current_vendors").collect()[0][0]
    assert n == T001["dim_vendors"].filter("is_current_record").count()


def test_verify_schema(T001):
    ok = quality.verify_schema(T001, quality.REQUIRED_STAR, "star").collect()[0]
    assert ok["status"] == "PASSED" and ok["missing_tables"] == ""
    bad = quality.verify_schema(T001, ["dim_vendors", "dim_nothing"], "star").collect()[0]
    assert bad["status"] == "FAILED" and bad["missing_tables"] == "dim_nothing"


def test_verify_schema_counts_foreign_keys(T001):
    assert quality.verify_schema(T001, quality.REQUIRED_STAR, "star").collect()[0]["foreign_keys"] == 5


def test_null_columns_are_counted(spark, T001):
    T = {"vendors": T001["vendors"].withColumn("vendor_name", F.when(F.col("vendor_id") != "x", F.lit(None)).cast("string")),
         "contracts": T001["contracts"].drop("vendor_id")}
    got = {(r["table_name"], r["column_name"]): (r["status"], r["null_rows"]) for r in quality.dq_null_columns(T).collect()}
    assert len(got) == sum(len(c) for _, c in quality.NOT_NULL)
    assert got["vendors", "vendor_name"] == (quality.CHECKED, T["vendors"].filter("vendor_id <> 'x'").count())
    assert got["contracts", "vendor_id"] == (quality.NO_COLUMN, None)
    assert got["purchase_orders", "po_date"] == (quality.NO_TABLE, None)


def test_observed_run_log(spark, T001):
    df, obs = monitor.observed(T001["vendors"], "vendors")
    df.write.format("noop").mode("overwrite").save()
    rows = obs.get["rows"]
    log = monitor.run_log(spark, [("vendors", rows, rows - 2, 2, 0.5)]).collect()[0]
    assert rows == T001["vendors"].count()
    assert log["dq_pass_rate"] == (rows - 2) / rows


def test_run_reports_catalogue(T001):
    out = reports.run_reports(T001, dt.date(2023, 11, 5), 2024)
    assert len(out) == 17
    assert out["supplier_performance"].count() == reports.supplier_performance(T001, 2024).count()


def test_large_amounts_do_not_cancel_in_the_anomaly_score(spark):
    rows = [(i, 1, 1, 50_000_000.0 + (i % 2) * 0.5) for i in range(100)]
    f = spark.createDataFrame(rows, "fact_key long, vendor_key long, commodity_key long, spend_amount double") \
             .withColumn("spend_amount", F.col("spend_amount").cast("decimal(18,2)"))
    out = risk.spend_anomalies({"fact_spend_analytics": f}).collect()
    assert {r["stddev_spend"] for r in out} == {0.251259} and all(abs(r["z_score"]) > 0.9 for r in out)


def test_real_means_keep_their_digits(spark):
    from spendstar.functions.agg import davg
    df = spark.createDataFrame([(33.333,), (33.334,), (None,)], "x double")
    assert df.agg(davg("x").alias("m")).first()["m"] == 33.3335


def test_unit_levels_have_no_depth_limit(spark):
    from spendstar.operators.dims import dim_business_units
    rows = [(f"B{i}", "u", f"B{i - 1}" if i else None) for i in range(150)]
    rows += [("X", "u", "Y"), ("Y", "u", "X"), ("Z", "u", "gone")]
    got = {r["business_unit_id"]: r["level_in_hierarchy"] for r in dim_business_units(
        spark.createDataFrame(rows, "business_unit_id string, business_unit_name string, parent_unit_id string"),
        dt.date(2023, 11, 5)).collect()}
    assert got == {f"B{i}": i + 1 for i in range(150)} | {"X": None, "Y": None, "Z": None}


def test_health_of_incomplete_databases(T001):
    """A missing table fails its schema and the health, whatever the counts say."""
    from spendstar.operators import quality
    whole = quality.health_check(T001).first()
    assert (whole["star_schema_status"], whole["operational_schema_status"], whole["overall_status"]) == ("PASSED", "PASSED", "HEALTHY")
    for gone, column in (("contracts", "operational_schema_status"), ("dim_commodities", "star_schema_status")):
        T = {n: T001[n] for n in T001 if n != gone}
        r = quality.health_check(T).first()
        assert r[column] == "FAILED" and r["overall_status"] == "ISSUES_DETECTED"
        assert r["transaction_ratio"] == whole["transaction_ratio"]


def test_profile_gives_all_checks_at_once(T001):
    """One profile for rules, NULL columns, keys, references and alerts equals each check by itself."""
    from spendstar.operators import monitor, quality
    of = quality.quality_profile(T001).cache()
    T = {n: T001[n] for n in T001}
    for check in (quality.dq_check_violations, quality.dq_null_columns, quality.dq_duplicate_keys, quality.dq_fk_violations):
        assert sorted(map(str, check(T, of).collect())) == sorted(map(str, check(T).collect()))
    one = {r["check_name"]: r["measured"] for r in monitor.dq_alerts(monitor.results_of_profile(T, of)).collect()}
    many = {r["check_name"]: r["measured"] for r in monitor.dq_alerts({
        "recon_vendor_count": quality.recon_vendors(T), "recon_spend_status": quality.recon_spend_status(T),
        "orphan_facts": quality.orphan_facts(T), "consistency_check": quality.check_consistency(T),
        "dq_check_violations": quality.dq_check_violations(T)}).collect()}
    assert one == many and one


def test_profile_of_odd_tables(spark):
    """NULL and repeated keys, composite keys, references to nothing, rules on NULL, more measures than one mask holds."""
    from spendstar.operators.profile import profile
    T = {"p": spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", None), ("=b", 3)], "k string, n int"),
         "c": spark.createDataFrame([("a",), ("x",), (None,), ("b",), ("x",), ("-",)], "r string"),
         "e": spark.createDataFrame([], "k string, n int")}
    many = [("p", f"r{i}", f"n <> {i}") for i in range(70)]
    got = {(r["table_name"], r["kind"], r["name"]): r["n"] for r in profile(
        T, rules=many, nulls=[("p", ["k", "n"]), ("e", ["k"])], keys=[("p", ("k",)), ("p", ("k", "n")), ("e", ("k",))],
        references=[("c", "r", "p", "k"), ("p", "k", "e", "k")]).collect()}
    assert [got["p", "rule", f"r{i}"] for i in (0, 1, 2, 3, 69)] == [0, 2, 1, 1, 0]
    assert (got["p", "null", "k"], got["p", "null", "n"], got["e", "null", "k"]) == (1, 1, 0)
    assert [got["p", k, "k"] for k in ("rows", "null_rows", "groups", "group_rows")] == [5, 1, 1, 2]
    assert [got["p", k, "k,n"] for k in ("rows", "null_rows", "groups", "group_rows")] == [5, 2, 1, 2]
    assert [got["e", k, "k"] for k in ("rows", "null_rows", "groups", "group_rows")] == [0, 0, 0, 0]
    assert got["c", "reference", "r>p.k"] == 3 and got["p", "reference", "k>e.k"] == 4


def test_absent_columns_are_reported_not_skipped(T001):
    from spendstar.operators import quality
    T = {n: T001[n] for n in T001}
    T["vendors"] = T["vendors"].drop("vendor_tier")
    rules = quality.dq_check_violations(T).collect()
    assert len(rules) == len(quality.CHECK_RULES)
    lost = [r for r in rules if r["table_name"] == "vendors" and r["status"] == "COLUMN_MISSING"]
    assert lost and all(r["violations"] is None for r in lost)
    assert quality.dq_duplicate_keys(T).count() == len(quality.KEYS)
    assert quality.dq_fk_violations(T).count() == len(quality.FOREIGN_KEYS)
