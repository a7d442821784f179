"""The daily load end to end on stored tables: facts appended, SCD2 applied,
rerun adds nothing."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from spendstar.etl import daily_load
from spendstar.sources import io, schemas
from spendstar.sources.fixtures import OPERATIONAL_TABLES


def test_daily_load_and_rerun(spark, T001, scratch):
    op_root, an_root = os.path.join(scratch, "op"), os.path.join(scratch, "an")
    for name in OPERATIONAL_TABLES:
        T001[name].write.parquet(os.path.join(op_root, name))
    star = {n: io.conform(T001[n], schemas.STAR[n]) for n in
            ("dim_vendors", "dim_commodities", "dim_time", "fact_spend_analytics")}
    io.publish(star, an_root, run_id="initial")
    before = io.read_table(spark, an_root, "fact_spend_analytics").count()

    log = {r["stage"]: r for r in daily_load(spark, op_root, an_root, dt.date(2023, 11, 5), run_id="r1").collect()}
    facts = io.read_table(spark, an_root, "fact_spend_analytics")
    added = facts.count() - before
    assert added == log["facts"]["rows_inserted"] > 0
    # no transaction loaded twice beyond duplicates already in the source
    src_dups = T001["spend_transactions"].groupBy("transaction_id").count().filter("count > 1").count()
    assert facts.groupBy("fact_key").count().filter("count > 1").count() <= src_dups
    dv = io.read_table(spark, an_root, "dim_vendors")
    closed_today = dv.filter(F.col("effective_end_date") == dt.date(2023, 11, 4)).count()
    assert closed_today > 0
    assert dv.filter("is_current_record").groupBy("vendor_id").count().filter("count > 1").count() == 0

    own = (facts.filter("load_date = '2023-11-05' and vendor_key >= 0").join(dv.select("vendor_key", "vendor_id"), "vendor_key")
           .join(T001["spend_transactions"].select(F.col("transaction_id").cast("string").alias("source_transaction_id"),
                                                   F.col("vendor_id").alias("own_vendor")), "source_transaction_id"))
    assert own.count() > 0
    assert spark.read.parquet(os.path.join(an_root, "etl_log")).count() == len(log)
    daily_load(spark, op_root, an_root, dt.date(2023, 11, 5), run_id="r2")
    assert io.read_table(spark, an_root, "fact_spend_analytics").count() == before + added
    assert io.read_table(spark, an_root, "dim_vendors").count() == dv.count()


def test_first_load_into_an_empty_star_keeps_every_fact_on_its_own_rows(spark, T001, scratch):
    """Also after a stop between publishing the dimensions and appending the facts, with a changed source."""
    from spendstar import etl
    op_root, an_root = os.path.join(scratch, "op"), os.path.join(scratch, "an")
    for name in OPERATIONAL_TABLES:
        T001[name].write.parquet(os.path.join(op_root, name))
    op = io.read_tables(spark, op_root, OPERATIONAL_TABLES)
    etl.load_dimensions(spark, op, an_root, dt.date(2023, 11, 5), "stopped")         # and then nothing
    extra = T001["vendors"].limit(1).withColumn("vendor_id", F.lit("V!first"))        # sorts before all others
    T001["vendors"].unionByName(extra).write.mode("overwrite").parquet(os.path.join(op_root, "vendors"))
    daily_load(spark, op_root, an_root, dt.date(2023, 11, 5), run_id="again")
    star = io.read_tables(spark, an_root, ["dim_vendors", "dim_commodities", "fact_spend_analytics", "dim_contracts",
                                           "fact_supplier_performance", "fact_savings_realization"])
    src = T001["spend_transactions"].select(F.col("transaction_id").cast("string").alias("source_transaction_id"),
                                            F.col("vendor_id").alias("sv"), F.col("commodity_id").alias("sc"))
    f = star["fact_spend_analytics"]
    j = (f.join(star["dim_vendors"].select("vendor_key", "vendor_id"), "vendor_key")
          .join(star["dim_commodities"].select("commodity_key", "commodity_id"), "commodity_key")
          .withColumnsRenamed({"vendor_id": "sv", "commodity_id": "sc"})
          .join(src, ["source_transaction_id", "sv", "sc"], "left_semi"))
    assert f.count() == j.count() > 0
    assert f.filter("savings_amount is not null").count() > 0
    for n, k in (("dim_vendors", "vendor_key"), ("dim_commodities", "commodity_key"), ("dim_contracts", "contract_key")):
        assert star[n].count() == star[n].select(k).distinct().count() > 0
    assert star["fact_supplier_performance"].count() > 0


def _started(spark, T001, scratch):
    op_root, an_root = os.path.join(scratch, "op"), os.path.join(scratch, "an")
    for name in OPERATIONAL_TABLES:
        T001[name].write.parquet(os.path.join(op_root, name))
    io.publish({n: io.conform(T001[n], schemas.STAR[n]) for n in
                ("dim_vendors", "dim_commodities", "dim_time", "fact_spend_analytics")}, an_root, run_id="initial")
    return op_root, an_root


def test_stops_between_the_steps_and_reruns_of_the_same_run(spark, T001, scratch, monkeypatch):
    """One run, stopped before its facts' ids, between ids and facts, before the summaries and before the log; no
    attempt reads the facts to find what is loaded."""
    import pytest

    from spendstar import etl
    op_root, an_root = _started(spark, T001, scratch)
    before = {r[0] for r in io.read_table(spark, an_root, "fact_spend_analytics").select("fact_key").collect()}
    plans, real_new = [], etl.fact_spend_new

    def watched(*a, **k):
        out = real_new(*a, **k)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(etl, "fact_spend_new", watched)
    real = {n: getattr(etl, n) for n in ("add_ids", "run_log")} | {"publish": io.publish}

    def stop_when(which):
        def make(name):
            def call(*a, **k):
                if name == which[0] and which[1](*a, **k):
                    raise RuntimeError("stopped")
                return real[name](*a, **k)
            return call
        for n in ("add_ids", "run_log"):
            monkeypatch.setattr(etl, n, make(n))
        monkeypatch.setattr(io, "publish", make("publish"))

    stops = [("add_ids", lambda *a, **k: a[3] == "vr1"), ("publish", lambda out, *a, **k: "fact_spend_analytics" in out),
             ("publish", lambda out, *a, **k: "fact_supplier_performance" in out), ("run_log", lambda *a: True)]
    for which in stops:
        stop_when(which)
        with pytest.raises(RuntimeError, match="stopped"):
            daily_load(spark, op_root, an_root, dt.date(2023, 11, 5), run_id="r1")
        now = io.read_table(spark, an_root, "fact_spend_analytics")
        assert (now.count() == len(before)) == (which in stops[:2])
    stop_when(("none", None))
    daily_load(spark, op_root, an_root, dt.date(2023, 11, 5), run_id="r1")
    facts = io.read_table(spark, an_root, "fact_spend_analytics")
    dims = [io.read_table(spark, an_root, n) for n in ("dim_vendors", "dim_commodities", "dim_time")]
    from spendstar.operators.facts import fact_spend_new
    whole = fact_spend_new(T001["spend_transactions"], *dims, T001["fact_spend_analytics"], dt.date(2023, 11, 5))
    want = sorted([r[0] for r in whole.select("fact_key").collect()]
                  + [r[0] for r in T001["fact_spend_analytics"].select("fact_key").collect()])
    repeated = {r[0] for r in T001["spend_transactions"].groupBy("transaction_id").count().filter("count > 1").collect()}
    have = sorted(r[0] for r in facts.select("fact_key").collect())
    once = [k for k in have if k not in repeated]
    assert once == [k for k in want if k not in repeated] and set(have) == set(want) and len(want) > len(before)
    assert len(plans) == 3 and all("load_run" in p and "spend_amount:" not in p for p in plans)
    vendors = dims[0]
    assert vendors.count() == vendors.select("vendor_key").distinct().count()
    # another run finds nothing new, also for transactions that were dated anew meanwhile
    moved = spark.read.parquet(os.path.join(op_root, "spend_transactions")).withColumn(
        "transaction_date", F.lit("2023-11-04").cast("date"))
    moved.write.parquet(os.path.join(scratch, "moved"))
    spark.read.parquet(os.path.join(scratch, "moved")).write.mode("overwrite").parquet(os.path.join(op_root, "spend_transactions"))
    daily_load(spark, op_root, an_root, dt.date(2023, 11, 5), run_id="r2", incremental_days=7, quarantine=True)
    late = [r[0] for r in io.read_table(spark, an_root, "fact_spend_analytics").select("fact_key").collect()]
    assert sorted(k for k in late if k in set(have)) == have      # none of them once more


def test_quarantine_and_observed_counts(spark, T001, scratch):
    import pytest

    from spendstar.etl import LoadRejected
    op_root, an_root = _started(spark, T001, scratch)
    spend = spark.read.parquet(os.path.join(op_root, "spend_transactions"))
    bad = spend.withColumn("total_amount", F.when(F.col("transaction_id") % 10 == 7, -F.col("total_amount")).otherwise(F.col("total_amount")))
    bad.write.parquet(os.path.join(scratch, "bad"))
    spark.read.parquet(os.path.join(scratch, "bad")).write.mode("overwrite").parquet(os.path.join(op_root, "spend_transactions"))
    before = io.read_table(spark, an_root, "fact_spend_analytics").count()
    with pytest.raises(LoadRejected):
        daily_load(spark, op_root, an_root, dt.date(2023, 11, 5), run_id="a")
    assert io.read_table(spark, an_root, "fact_spend_analytics").count() == before
    log = {r["stage"]: r for r in daily_load(spark, op_root, an_root, dt.date(2023, 11, 5), run_id="b", quarantine=True).collect()}
    facts, held = io.read_table(spark, an_root, "fact_spend_analytics"), spark.read.parquet(*io.table_paths(spark, an_root, "fact_spend_quarantine"))
    f = log["facts"]
    assert f["rows_inserted"] == facts.count() - before > 0 and f["rows_rejected"] == held.count() > 0
    assert f["rows_in"] == f["rows_inserted"] + f["rows_rejected"] and f["dq_pass_rate"] == f["rows_inserted"] / f["rows_in"]
    assert held.filter("spend_amount >= 0").isEmpty() and held.filter("not array_contains(failed_rules, 'spend_amount_non_negative')").isEmpty()
    assert facts.filter("spend_amount < 0").isEmpty()
    dims = sum(io.read_table(spark, an_root, n).count() for n in
               ("dim_vendors", "dim_commodities", "dim_time", "dim_contracts", "dim_business_units"))
    assert log["dimensions"]["rows_in"] == 0 or log["dimensions"]["rows_in"] == dims
    # corrected at the source, the held transactions are loaded
    T001["spend_transactions"].write.mode("overwrite").parquet(os.path.join(op_root, "spend_transactions"))
    n, loaded = held.count(), facts.count()
    daily_load(spark, op_root, an_root, dt.date(2023, 11, 5), run_id="c", quarantine=True)
    assert io.read_table(spark, an_root, "fact_spend_analytics").count() == loaded + n


def test_a_load_of_one_year_writes_that_year_of_savings(spark, T001, scratch):
    """Savings by fiscal year: what a load does not touch stays in its files; the result is that of a full rebuild."""
    from spendstar.operators.facts import fact_savings_realization
    op_root, an_root = _started(spark, T001, scratch)
    spend = T001["spend_transactions"]
    year = F.when(F.month("transaction_date") >= 4, F.year("transaction_date") + 1).otherwise(F.year("transaction_date"))
    early = spend.filter(year != 2024)
    early.write.mode("overwrite").parquet(os.path.join(op_root, "spend_transactions"))
    daily_load(spark, op_root, an_root, dt.date(2023, 11, 5), run_id="one")
    first = set(io.table_versions(spark, an_root, "fact_savings_realization"))
    assert first == {"vone-summary/part=2023", "vone-summary/part=2024"}
    spend.filter(F.col("transaction_id").isNotNull()).write.mode("overwrite").parquet(os.path.join(op_root, "spend_transactions"))
    log = {r["stage"]: r for r in daily_load(spark, op_root, an_root, dt.date(2023, 11, 5), run_id="two").collect()}
    assert log["facts"]["rows_inserted"] > 0
    assert set(io.table_versions(spark, an_root, "fact_savings_realization")) == {"vone-summary/part=2023", "vtwo-summary/part=2024"}
    # no new facts: nothing is written
    daily_load(spark, op_root, an_root, dt.date(2023, 11, 5), run_id="three")
    assert "vtwo-summary/part=2024" in io.table_versions(spark, an_root, "fact_savings_realization")
    got = io.read_table(spark, an_root, "fact_savings_realization")
    star = {n: io.read_table(spark, an_root, n) for n in ("fact_spend_analytics", "dim_commodities", "dim_time")}
    whole = fact_savings_realization(star["fact_spend_analytics"], star["dim_commodities"], star["dim_time"], T001["savings_targets"],
                                     dt.date(2023, 11, 5))
    cols = ["savings_key", "fiscal_year", "realized_savings", "forecasted_savings", "realization_rate"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, whole.select(*cols).collect()))
    # one year's computation reads that year's days only
    import contextlib
    import io as text_io
    buf = text_io.StringIO()
    with contextlib.redirect_stdout(buf):
        star["fact_spend_analytics"].filter(F.col("time_key").between(20230401, 20240331)).explain("formatted")
    assert "GreaterThanOrEqual(time_key,20230401)" in buf.getvalue()


def test_cli_health_check_and_reports(spark, T001, scratch, capsys):
    from spendstar.__main__ import main
    op_root, an_root = os.path.join(scratch, "op"), os.path.join(scratch, "an")
    for name in OPERATIONAL_TABLES:
        T001[name].write.parquet(os.path.join(op_root, name))
    io.publish({n: io.conform(T001[n], schemas.STAR[n]) for n in
                ("dim_vendors", "dim_commodities", "dim_time", "fact_spend_analytics")}, an_root, run_id="initial")
    main(["health-check", "--operational", op_root, "--analytics", an_root])
    assert "HEALTHY" in capsys.readouterr().out
    out = os.path.join(scratch, "reports")
    main(["reports", "--operational", op_root, "--analytics", an_root, "--out", out])
    run = capsys.readouterr().out.strip().splitlines()[-1]
    assert len(os.listdir(os.path.join(out, run))) == 17
