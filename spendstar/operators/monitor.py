"""Load monitoring: run summary, daily volume, freshness, run log, alerts."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.agg import dec
from ..params import as_date
from .dims import calendar
from .quality import dq_check_violations, orphan_facts


def etl_summary(facts: DataFrame) -> DataFrame:
    """M1: last and first load date, distinct load dates, rows loaded."""
    return facts.agg(F.lit("ETL Summary").alias("report_type"),
                     F.max("load_date").alias("last_etl_date"),
                     F.countDistinct("load_date").alias("total_etl_runs"),
                     F.count(F.lit(1)).alias("total_records_loaded"),
                     F.min("load_date").alias("first_etl_date"))


def etl_daily_volume(facts: DataFrame, as_of, days: int = 30) -> DataFrame:
    """M2: per load date in the last ``days`` days, newest first: rows,
    spend, distinct vendors and commodities."""
    since = as_date(as_of) - _dt.timedelta(days=days)
    return (facts.filter(F.col("load_date") >= F.lit(since))
            # combined per vendor and commodity first, so the distinct counts expand those rows, not the facts
            .groupBy("load_date", "vendor_key", "commodity_key")
            .agg(F.count(F.lit(1)).alias("_n"), F.sum(dec("spend_amount")).alias("_spend"))
            .groupBy("load_date")
            .agg(F.sum("_n").alias("records_loaded"),
                 F.sum("_spend").cast("double").alias("total_spend_loaded"),
                 F.countDistinct("vendor_key").alias("vendors_affected"),
                 F.countDistinct("commodity_key").alias("commodities_affected"))
            .orderBy(F.desc("load_date")))


def data_freshness(facts: DataFrame, dim_time: DataFrame, as_of) -> DataFrame:
    """M3: latest fact day, ``as_of`` and whole days between them."""
    day = D.lit_date(as_of)
    j = facts.select("time_key").join(calendar(dim_time, "time_key", "date_actual"), "time_key")
    return j.agg(F.lit("Data Freshness").alias("check_type"),
                 F.max("date_actual").alias("latest_transaction_date"),
                 day.alias("current_date"),
                 F.datediff(day, F.max("date_actual")).cast("double").alias("days_behind"))


def observed(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """M4: attach row-count metrics to ``df``; they are filled in by the
    action that writes it (no extra pass)."""
    obs = Observation(stage)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def run_log(spark, entries) -> DataFrame:
    """M4: ``etl_log`` rows from (stage, rows_in, rows_inserted,
    rows_rejected, seconds) tuples collected from observations; the DQ pass
    rate is inserted / (inserted + rejected)."""
    df = spark.createDataFrame(
        list(entries), "stage string, rows_in long, rows_inserted long, rows_rejected long, seconds double")
    return df.withColumn("dq_pass_rate", F.try_divide(F.col("rows_inserted").cast("double"),
                                                      (F.col("rows_inserted") + F.col("rows_rejected")).cast("double")))


def dq_alerts(results: Mapping[str, DataFrame], vendor_tolerance: int = 10, ratio_floor: float = 0.9,
              spend_tolerance: float = 1000.0) -> DataFrame:
    """M5: one row per failed check (check_name, severity, measured,
    threshold) from the reconciliation and rule results.

    ``results`` holds the outputs of recon_vendors, recon_spend_status,
    orphan_facts, check_consistency and dq_check_violations (any subset)."""
    parts = []
    cols = ["check_name", "severity", "measured", "threshold"]
    if "recon_vendor_count" in results:
        r = results["recon_vendor_count"]
        parts.append(r.filter(F.abs("variance") > vendor_tolerance).select(
            F.lit("vendor_count_variance").alias("check_name"), F.lit("WARNING").alias("severity"),
            F.col("variance").cast("double").alias("measured"), F.lit(float(vendor_tolerance)).alias("threshold")))
    if "recon_spend_status" in results:
        r = results["recon_spend_status"]
        parts.append(r.filter(F.col("status") == "FAIL").select(
            F.lit("spend_reconciliation").alias("check_name"), F.lit("CRITICAL").alias("severity"),
            F.col("variance").alias("measured"), F.lit(float(spend_tolerance)).alias("threshold")))
    if "orphan_facts" in results:
        r = results["orphan_facts"]
        parts.append(r.filter(F.col("orphaned_count") > 0).select(
            F.lit("orphan_facts").alias("check_name"), F.lit("WARNING").alias("severity"),
            F.col("orphaned_count").cast("double").alias("measured"), F.lit(0.0).alias("threshold")))
    if "consistency_check" in results:
        r = results["consistency_check"]
        parts.append(r.filter(F.col("status") != "PASSED").select(
            F.lit("fact_coverage").alias("check_name"), F.lit("WARNING").alias("severity"),
            F.col("transaction_ratio").alias("measured"), F.lit(float(ratio_floor)).alias("threshold")))
    if "dq_check_violations" in results:
        r = results["dq_check_violations"]
        parts.append(r.filter(F.col("violations") > 0).select(
            F.concat_ws(".", "table_name", "rule_name").alias("check_name"), F.lit("ERROR").alias("severity"),
            F.col("violations").cast("double").alias("measured"), F.lit(0.0).alias("threshold")))
    out = parts[0].select(*cols)
    for p in parts[1:]:
        out = out.unionByName(p.select(*cols))
    return out


def results_of_profile(T: Mapping[str, DataFrame], of: DataFrame, vendor_tolerance: int = 10, ratio_floor: float = 0.9,
                       spend_tolerance: float = 1000.0) -> dict[str, DataFrame]:
    """What ``dq_alerts`` reads, taken from a stored profile (``quality_profile``):
    no table is read again but the facts' keys, for the orphans."""

    def n(table: str, kind: str, name: str = ""):
        mine = (F.col("table_name") == table) & (F.col("kind") == kind) & (F.col("name") == name)
        return F.max(F.when(mine, F.col("n")))

    def amount(table: str):
        return F.max(F.when((F.col("table_name") == table) & (F.col("kind") == "amount"), F.col("amount")))

    one = of.agg(n("vendors", "count", "is_active").alias("active"), n("dim_vendors", "count", "is_current_record").alias("current"),
                 n("vendors", "rows").alias("vendors"), n("dim_vendors", "rows").alias("versions"),
                 n("spend_transactions", "rows").alias("transactions"), n("fact_spend_analytics", "rows").alias("facts"),
                 amount("spend_transactions").alias("spent"), amount("fact_spend_analytics").alias("booked"))
    off = F.abs(F.col("spent") - F.col("booked"))
    ratio = F.when(F.col("transactions") > 0, F.col("facts").cast("double") / F.col("transactions").cast("double")).otherwise(F.lit(0.0))
    good = (F.abs(F.col("vendors") - F.col("versions")) <= vendor_tolerance) & (ratio > ratio_floor)
    return {
        "recon_vendor_count": one.select((F.col("active") - F.col("current")).alias("variance")),
        "recon_spend_status": one.select(off.cast("double").alias("variance"),
                                         F.when(off < F.lit(spend_tolerance), "PASS").otherwise("FAIL").alias("status")),
        "orphan_facts": orphan_facts(T),
        "consistency_check": one.select(F.when(good, "PASSED").otherwise("WARNING").alias("status"),
                                        F.round(ratio, 3).alias("transaction_ratio")),
        "dq_check_violations": dq_check_violations(T, of),
    }
