"""Spend anomaly scoring and supplier risk score (roadmap items of the
source, built from their one-line definitions).

Per-group statistics are grouped aggregates (combined map-side) joined back to
the rows, not windows, which would sort a large vendor x commodity pair whole
inside one task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.agg import davg
from ..session import ensure_checkpoint_dir


def spend_anomalies(T: Mapping[str, DataFrame], min_facts: int = 5, threshold: float = 3.0) -> DataFrame:
    """Z3: z-score of each fact's spend against its vendor x commodity
    history (groups with at least ``min_facts`` facts):
    ``z = (spend - mean) / stddev_samp``; anomalous when ``|z| > threshold``.
    The mean is an exact sum / count, the deviation Spark's ``stddev_samp``
    (central moments, so large amounts do not cancel); reported values are
    rounded to 6 decimals. The statistics are stored once in the checkpoint
    folder: the join back then has two plain inputs, so a small statistics
    table is broadcast and a pair that holds much of the facts is split by
    Spark's skew-join handling."""
    f = T["fact_spend_analytics"].select("fact_key", "vendor_key", "commodity_key", "spend_amount")
    stats = (f.groupBy("vendor_key", "commodity_key")
              .agg(F.count(F.lit(1)).alias("_n"), davg("spend_amount").alias("_mean"),
                   F.stddev_samp(F.col("spend_amount").cast("double")).alias("_sd"))
              .filter(F.col("_n") >= min_facts))
    ensure_checkpoint_dir(f.sparkSession)
    stats = stats.checkpoint(eager=True)
    scored = f.join(stats, ["vendor_key", "commodity_key"])
    z = F.try_divide(F.col("spend_amount").cast("double") - F.col("_mean"), F.col("_sd"))
    return scored.select("fact_key", "vendor_key", "commodity_key",
                         F.col("spend_amount").cast("double").alias("spend_amount"),
                         F.round(F.col("_mean"), 6).alias("mean_spend"),
                         F.round(F.col("_sd"), 6).alias("stddev_spend"),
                         F.round(z, 6).alias("z_score"),
                         F.coalesce(F.abs(z) > F.lit(float(threshold)), F.lit(False)).alias("is_anomaly"))


# Risk level scores (Low 1 ... Critical 4).
RISK_LEVEL_SCORE = [("Low", 1), ("Medium", 2), ("High", 3), ("Critical", 4)]


def supplier_risk_score(T: Mapping[str, DataFrame], as_of, w_assessment: float = 1.0, w_audit: float = 1.0,
                        w_late: float = 1.0) -> DataFrame:
    """Per vendor: mean level score of open assessments on or before
    ``as_of`` (Low 1 ... Critical 4), audit component ``(100 - audit_score) /
    25``, late-payment component ``4 x`` share of the vendor's paid,
    contract-backed transactions paid later than the terms; risk_score is
    the weighted sum (missing components count 0)."""
    day = D.lit_date(as_of)
    level = None
    for name, score in RISK_LEVEL_SCORE:
        level = (F.when(F.col("risk_level") == name, F.lit(score)) if level is None
                 else level.when(F.col("risk_level") == name, F.lit(score)))
    assess = (T["risk_assessments"].filter((F.col("status") == "Open") & (F.col("assessment_date") <= day))
              .groupBy("vendor_id")
              .agg(F.try_divide(F.sum(level).cast("double"), F.count(level).cast("double")).alias("assessment_component")))
    audit = T["supplier_profiles"].select(
        "vendor_id", ((F.lit(100.0) - F.col("audit_score")) / F.lit(25.0)).alias("audit_component"))
    terms = T["contracts"].select("contract_id", "payment_terms")
    paid = (T["spend_transactions"].filter(F.col("payment_date").isNotNull())
            .join(terms, "contract_id")
            .filter(F.col("payment_terms").isNotNull())
            .withColumn("_late", F.datediff("payment_date", "invoice_date") > F.col("payment_terms")))
    late = paid.groupBy("vendor_id").agg(
        (F.lit(4.0) * F.try_divide(F.count(F.when(F.col("_late"), 1)).cast("double"),
                                   F.count(F.lit(1)).cast("double"))).alias("late_payment_component"))
    v = (T["vendors"].select("vendor_id").join(assess, "vendor_id", "left").join(audit, "vendor_id", "left")
         .join(late, "vendor_id", "left"))
    score = (F.lit(float(w_assessment)) * F.coalesce(F.col("assessment_component"), F.lit(0.0))
             + F.lit(float(w_audit)) * F.coalesce(F.col("audit_component"), F.lit(0.0))
             + F.lit(float(w_late)) * F.coalesce(F.col("late_payment_component"), F.lit(0.0)))
    return v.select("vendor_id", "assessment_component", "audit_component", "late_payment_component",
                    score.alias("risk_score"))
