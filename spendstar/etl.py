"""The daily load as one Spark job: operational database -> star schema.

Order: vendor dimension (new vendors, SCD2 changes, close), new commodities,
contracts, business units and missing calendar days are written and published
first, all at once. They are read back, and the new facts (with their KPI
columns) are keyed to what was published, written once to a staging folder
with the rules they fail, checked, and appended. The supplier-performance and
savings facts are rebuilt from the stored facts and published; the
reconciliation runs on the result; the run log is stored in ``etl_log``.

Failure and rerun behaviour:

* facts are keyed to published dimension rows only, read back from storage, so
  a stop between the steps leaves no fact without its dimension rows, and a
  rerun on changed source data cannot renumber rows that facts point to;
* new facts are a version of their own, added to the fact table's others by
  one manifest; history is never rewritten, and nothing is visible before;
* which transactions are loaded is known from the index of loaded ids beside
  the facts; ids are written before the facts and count from the moment that
  the facts' version is published. No load reads the facts for it;
* a rerun, under the same ``run_id`` or another, skips what is published and
  does the rest.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .operators.dims import dim_business_units, dim_contracts, dim_time, new_dim_commodities
from .operators.facts import (enrich_facts, fact_savings_realization, fact_spend_new, fact_supplier_performance,
                              fill_fiscal)
from .operators.monitor import observed, run_log
from .operators.quality import check_consistency, orphan_facts, rules_for, tag_failures
from .operators.scd2 import scd2_apply
from .params import as_date
from .plans.prefix import assign_keys
from .sources import io, schemas
from .sources.fixtures import OPERATIONAL_TABLES
from .sources.loaded_ids import add_ids, loaded_ids

FACTS, QUARANTINE = "fact_spend_analytics", "fact_spend_quarantine"


class LoadRejected(RuntimeError):
    """Raised when the new facts fail the load checks; nothing is published."""


def _conform(df: DataFrame, name: str, drop=()) -> DataFrame:
    return io.conform(df, schemas.STAR[name], schemas.DEFAULTS.get(name), drop)


def _stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A star table, or an empty one if it was never published."""
    if name in io.manifest(spark, root) or io.exists(spark, f"{root}/{name}"):
        return io.read_table(spark, root, name)
    return spark.createDataFrame([], schemas.STAR[name])


def ids_path(root: str) -> str:
    return f"{root}/_loaded_ids"


def index_of_loaded(spark: SparkSession, root: str) -> DataFrame:
    """Ids of the published facts. Versions that the index does not name yet
    (facts published by other means, a first load) are taken in once."""
    versions = io.table_versions(spark, root, FACTS)
    noted = set(io.manifest(spark, root).get("_loaded_ids", []))
    for v in [v for v in versions if v not in noted]:
        path = f"{root}/{FACTS}/{v}" if v != "." else f"{root}/{FACTS}"
        add_ids(spark, ids_path(root), spark.read.schema(schemas.STAR[FACTS]).parquet(path), v)
        io.note(spark, root, "_loaded_ids", v)
    return loaded_ids(spark, ids_path(root), committed=versions)


def load_dimensions(spark: SparkSession, op, root: str, day, run_id: str) -> dict[str, int]:
    """Write and publish the next version of every dimension; rows by table, as observed by the writes."""
    names = ("dim_vendors", "dim_commodities", "dim_time", "dim_contracts", "dim_business_units")
    based_on = {n: io.manifest(spark, root).get(n) for n in names}
    now = {n: _stored(spark, root, n) for n in names}
    new_c = new_dim_commodities(op["commodities"], op["commodity_profiles"], now["dim_commodities"], day)
    fresh_k = op["contracts"].join(now["dim_contracts"].select("contract_id"), "contract_id", "left_anti")
    fresh_u = now["dim_business_units"].select("business_unit_id")
    units = dim_business_units(op["business_units"], day)
    new_u = assign_keys(units.drop("business_unit_key").join(fresh_u, "business_unit_id", "left_anti"),
                        now["dim_business_units"], "business_unit_key", ["business_unit_id"])
    out = {
        "dim_vendors": _conform(scd2_apply(now["dim_vendors"], op["vendors"], op["supplier_profiles"], day), "dim_vendors"),
        "dim_commodities": now["dim_commodities"].unionByName(_conform(
            assign_keys(new_c, now["dim_commodities"], "commodity_key", ["commodity_id"]), "dim_commodities")),
        "dim_time": now["dim_time"].unionByName(_conform(dim_time(spark, existing=now["dim_time"]), "dim_time")),
        "dim_contracts": now["dim_contracts"].unionByName(_conform(
            dim_contracts(fresh_k, op["risk_assessments"], day, now["dim_contracts"]), "dim_contracts")),
        "dim_business_units": now["dim_business_units"].unionByName(_conform(new_u, "dim_business_units")),
    }
    if all(v == f"v{run_id}" for v in based_on.values()):        # this run has published them
        return dict.fromkeys(names, 0)
    seen = {n: observed(df, f"{n}-{run_id}-{uuid.uuid4().hex[:8]}") for n, df in out.items()}
    io.publish({n: df for n, (df, _) in seen.items()}, root, run_id=run_id, based_on=based_on)
    return {n: watch.get["rows"] for n, (_, watch) in seen.items()}


def build_summaries(spark: SparkSession, op, root: str, star, facts: DataFrame, day, run_id: str, rebuild: bool) -> int:
    """F4 and F5 from the stored facts; rows written. The savings are kept by
    fiscal year: only the years that the run's own facts fall into are computed
    and written, the others stay in their files. ``rebuild`` (or a table that
    is not kept by year yet) computes every year."""
    name, run = "fact_savings_realization", f"{run_id}-summary"
    metrics, seen = observed(_conform(fact_supplier_performance(op["performance_metrics"], star["dim_vendors"], star["dim_time"], day),
                                      "fact_supplier_performance"), f"performance-{uuid.uuid4().hex[:8]}")
    done = f"v{run}" in io.table_versions(spark, root, "fact_supplier_performance")
    io.publish({"fact_supplier_performance": metrics}, root, run_id=run)
    rows = 0 if done else seen.get["rows"]
    by_year = [v for v in io.table_versions(spark, root, name) if "/part=" in v]
    years = None
    if by_year and not rebuild:
        own = spark.read.schema(schemas.STAR[FACTS]).parquet(f"{root}/{FACTS}/v{run_id}")
        years = sorted(r[0] for r in own.select("time_key").distinct().join(star["dim_time"].select("time_key", "fiscal_year"), "time_key")
                       .select("fiscal_year").distinct().collect())
        if not years:
            return rows
    savings, seen = observed(_conform(fact_savings_realization(facts, star["dim_commodities"], star["dim_time"],
                                                               op["savings_targets"], day, years), name),
                             f"savings-{uuid.uuid4().hex[:8]}")
    io.publish_parts(savings, root, name, "fiscal_year", years, run)
    return rows + seen.get["rows"]


def daily_load(spark: SparkSession, operational_root: str, analytics_root: str, as_of,
               incremental_days: int | None = None, run_id: str | None = None, quarantine: bool = False,
               rebuild_summaries: bool = False) -> DataFrame:
    """Run one load for day ``as_of``; returns the run's log (M4), which is
    also appended to ``etl_log``. ``incremental_days`` restricts facts to
    transactions dated in the last N days (F2); the default loads the whole
    backlog (F1). New facts that fail a rule stop the load (``LoadRejected``);
    with ``quarantine`` they go to the table ``fact_spend_quarantine``, with the
    rules they fail, and the others are loaded. Their transactions are not
    marked as loaded, so a later load tries them again.

    Savings are computed for the fiscal years that the new facts fall into;
    ``rebuild_summaries`` computes all (after changed targets or commodities).

    The log's counts are observed by the writes themselves: no step reads a
    table again to count it. A step that an earlier attempt of the run has
    published counts 0."""
    day = as_date(as_of)
    run_id = run_id or f"{day:%Y%m%d}-{int(time.time())}"
    op = io.read_tables(spark, operational_root, OPERATIONAL_TABLES)
    root, log = analytics_root, []

    t = time.perf_counter()
    rows = load_dimensions(spark, op, root, day, run_id)
    log.append(("dimensions", sum(rows.values()), None, 0, time.perf_counter() - t))

    t = time.perf_counter()
    star = {n: io.read_table(spark, root, n) for n in rows}       # what is published, whatever the source does now
    version = f"v{run_id}"
    if version not in io.table_versions(spark, root, FACTS):     # else this run has published them
        since = day - _dt.timedelta(days=incremental_days) if incremental_days else None
        spend = fill_fiscal(op["spend_transactions"])
        new = fact_spend_new(spend, star["dim_vendors"], star["dim_commodities"], star["dim_time"], None, day, since=since,
                             index=index_of_loaded(spark, root))
        rich = _conform(enrich_facts(new, spend, star["dim_vendors"], star["dim_contracts"], op["contracts"],
                                     op["purchase_orders"], star["dim_business_units"]), FACTS)
        staging = f"{root}/_staging/{run_id}-{uuid.uuid4().hex[:8]}"
        watch = Observation(f"facts-{uuid.uuid4().hex[:8]}")
        tag_failures(rich, rules_for(FACTS, rich)).observe(
            watch, F.count(F.lit(1)).alias("n"), F.count(F.when(F.size("failed_rules") > 0, 1)).alias("bad")).write.parquet(staging)
        staged, n, bad = spark.read.parquet(staging), watch.get["n"], watch.get["bad"]
        if bad and not quarantine:
            raise LoadRejected(f"{bad} new facts fail the fact rules; run {run_id} appended none, see {staging}")
        fresh = staged.filter(F.size("failed_rules") == 0).drop("failed_rules")
        out = {FACTS: fresh}
        if bad:
            out[QUARANTINE] = staged.filter(F.size("failed_rules") > 0).withColumn("run_id", F.lit(run_id))
        add_ids(spark, ids_path(root), fresh, version)           # count once the facts are published
        io.note(spark, root, "_loaded_ids", version)
        io.publish(out, root, run_id=run_id, add=list(out))
    else:
        n = bad = 0
    log.append(("facts", n, n - bad, bad, time.perf_counter() - t))

    t = time.perf_counter()
    facts = io.read_table(spark, root, "fact_spend_analytics")
    rows = build_summaries(spark, op, root, star, facts, day, run_id, rebuild_summaries)
    log.append(("summary_facts", rows, rows, 0, time.perf_counter() - t))

    t = time.perf_counter()
    both = {**{n: op[n] for n in op}, **star, FACTS: facts}
    checked = check_consistency(both).first()
    orphans = orphan_facts(both).first()["orphaned_count"]
    log.append((f"reconciliation:{checked['status']}", checked["analytics_facts"], None, int(orphans), time.perf_counter() - t))
    out = run_log(spark, log).withColumn("run_id", F.lit(run_id))
    out.coalesce(1).write.mode("append").parquet(f"{root}/etl_log")
    return out
