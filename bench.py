"""Benchmark: build the operational + star tables once from the testdata
(timed as ``etl_materialize``), then run every registered operator over the
stored Parquet tables. Per query: one warm-up (which also counts the output
rows), then the median of 3 timed runs, each executed in full through the
``noop`` sink (nothing is collected to the driver).

Prints one JSON line. Environment: BENCH_SF_DIR (default
/root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list,
default all), BENCH_SCRATCH (folder for the stored tables), BENCH_REUSE=1 (keep
tables already stored in BENCH_SCRATCH; for local iteration).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = f"local[{cpus}]"
    scratch = os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="spendstar-bench-")

    from spendstar.plans.catalog import PLANS
    from spendstar.session import build_session
    from spendstar.sources import io
    from spendstar.sources.fixtures import OPERATIONAL_TABLES, STAR_TABLES, FixtureTables

    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus * 2)))
    spark = build_session(master, shuffle_partitions=shuffle,
                          extra={"spark.driver.memory": "16g",
                                 "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
                                 "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")})

    # ETL: derive the operational and star tables and store them as Parquet.
    db = os.path.join(scratch, "db")
    src = FixtureTables(spark, sf_dir)
    t0 = time.perf_counter()
    reuse = os.environ.get("BENCH_REUSE") == "1" and os.path.exists(os.path.join(db, "fact_spend_analytics"))
    for name in ([] if reuse else list(OPERATIONAL_TABLES) + list(STAR_TABLES)):
        df = src[name]
        if name == "fact_spend_analytics":
            # clustered by day: fiscal-year and date-window predicates skip row groups
            df = df.repartitionByRange(cpus * 2, "time_key").sortWithinPartitions("time_key", "vendor_key")
        elif name in ("spend_transactions", "po_line_items", "purchase_orders"):
            df = df.repartition(cpus * 2)
        else:
            df = df.coalesce(1)
        df.write.mode("overwrite").parquet(os.path.join(db, name))
    etl_sec = time.perf_counter() - t0

    T = io.read_tables(spark, db, list(OPERATIONAL_TABLES) + list(STAR_TABLES))
    sizes = {r["table_name"]: r["row_count"] for r in io.table_info(T).collect()}

    wanted = os.environ.get("BENCH_QUERIES")
    keys = [k for k in PLANS if not wanted or k in wanted.split(",")]
    times, rows_out, errors = {}, {}, {}
    for key in keys:
        try:
            df = PLANS[key](T)
            rows_out[key] = df.count()                       # warm-up + output size
            runs = []
            for _ in range(3):
                t = time.perf_counter()                      # includes plan building (eager checkpoints)
                PLANS[key](T).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t)
            times[key] = round(statistics.median(runs), 4)
        except Exception as e:  # keep benchmarking the rest, report the failure
            errors[key] = f"{type(e).__name__}: {str(e)[:200]}"
    out = {
        "metric": "sum_of_query_medians",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "master": master,
        "etl_materialize_sec": round(etl_sec, 3),
        "rows_in": sizes,
        "rows_out": rows_out,
        "errors": errors,
    }
    print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
