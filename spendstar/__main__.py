"""Command line for spark-submit: daily load, health check, report export.

    spark-submit -m spendstar daily-load --operational ROOT --analytics ROOT --as-of 2023-11-05
    python -m spendstar health-check --operational ROOT --analytics ROOT
    python -m spendstar reports --operational ROOT --analytics ROOT --as-of 2023-11-05 --out DIR

Results are written or shown as small DataFrames (statuses, counts); no data
is collected to the driver.
"""

from __future__ import annotations

import argparse

from .params import AS_OF, FISCAL_YEAR, as_date


class _Both:
    """Operational and star tables under two roots, as one mapping."""

    def __init__(self, op, an):
        self.op, self.an = op, an

    def __getitem__(self, name):
        return self.an[name] if name in self.an.names else self.op[name]

    def __iter__(self):
        return iter(list(self.op.names) + list(self.an.names))

    def __contains__(self, name):
        return name in self.op.names or name in self.an.names

    def __len__(self):
        return len(self.op.names) + len(self.an.names)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="spendstar")
    ap.add_argument("command", choices=["daily-load", "health-check", "reports"])
    ap.add_argument("--operational", required=True)
    ap.add_argument("--analytics", required=True)
    ap.add_argument("--as-of", default=str(AS_OF))
    ap.add_argument("--fiscal-year", type=int, default=FISCAL_YEAR)
    ap.add_argument("--incremental-days", type=int, default=None)
    ap.add_argument("--out", default=None)
    args = ap.parse_args(argv)

    from .session import build_session
    from .sources import io
    from .sources.fixtures import OPERATIONAL_TABLES
    spark = build_session()
    day = as_date(args.as_of)
    if args.command == "daily-load":
        from .etl import daily_load
        daily_load(spark, args.operational, args.analytics, day, args.incremental_days).show(truncate=False)
        return
    T = _Both(io.read_tables(spark, args.operational, OPERATIONAL_TABLES),
              io.read_tables(spark, args.analytics, ["dim_vendors", "dim_commodities", "dim_time",
                                                     "fact_spend_analytics"]))
    if args.command == "health-check":
        from .operators.quality import health_check, orphan_facts, recon_spend, recon_vendors
        for df in (health_check(T), recon_vendors(T), recon_spend(T), orphan_facts(T)):
            df.show(truncate=False)
        return
    from .operators.reports import run_reports
    run = io.write_reports(run_reports(T, day, args.fiscal_year), args.out or f"{args.analytics}/_reports")
    print(run)


if __name__ == "__main__":
    main()
