"""Procurement star-schema ETL, data quality and reporting on Spark.

Entry points:

* ``sources.io.read_tables(spark, root)``: operational or star tables with fixed schemas;
* ``etl.daily_load(spark, operational_root, analytics_root, as_of)``: the daily load;
* ``operators.reports.run_reports(T, as_of)``: the 17 executive reports;
* ``operators.quality``: rules, key and FK checks, reconciliation, health;
* ``plans.catalog.PLANS``: every operator by query key.
"""

__version__ = "0.1.0"
