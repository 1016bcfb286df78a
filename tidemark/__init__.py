"""tidemark: growth analytics on Spark.

Raw event log -> cleaned, keyed staging (batch or stream, by high-water
mark) -> user dimension and event fact -> day / week / month activity
spine -> growth accounting, net growth, cohort retention, engagement and
value flows -> serving queries, with a 90-check data-quality suite.
Entry points: ``plans.build.build_all``, ``plans.models.Models``,
``operators.serving``, ``operators.quality.run_checks`` and the
``python -m tidemark`` command line.
"""
