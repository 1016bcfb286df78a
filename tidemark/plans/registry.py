"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every key runs over the whole of a raw log derived from the driver's tables
(fixture ``e`` from ``events``; the ``_o`` keys from ``orders`` x
``customer``; the ``_b`` check keys from ``events`` with faults), so its work
grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import quality, serving
from tidemark.operators.value_flow import money_rounded
from tidemark.plans import loads
from tidemark.plans.models import Models
from tidemark.session import bounded_tasks, scratch_epoch
from tidemark.sources.fixtures import FIXTURES, faulty_tables, months_missing
from tidemark.streaming.growth_table import LoadFollower

Query = Callable[[SparkSession, str], DataFrame]

# key -> function of the model graph
MODEL_QUERIES: dict[str, Callable[[Models], DataFrame]] = {
    "stg_events": lambda m: m.stg_events,
    "dim_users": lambda m: m.dim_users,
    "fct_events": lambda m: m.fct_events,
    "activity_spine": lambda m: m.activity_spine,
    "growth_classified": lambda m: m.growth_classified,
    "growth_accounting": lambda m: m.growth_accounting,
    "net_growth": lambda m: m.net_growth,
    "cohort_retention": lambda m: m.cohort_retention,
    "engagement": lambda m: m.engagement,
    "value_flow": lambda m: money_rounded(m.value_flow),
    "category_totals": lambda m: money_rounded(m.category_totals),
    "value_economy": lambda m: money_rounded(m.value_economy),
    # serving queries (Q1-Q11)
    # a report of one grain builds the spine at that grain alone
    "growth_month": lambda m: serving.growth_month(m.only("month").growth_accounting),
    "growth_week": lambda m: serving.growth_week(m.only("week").growth_accounting),
    "net_growth_series": lambda m: serving.net_growth_series(m.net_growth),
    # the pivot needs the offsets first: the small report is written once and
    # read by both jobs instead of being computed twice from the raw log
    "retention_long": lambda m: serving.retention_long(m.cohort_retention),
    "retention_triangle": lambda m: serving.retention_triangle(
        m.materialized(["rpt_cohort_retention"], with_inputs=False).cohort_retention),
    "engagement_all": lambda m: serving.engagement_all(m.engagement),
    "event_mix": lambda m: serving.event_mix(m.engagement),
    "event_types": lambda m: serving.event_types(m.engagement),
    "users_by_source": lambda m: serving.users_by_source(m.dim_users),
    "users_by_country": lambda m: serving.users_by_country(m.dim_users),
    "users_by_platform": lambda m: serving.users_by_platform(m.dim_users),
    "value_flow_series": lambda m: serving.value_flow_series(money_rounded(m.value_economy)),
    "top_categories": lambda m: serving.top_categories(money_rounded(m.value_economy)),
}

# data-quality checks (D1-D11); each returns failing rows or per-check counts
CHECK_QUERIES: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "dq_not_null": lambda t: quality.row_check_summary(t, kinds=("not_null",)),
    "dq_unique": quality.unique_failures,
    "dq_accepted_values": quality.accepted_values_failures,
    "dq_relationships": quality.relationship_failures,
    "dq_expression": lambda t: quality.row_check_summary(t, kinds=("expression",)),
    **{name: partial(quality.singular_failures, name) for name in quality.SINGULAR},
    "dq_summary": quality.run_checks,
}

# key -> scenario over a whole fixture log that writes through a sink
LOAD_QUERIES: dict[str, Callable[[SparkSession, str, str], DataFrame]] = {
    "stg_events_incremental": loads.incremental_replay,
    "stg_events_stream": loads.stream_replay,
    "stg_events_rerun": loads.rerun_log,
    "stg_events_drift": loads.drift_refused,
    "dim_users_stream": loads.dim_stream,
    "stg_events_csv": loads.csv_scan,
    "stg_events_daily": loads.daily_scan,
    "growth_accounting_by_loads": lambda *a: _by_loads(loads.growth_by_loads, *a).growth_accounting(),
    "net_growth_by_loads": lambda *a: _by_loads(loads.growth_by_loads, *a).net_growth(),
    "dim_users_by_loads": lambda *a: _by_loads(loads.growth_by_loads, *a).dim_users(),
    "engagement_by_loads": lambda *a: _by_loads(loads.bitmaps_by_loads, *a).engagement(),
    "cohort_retention_by_loads": lambda *a: _by_loads(loads.bitmaps_by_loads, *a).cohort_retention(),
    "value_economy_by_loads": lambda *a: money_rounded(_by_loads(loads.checks_by_loads, *a).value_economy()),
    "dq_summary_by_loads": lambda *a: _by_loads(loads.checks_by_loads, *a).run_checks(),
    "events_by_user_indexed": partial(loads.point_query, column="user_id"),
    "events_by_key_indexed": partial(loads.point_query, column="event_id"),
    "growth_accounting_late": lambda *a: loads.growth_with_late_rows(*a).growth_accounting(),
    "stored_growth_month": loads.stored_growth,
    "layered_sql": loads.layered_sql,
}

SUFFIX = {"e": "", "o": "_o", "b": "_b"}

# the stored build that the check keys of a log share, as long as the scratch
# folders stand: a log is cleaned and written once, not once per key
_builds: dict[tuple, dict[str, DataFrame]] = {}


def _build(spark: SparkSession, sf_dir: str, fixture: str) -> dict[str, DataFrame]:
    key = (*scratch_epoch(spark), sf_dir, fixture)
    if key not in _builds:
        for old in [k for k in _builds if k[:2] != key[:2]]:
            del _builds[old]
        tables = Models.from_fixture(spark, sf_dir, fixture).materialized().tables()
        _builds[key] = faulty_tables(tables) if fixture == "b" else tables
    return _builds[key]


# the followers that the keys of a log share: its loads are replayed once
_followers: dict[tuple, LoadFollower] = {}


def _by_loads(scenario: Callable[..., LoadFollower], spark: SparkSession, sf_dir: str, fixture: str) -> LoadFollower:
    key = (*scratch_epoch(spark), scenario, sf_dir, fixture)
    if key not in _followers:
        for old in [k for k in _followers if k[:2] != key[:2]]:
            del _followers[old]
        _followers[key] = scenario(spark, sf_dir, fixture)
    return _followers[key]


def _on_models(fn: Callable[[Models], DataFrame], fixture: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_tasks(spark)
    return fn(Models.from_fixture(spark, sf_dir, fixture))


def _on_build(fn, fixture: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_tasks(spark)
    return fn(_build(spark, sf_dir, fixture))


def _on_load(scenario, fixture: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_tasks(spark)
    return scenario(spark, sf_dir, fixture)


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for fixture in FIXTURES:
        for key, fn in MODEL_QUERIES.items():
            out[key + SUFFIX[fixture]] = partial(_on_models, fn, fixture)
        for key, scenario in LOAD_QUERIES.items():
            out[key + SUFFIX[fixture]] = partial(_on_load, scenario, fixture)
    for fixture in (*FIXTURES, "b"):
        for key, fn in CHECK_QUERIES.items():
            out[key + SUFFIX[fixture]] = partial(_on_build, fn, fixture)
    out["dq_summary_by_loads" + SUFFIX["b"]] = partial(_on_load, LOAD_QUERIES["dq_summary_by_loads"], "b")
    for key, fn in quality.FULL.items():  # sound tables lack no month: on the faulty log alone
        out[key + SUFFIX["b"]] = partial(_on_build, lambda t, fn=fn: fn(months_missing(t)), "b")
    return out
