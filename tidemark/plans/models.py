"""The model graph: staging -> marts -> spine -> reports, as lazy DataFrames.

Each property is a pure DataFrame -> DataFrame step, so a caller gets one
Catalyst plan per report (filters and projections flow down to the scan).
``Models.from_tables`` rebuilds the graph over stored tables instead, which
is how serving queries and checks run after a build (S4).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.periods import DEFAULT_GRAINS
from tidemark.operators.engagement import engagement
from tidemark.operators.growth import classify, growth_accounting, net_growth
from tidemark.operators.marts import build_dim_users, build_fct_events
from tidemark.operators.retention import cohort_retention
from tidemark.operators.spine import activity_spine
from tidemark.operators.staging import clean_events
from tidemark.operators.value_flow import category_totals, value_economy, value_flow
from tidemark.plans.snapshots import Snapshots
from tidemark.session import scratch_path
from tidemark.sources.fixtures import raw_events
from tidemark.streaming.incremental import IncrementalTable

# models each stored table is built from (TABLES is in dependency order)
DEPENDS = {
    "stg_events": (),
    "dim_users": ("stg_events",),
    "fct_events": ("stg_events",),
    "int_user_activity_periods": ("fct_events",),
    "rpt_growth_accounting": ("int_user_activity_periods", "dim_users"),
    "rpt_net_growth": ("rpt_growth_accounting",),
    "rpt_cohort_retention": ("dim_users", "int_user_activity_periods"),
    "rpt_engagement": ("fct_events",),
    "rpt_miles_economy": ("fct_events",),
}

# tables that are a pure projection of their input: cheaper to derive again
# from the materialised input than to write a second copy of the event log
PROJECTIONS = {"fct_events"}

# stored table names, per layer (the reference keeps one schema per layer)
TABLES = {
    "stg_events": "staging",
    "dim_users": "marts",
    "fct_events": "marts",
    "int_user_activity_periods": "intermediate",
    "rpt_growth_accounting": "reports",
    "rpt_net_growth": "reports",
    "rpt_cohort_retention": "reports",
    "rpt_engagement": "reports",
    "rpt_miles_economy": "reports",
}


LAYERS_IN_ORDER = ("staging", "marts", "intermediate", "reports")


def stg_table(spark: SparkSession, root: str) -> IncrementalTable:
    """The staging table of a build root (an incremental, manifest-tracked table)."""
    return IncrementalTable(spark, f"{root.rstrip('/')}/staging/stg_events")


class Models:
    """Lazily built models over one raw event log (or over stored tables)."""

    def __init__(self, raw: DataFrame | None = None, stored: dict[str, DataFrame] | None = None,
                 grains: tuple[str, ...] = DEFAULT_GRAINS):
        self._raw = raw
        self._stored = stored or {}
        self._grains = grains

    def only(self, *grains: str) -> "Models":
        """The same graph with a spine of these grains alone, for a report that
        reads no other (stored tables hold all grains and stay as they are)."""
        return Models(self._raw, self._stored, grains)

    @classmethod
    def from_fixture(cls, spark: SparkSession, sf_dir: str, fixture: str = "e") -> "Models":
        return cls(raw=raw_events(spark, sf_dir, fixture))

    @classmethod
    def from_tables(cls, spark: SparkSession, root: str, upto: str = "reports", building: str | None = None) -> "Models":
        """Models over the current snapshot of ``root``, for layers up to ``upto``
        (a layer name or a table name); later models are computed from them.
        ``building``: the folder of a build under way instead."""
        current = {"folder": building, "loads": None} if building else Snapshots(spark, root).current()
        if upto in TABLES:
            names = [n for n in TABLES if LAYERS_IN_ORDER.index(TABLES[n]) < LAYERS_IN_ORDER.index(TABLES[upto])]
            names.append(upto)
        else:
            names = [n for n in TABLES if LAYERS_IN_ORDER.index(TABLES[n]) <= LAYERS_IN_ORDER.index(upto)]
        stored = {}
        for name in names:
            if name == "stg_events":
                stored[name] = stg_table(spark, root).read(loads=current["loads"])
            else:
                stored[name] = spark.read.parquet(f"{current['folder']}/{TABLES[name]}/{name}")
        return cls(stored=stored)

    def _get(self, name: str, build):
        return self._stored[name] if name in self._stored else build()

    @property
    def raw(self) -> DataFrame:
        if self._raw is None:
            raise ValueError("no raw input: models were opened over stored tables")
        return self._raw

    @cached_property
    def stg_events(self) -> DataFrame:
        return self._get("stg_events", lambda: clean_events(self.raw))

    @cached_property
    def fct_events(self) -> DataFrame:
        return self._get("fct_events", lambda: build_fct_events(self.stg_events))

    @cached_property
    def dim_users(self) -> DataFrame:
        return self._get("dim_users", lambda: build_dim_users(self.stg_events))

    @cached_property
    def activity_spine(self) -> DataFrame:
        return self._get("int_user_activity_periods", lambda: activity_spine(self.fct_events, self._grains))

    def _by_user(self) -> bool:
        """Whether the spine comes out of its aggregate, which leaves it partitioned by user."""
        return "int_user_activity_periods" not in self._stored

    @cached_property
    def growth_classified(self) -> DataFrame:
        return classify(self.activity_spine, prepartitioned=self._by_user())

    @cached_property
    def growth_accounting(self) -> DataFrame:
        return self._get("rpt_growth_accounting",
                         lambda: growth_accounting(self.growth_classified, self.dim_users))

    @cached_property
    def net_growth(self) -> DataFrame:
        return self._get("rpt_net_growth", lambda: net_growth(self.only("month").growth_accounting))

    @cached_property
    def cohort_retention(self) -> DataFrame:
        return self._get("rpt_cohort_retention",
                         lambda: cohort_retention(self.dim_users, self.only("month").activity_spine, self._by_user()))

    @cached_property
    def engagement(self) -> DataFrame:
        return self._get("rpt_engagement", lambda: engagement(self.fct_events))

    @cached_property
    def value_flow(self) -> DataFrame:
        return value_flow(self.fct_events)

    @cached_property
    def category_totals(self) -> DataFrame:
        return category_totals(self.fct_events)

    @cached_property
    def value_economy(self) -> DataFrame:
        return self._get("rpt_miles_economy", lambda: value_economy(self.fct_events))

    def materialized(self, names=None, with_inputs: bool = True) -> "Models":
        """Models whose tables (``names`` and everything they are built from)
        are written once as Parquet, in dependency order, and read back.

        Used where many queries read the same models (the check suite): each
        model is computed once instead of every branch recomputing the
        pipeline from the raw scan, and lineage is cut at each table.  With
        ``with_inputs=False`` only the named tables are written (e.g. a small
        report read by two jobs, computed in one plan from the raw log).  The
        folder is a fresh one below the shared ``spark.checkpoint.dir``, so
        the tables survive the loss of an executor.
        """
        wanted: set[str] = set(names or TABLES)
        stack = list(wanted) if with_inputs else []
        while stack:
            n = stack.pop()
            wanted.add(n)
            stack.extend(d for d in DEPENDS[n] if d not in wanted)
        root = None
        current = self
        for name in TABLES:
            if name in wanted and name not in current._stored and name not in PROJECTIONS:
                if root is None:
                    root = scratch_path(self.spark, "models")
                path = f"{root}/{name}"
                current.table(name).write.mode("overwrite").parquet(path)
                current = Models(self._raw, {**current._stored, name: self.spark.read.parquet(path)}, self._grains)
        return current

    @property
    def spark(self) -> SparkSession:
        any_df = self._raw if self._raw is not None else next(iter(self._stored.values()))
        return any_df.sparkSession

    def tables(self) -> dict[str, DataFrame]:
        """All nine stored models by table name (input of the check suite)."""
        return {name: self.table(name) for name in TABLES}

    def table(self, name: str) -> DataFrame:
        """A model by its stored-table name."""
        return {
            "stg_events": lambda: self.stg_events,
            "dim_users": lambda: self.dim_users,
            "fct_events": lambda: self.fct_events,
            "int_user_activity_periods": lambda: self.activity_spine,
            "rpt_growth_accounting": lambda: self.growth_accounting,
            "rpt_net_growth": lambda: self.net_growth,
            "rpt_cohort_retention": lambda: self.cohort_retention,
            "rpt_engagement": lambda: self.engagement,
            "rpt_miles_economy": lambda: self.value_economy,
        }[name]()
