"""S5-S7: build every model as a stored table, in dependency order, then check.

    staging  stg_events                 incremental (high-water-mark append)
    marts    dim_users, fct_events      full refresh
    inter.   int_user_activity_periods  full refresh
    reports  growth / net / retention / engagement / miles economy
    checks   one row per declared check

Every layer is read back from storage by the next one, as the reference's
``ref()`` reads a materialised table: lineage is cut at each layer, so a lost
executor only recomputes inside the layer being built, and each report
starts from compact Parquet instead of the raw log.  The growth table is
partitioned by grain, so a read of one grain prunes the others.

The tables of a build are a snapshot: written to a folder of their own and
published by one pointer after the last table and the checks
(``snapshots.py``).  Until then, and if the build dies, readers have the
snapshot before.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.engagement import engagement
from tidemark.operators.growth import classify, growth_accounting, net_growth
from tidemark.operators.marts import build_dim_users, build_fct_events
from tidemark.operators.quality import run_checks
from tidemark.operators.retention import cohort_retention
from tidemark.operators.spine import activity_spine
from tidemark.operators.staging import clean_events
from tidemark.operators.value_flow import value_economy
from tidemark.plans.models import TABLES, Models, stg_table
from tidemark.plans.snapshots import Snapshots
from tidemark.streaming.incremental import LoadResult

PARTITIONING = {"rpt_growth_accounting": ["period_grain"]}
# tables joined on user_id by the reports; bucketed by it when asked
BUCKETED = ("dim_users", "int_user_activity_periods")


@dataclass
class BuildResult:
    root: str
    load: LoadResult
    snapshot: str
    seconds: dict[str, float] = field(default_factory=dict)
    checks: DataFrame | None = None


class ChecksFailedError(ValueError):
    """A build whose checks found rows was not published."""


def table_path(snapshot: str, name: str) -> str:
    return f"{snapshot.rstrip('/')}/{TABLES[name]}/{name}"


def write_table(df: DataFrame, snapshot: str, name: str, buckets: int | None = None,
                database: str | None = None) -> None:
    """Full-refresh sink into a snapshot's folder, partitioned where the table says so.

    With ``buckets`` the user-keyed tables are saved as catalog tables
    bucketed and sorted by ``user_id`` (files still in the snapshot): later
    joins and windows on ``user_id`` read them co-partitioned, without a
    shuffle.  The catalog's entry for them follows the newest build, finished
    or not; readers of a snapshot go by its folder.
    """
    writer = df.write.mode("overwrite")
    if name in PARTITIONING:
        writer = writer.partitionBy(*PARTITIONING[name])
    if buckets and name in BUCKETED:
        (writer.bucketBy(buckets, "user_id").sortBy("user_id")
         .option("path", table_path(snapshot, name)).saveAsTable(f"{database}.{name}"))
        return
    writer.parquet(table_path(snapshot, name))


def _bucketed_inputs(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    return {name: spark.table(f"{database}.{name}") for name in BUCKETED}


def build_all(spark: SparkSession, raw: DataFrame, root: str, on_empty: str = "full",
              check: bool = True, buckets: int | None = None,
              database: str = "tidemark", only_sound: bool = False) -> BuildResult:
    """Load the raw batch incrementally, then rebuild every downstream table
    into a new snapshot and publish it.

    ``only_sound``: publish only if no check finds a row; otherwise raise
    ``ChecksFailedError``, and the snapshot before stays current.

    ``buckets``: save ``dim_users`` and the spine bucketed by ``user_id`` in
    catalog ``database`` (size it so one bucket of the spine is ~128-256 MB);
    the growth and retention reports then join and window them without any
    shuffle.  Needs a persistent catalog to pay off across sessions.
    """
    seconds: dict[str, float] = {}
    if buckets:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root.rstrip('/')}/catalog'")

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        seconds[name] = round(time.perf_counter() - t0, 3)
        return out

    snapshots, staging = Snapshots(spark, root), stg_table(spark, root)
    at = snapshots.new()
    load = timed("stg_events", lambda: staging.append(clean_events(raw), on_empty=on_empty))
    loads = len(staging.loads())
    stg = staging.read(loads=loads)

    timed("fct_events", lambda: write_table(build_fct_events(stg), at, "fct_events"))
    timed("dim_users", lambda: write_table(build_dim_users(stg), at, "dim_users", buckets, database))
    stored = Models.from_tables(spark, root, building=at, upto="marts")
    timed("int_user_activity_periods",
          lambda: write_table(activity_spine(stored.fct_events), at, "int_user_activity_periods",
                              buckets, database))
    stored = Models.from_tables(spark, root, building=at, upto="intermediate")
    spine, dim, fct = stored.activity_spine, stored.dim_users, stored.fct_events
    if buckets:
        bucketed = _bucketed_inputs(spark, database)
        spine, dim = bucketed["int_user_activity_periods"], bucketed["dim_users"]
    timed("rpt_growth_accounting",
          lambda: write_table(growth_accounting(classify(spine, prepartitioned=bool(buckets)), dim),
                              at, "rpt_growth_accounting"))
    timed("rpt_cohort_retention",
          lambda: write_table(cohort_retention(dim, spine, prepartitioned=bool(buckets)),
                              at, "rpt_cohort_retention"))
    timed("rpt_engagement", lambda: write_table(engagement(fct), at, "rpt_engagement"))
    timed("rpt_miles_economy", lambda: write_table(value_economy(fct), at, "rpt_miles_economy"))
    ga = Models.from_tables(spark, root, building=at, upto="rpt_growth_accounting").growth_accounting
    timed("rpt_net_growth", lambda: write_table(net_growth(ga), at, "rpt_net_growth"))

    result = BuildResult(root=root, load=load, snapshot=at, seconds=seconds)
    if check or only_sound:
        tables = Models.from_tables(spark, root, building=at).tables()
        tables["stg_events"] = stg
        checks_path = f"{at}/checks/results"
        timed("checks", lambda: run_checks(tables).write.mode("overwrite").parquet(checks_path))
        result.checks = spark.read.parquet(checks_path)
        if only_sound and not result.checks.where("failing_rows > 0").isEmpty():
            raise ChecksFailedError(f"checks found rows, see {checks_path}")
    snapshots.publish(at, loads)
    return result


def register_tables(spark: SparkSession, root: str, prefix: str = "main") -> list[str]:
    """Expose a build as catalog tables ``{prefix}_{layer}.{name}`` (S8).

    Reports, marts and the spine become external Parquet tables over their
    folders, so SQL written against the layered schemas runs unchanged with
    ``spark.sql``; the staging table is registered as a view over the
    snapshot's loads.  They show the snapshot that is current now; register
    again after a build.  Returns the qualified names.
    """
    names = []
    current = Snapshots(spark, root).current()
    for name, layer in TABLES.items():
        db = f"{prefix}_{layer}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root.rstrip('/')}/catalog/{db}.db'")
        qualified = f"{db}.{name}"
        if name == "stg_events":
            stg_table(spark, root).read(loads=current["loads"]).createOrReplaceTempView(f"{db}_{name}")
            names.append(f"{db}_{name}")
            continue
        spark.sql(f"DROP TABLE IF EXISTS {qualified}")
        spark.sql(f"CREATE TABLE {qualified} USING parquet LOCATION '{table_path(current['folder'], name)}'")
        if name in PARTITIONING:
            spark.sql(f"MSCK REPAIR TABLE {qualified}")
        names.append(qualified)
    return names
