"""Registered load scenarios: the incremental sink and the streams, run over
whole fixture logs in two time-ordered deliveries.

The split point is the midpoint (in microseconds) of the log's time range,
found by one scalar aggregate.  Scratch tables live under the shared
checkpoint folder (``spark.checkpoint.dir``), one fresh folder per run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.serving import growth_month
from tidemark.operators.staging import STG_SCHEMA, clean_events
from tidemark.plans.build import build_all, register_tables
from tidemark.plans.models import Models
from tidemark.session import scratch_path
from tidemark.sources.fixtures import raw_events
from tidemark.sources.raw_events import read_raw_csv, read_raw_daily, write_raw_csv, write_raw_daily
from tidemark.streaming.activity_bitmaps import ActivityBitmaps
from tidemark.streaming.file_index import FileIndex
from tidemark.streaming.growth_table import GrowthTable
from tidemark.streaming.incremental import IncrementalTable, SchemaDriftError
from tidemark.streaming.load_checks import LoadChecks
from tidemark.streaming.stream import dim_users_stream, read_dim_users, stage_events_stream


def split_micros(df: DataFrame, time_col: str = "event_time") -> int:
    """Midpoint of the time range in epoch microseconds (one aggregate row)."""
    t = F.unix_micros(F.col(time_col))
    row = df.agg(F.floor((F.min(t) + F.max(t)) / 2).cast("long").alias("cut")).first()
    return int(row.cut)


def incremental_replay(spark: SparkSession, sf_dir: str, fixture: str) -> DataFrame:
    """Delivery 1: events up to the midpoint; delivery 2: the whole log again.

    The second load keeps only rows above the first load's maximum (the rest
    are counted as late in the manifest), so the target ends as
    rows <= cut, or > max of the first slice.
    """
    stg = clean_events(raw_events(spark, sf_dir, fixture))
    cut = split_micros(stg)
    target = IncrementalTable(spark, scratch_path(spark, f"stg_incremental_{fixture}"))
    target.append(stg.where(F.unix_micros("event_time") <= F.lit(cut)))
    target.append(stg)
    return target.read()


def rerun_log(spark: SparkSession, sf_dir: str, fixture: str) -> DataFrame:
    """ST2: the whole log loaded twice; the second load finds nothing to add."""
    stg = clean_events(raw_events(spark, sf_dir, fixture))
    target = IncrementalTable(spark, scratch_path(spark, f"stg_rerun_{fixture}"))
    target.append(stg)
    target.append(stg)
    return target.manifest().select("load_id", "rows", "late_rows")


def drift_refused(spark: SparkSession, sf_dir: str, fixture: str) -> DataFrame:
    """ST4: batches whose schema drifted fail, and the table keeps its rows."""
    stg = clean_events(raw_events(spark, sf_dir, fixture))
    target = IncrementalTable(spark, scratch_path(spark, f"stg_drift_{fixture}"))
    target.append(stg)
    drifts = {"column added": stg.withColumn("extra", F.lit(1)), "column missing": stg.drop("country"),
              "type changed": stg.withColumn("miles_amount", F.col("miles_amount").cast("string")),
              "columns in another order": stg.select(*reversed(stg.columns))}
    refused = []
    for name, batch in drifts.items():
        try:
            target.append(batch)
            refused.append((name, False))
        except SchemaDriftError:
            refused.append((name, True))
    rows = target.read().agg(F.count(F.lit(1)).alias("rows"))
    return rows.select(F.inline(F.array(*[F.struct(F.lit(n).alias("drift"), F.lit(r).alias("refused")) for n, r in refused])), "rows")


def staged_log(spark: SparkSession, sf_dir: str, fixture: str, path: str) -> DataFrame:
    """The cleaned log, written once below ``path``: deliveries are parts of it,
    and each is read several times on its way through a sink."""
    clean_events(raw_events(spark, sf_dir, fixture)).write.parquet(f"{path}/log")
    return spark.read.schema(STG_SCHEMA).parquet(f"{path}/log")


def quarters(df: DataFrame, time_col: str = "event_time") -> list[DataFrame]:
    """The rows in four parts by time, each a quarter of the time range (one aggregate row)."""
    t = F.unix_micros(F.col(time_col))
    row = df.agg(F.min(t).alias("lo"), F.max(t).alias("hi")).first()
    if row.lo is None:
        return [df] * 4
    cuts = [row.lo + (row.hi - row.lo) * k // 4 for k in (1, 2, 3)]
    ends = [t.isNull() | (t <= cuts[0]), (t > cuts[0]) & (t <= cuts[1]), (t > cuts[1]) & (t <= cuts[2]), t > cuts[2]]
    return [df.where(e) for e in ends]


def _growth_tables(spark: SparkSession, sf_dir: str, fixture: str, name: str) -> tuple[DataFrame, IncrementalTable, GrowthTable]:
    base = scratch_path(spark, f"{name}_{fixture}")
    return (staged_log(spark, sf_dir, fixture, base), IncrementalTable(spark, f"{base}/stg_events"),
            GrowthTable(spark, f"{base}/growth", buckets=16))


def growth_by_loads(spark: SparkSession, sf_dir: str, fixture: str) -> GrowthTable:
    """Four deliveries, one after another; after each the growth report is
    brought up to date from the new load alone, and compacted once between."""
    log, staging, growth = _growth_tables(spark, sf_dir, fixture, "growth_loads")
    for k, part in enumerate(quarters(log)):
        staging.append(part)
        growth.follow(staging)
        if k == 2:
            growth.compact()
    return growth


def bitmaps_by_loads(spark: SparkSession, sf_dir: str, fixture: str) -> ActivityBitmaps:
    """Four deliveries, the second one late and replayed last; bitmaps follow each load."""
    base = scratch_path(spark, f"bitmaps_{fixture}")
    staging, bitmaps = IncrementalTable(spark, f"{base}/stg_events"), ActivityBitmaps(spark, f"{base}/bitmaps", buckets=16)
    first, second, third, fourth = quarters(staged_log(spark, sf_dir, fixture, base))
    for k, part in enumerate((first, third, second, fourth)):
        staging.append(part, keep_late=True)
        bitmaps.follow(staging)
        if k == 1:
            bitmaps.compact()
    staging.replay_late()
    bitmaps.follow(staging)
    return bitmaps


def checks_by_loads(spark: SparkSession, sf_dir: str, fixture: str) -> LoadChecks:
    """Four deliveries, the second one late and replayed last; the suite's state
    follows each load, and is compacted once between."""
    base = scratch_path(spark, f"checks_{fixture}")
    staging = IncrementalTable(spark, f"{base}/stg_events")
    checks = LoadChecks(spark, f"{base}/checks", GrowthTable(spark, f"{base}/growth", buckets=16),
                        ActivityBitmaps(spark, f"{base}/bitmaps", buckets=16), buckets=16)
    first, second, third, fourth = quarters(staged_log(spark, sf_dir, fixture, base))
    for k, part in enumerate((first, third, second, fourth)):
        staging.append(part, keep_late=True)
        checks.follow(staging)
        if k == 1:
            checks.compact()
    staging.replay_late()
    checks.follow(staging)
    return checks


def point_query(spark: SparkSession, sf_dir: str, fixture: str, column: str) -> DataFrame:
    """Events of the least and greatest value of a column, through the file
    index of four deliveries of the whole log."""
    base = scratch_path(spark, f"indexed_{column}_{fixture}")
    staging = IncrementalTable(spark, f"{base}/stg_events")
    index = FileIndex(spark, f"{base}/index", staging)
    for part in quarters(staged_log(spark, sf_dir, fixture, base)):
        staging.append(part)
    index.follow(staging)
    ends = staging.read().agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    return index.read_where(column, [v for v in (ends.low, ends.high) if v is not None])


def growth_with_late_rows(spark: SparkSession, sf_dir: str, fixture: str) -> GrowthTable:
    """The second delivery comes after the third, so all its rows are late: kept
    aside, replayed at the end, and worked into the report that stood by then."""
    log, staging, growth = _growth_tables(spark, sf_dir, fixture, "growth_late")
    first, second, third, fourth = quarters(log)
    for part in (first, third, second, fourth):
        staging.append(part, keep_late=True)
        growth.follow(staging)
    staging.replay_late()
    growth.follow(staging)
    return growth


def _stage_deliveries(spark: SparkSession, sf_dir: str, fixture: str, source_dir: str):
    raw = raw_events(spark, sf_dir, fixture)
    typed = F.col("event_time").cast("timestamp")
    cut = split_micros(raw.where(F.col("event_time").isNotNull()).select(typed.alias("event_time")))
    early = F.unix_micros(typed) <= F.lit(cut)
    return (lambda: write_raw_csv(raw.where(early | F.col("event_time").isNull()), source_dir, "append"),
            lambda: write_raw_csv(raw.where(~early), source_dir, "append"))


def csv_scan(spark: SparkSession, sf_dir: str, fixture: str) -> DataFrame:
    """The whole log written as CSV, scanned by the batch reader and cleaned."""
    path = scratch_path(spark, f"raw_csv_{fixture}")
    write_raw_csv(raw_events(spark, sf_dir, fixture), path)
    return clean_events(read_raw_csv(spark, path, file_name=None))


def daily_scan(spark: SparkSession, sf_dir: str, fixture: str) -> DataFrame:
    """The whole log laid out by day; the days from the middle one on are scanned."""
    raw = raw_events(spark, sf_dir, fixture)
    root = scratch_path(spark, f"raw_daily_{fixture}")
    write_raw_daily(raw.where(F.col("event_time").isNotNull()), root)
    day = F.col("event_time").cast("date")
    middle = raw.agg(F.date_add(F.min(day), F.floor(F.datediff(F.max(day), F.min(day)) / 2).cast("int")).alias("d")).first().d
    return clean_events(read_raw_daily(spark, root, date_from=str(middle)))


def stored_growth(spark: SparkSession, sf_dir: str, fixture: str) -> DataFrame:
    """Every table built and stored, then one report served from the stored tables."""
    root = scratch_path(spark, f"build_{fixture}")
    build_all(spark, raw_events(spark, sf_dir, fixture), root, check=False)
    return growth_month(Models.from_tables(spark, root).growth_accounting)


def layered_sql(spark: SparkSession, sf_dir: str, fixture: str) -> DataFrame:
    """SQL over the stored layers: each cohort's users and share still active
    after three months, next to the month's net growth."""
    root = scratch_path(spark, f"layers_{fixture}")
    build_all(spark, raw_events(spark, sf_dir, fixture), root, check=False)
    prefix = f"layers_{root.rsplit('-', 1)[1]}"
    register_tables(spark, root, prefix)
    return spark.sql(f"""
        SELECT n.period_start, n.net_growth, n.new_users,
               coalesce(max(r.cohort_size), 0) AS cohort_size,
               max(CASE WHEN r.months_since_first = 3 THEN r.retention_pct END) AS pct_after_3
        FROM {prefix}_reports.rpt_net_growth n
        LEFT JOIN {prefix}_reports.rpt_cohort_retention r ON r.cohort_month = n.period_start
        GROUP BY n.period_start, n.net_growth, n.new_users""")


def stream_replay(spark: SparkSession, sf_dir: str, fixture: str) -> DataFrame:
    """Two deliveries dropped into a folder, each picked up by an available-now stream."""
    base = scratch_path(spark, f"stg_stream_{fixture}")
    source_dir, checkpoint = f"{base}/source", f"{base}/checkpoint"
    target = IncrementalTable(spark, f"{base}/target")
    for deliver in _stage_deliveries(spark, sf_dir, fixture, source_dir):
        deliver()
        query = stage_events_stream(spark, source_dir, target, checkpoint)
        query.awaitTermination()
    return target.read()


def dim_stream(spark: SparkSession, sf_dir: str, fixture: str) -> DataFrame:
    """The user dimension maintained by a streaming aggregate over two deliveries."""
    base = scratch_path(spark, f"dim_stream_{fixture}")
    source_dir, checkpoint, table = f"{base}/source", f"{base}/checkpoint", f"{base}/dim_users"
    for deliver in _stage_deliveries(spark, sf_dir, fixture, source_dir):
        deliver()
        dim_users_stream(spark, source_dir, table, checkpoint).awaitTermination()
    return read_dim_users(spark, table)
