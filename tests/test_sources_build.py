"""Sources (CSV, daily folders) and the full build with stored layers."""

import io
import os
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.operators.staging import clean_events
from tidemark.operators.value_flow import money_rounded
from tidemark.plans.build import build_all, table_path
from tidemark.plans.models import TABLES, Models
from tidemark.session import scratch_path
from tidemark.sources.fixtures import raw_events
from tidemark.sources.raw_events import RAW_COLUMNS, read_raw_csv, read_raw_daily, write_raw_csv, write_raw_daily
from tidemark.streaming.incremental import IncrementalTable


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_csv_round_trip_keeps_raw_text(spark):
    raw = raw_events(spark, SF_SMALL, "e")
    path = scratch_path(spark, "csv")
    write_raw_csv(raw, path)
    back = spark.read.schema(raw.schema).option("header", True).csv(path)
    assert _same(back, raw)
    assert _same(read_raw_csv(spark, path, file_name=None), raw)


def _csv(spark, name, *lines):
    folder = scratch_path(spark, name).replace("file:", "")
    os.makedirs(folder)
    with open(f"{folder}/event_stream.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    return folder


HEADER = ",".join(RAW_COLUMNS)
ROW = "2024-01-01 00:00:00,u1,male,like,,1.5,web,organic,sg"


def test_doubled_quotes_are_one_quote(spark):
    path = _csv(spark, "quotes", HEADER, '2024-01-01 00:00:00,"u ""x"", 1",male,like,,1.5,web,organic,sg')
    row = read_raw_csv(spark, path).first()
    assert row.user_id == 'u "x", 1' and row.miles_amount == 1.5
    again = scratch_path(spark, "quotes-again")
    write_raw_csv(read_raw_csv(spark, path), again)
    assert read_raw_csv(spark, again, file_name=None).first() == row


@pytest.mark.parametrize("header, row", [
    (HEADER.replace("event_time,user_id", "user_id,event_time"), ROW),  # moved
    (HEADER + ",extra", ROW + ",1"),  # added
    (HEADER.replace("gender", "sex"), ROW),  # renamed
    (HEADER, ROW.rsplit(",", 1)[0]),  # short row
    (HEADER, ROW.replace("1.5", "abc")),  # bad number
])
def test_a_wrong_file_fails_every_reader(spark, header, row):
    path = _csv(spark, "wrong", header, row)
    with pytest.raises(Exception):
        read_raw_csv(spark, path).collect()
    daily = scratch_path(spark, "wrong-daily").replace("file:", "")
    os.makedirs(f"{daily}/date=2024-01-01")
    os.rename(f"{path}/event_stream.csv", f"{daily}/date=2024-01-01/a.csv")
    with pytest.raises(Exception):
        read_raw_daily(spark, daily).collect()


def test_daily_folders_prune_by_date(spark):
    raw = raw_events(spark, SF_SMALL, "e")
    root = scratch_path(spark, "daily")
    write_raw_daily(raw, root)
    days = read_raw_daily(spark, root, "2024-01-03", "2024-01-05")
    buf = io.StringIO()
    with redirect_stdout(buf):
        days.explain("formatted")
    assert "PartitionFilters: [isnotnull(date" in buf.getvalue()
    in_range = raw.where(F.substring("event_time", 1, 10).between("2024-01-03", "2024-01-05"))
    assert _same(days, in_range) and days.count() > 0


def test_daily_deliveries_load_in_order(spark):
    raw = raw_events(spark, SF_SMALL, "e")
    root = scratch_path(spark, "daily_loads")
    write_raw_daily(raw, root)
    target = IncrementalTable(spark, scratch_path(spark, "daily_target"), partition_grain="day")
    dates = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    for d in dates:
        target.append(clean_events(read_raw_daily(spark, root, d, d)))
    expected = clean_events(raw).where(F.col("event_date") <= F.lit("2024-01-04").cast("date"))
    assert _same(target.read(), expected)


def test_build_writes_every_layer_and_rerun_adds_nothing(spark):
    raw = raw_events(spark, SF_SMALL, "o")
    root = scratch_path(spark, "build")
    first = build_all(spark, raw, root)
    local = first.snapshot.replace("file:", "")
    for name in TABLES:
        if name != "stg_events":
            assert os.path.isdir(table_path(local, name)), name
    parts = sorted(p for p in os.listdir(table_path(local, "rpt_growth_accounting")) if "=" in p)
    assert parts == ["period_grain=day", "period_grain=month", "period_grain=week"]
    failing = {r.check_name: r.failing_rows for r in first.checks.where("failing_rows > 0").collect()}
    assert set(failing) <= {"unique_stg_events_event_id", "unique_fct_events_event_id"}
    second = build_all(spark, raw, root, check=False)
    assert second.load.rows == 0 and second.load.late_rows == first.load.rows
    stored = Models.from_tables(spark, root)
    fresh = Models.from_fixture(spark, SF_SMALL, "o")
    for name in ("stg_events", "dim_users", "rpt_growth_accounting", "rpt_cohort_retention",
                 "rpt_engagement", "rpt_miles_economy", "rpt_net_growth"):
        a, b = stored.table(name).select(*fresh.table(name).columns), fresh.table(name)
        if name == "rpt_miles_economy":  # sums of doubles: equal to cents
            a, b = money_rounded(a), money_rounded(b)
        assert _same(a, b), name


def test_a_build_that_dies_leaves_the_old_tables(spark, monkeypatch):
    from tidemark.plans import build
    from tidemark.plans.snapshots import NoSnapshotError, Snapshots

    raw, root = raw_events(spark, SF_SMALL, "e"), scratch_path(spark, "atomic")
    early = raw.where(F.substring("event_time", 1, 10) <= "2024-01-10")
    write = build.write_table

    def dies(df, snapshot, name, *args):
        if name == "rpt_engagement":
            raise RuntimeError("killed")
        write(df, snapshot, name, *args)

    monkeypatch.setattr(build, "write_table", dies)
    with pytest.raises(RuntimeError):
        build_all(spark, early, root, check=False)
    with pytest.raises(NoSnapshotError):
        Models.from_tables(spark, root)
    monkeypatch.setattr(build, "write_table", write)
    build_all(spark, early, root, check=False)
    old = Models.from_tables(spark, root)
    monkeypatch.setattr(build, "write_table", dies)
    with pytest.raises(RuntimeError):
        build_all(spark, raw, root, check=False)  # the load is in, the reports are not
    fresh, held = Models(early), Models.from_tables(spark, root)
    for name in ("stg_events", "dim_users", "rpt_growth_accounting", "rpt_engagement", "rpt_net_growth"):
        assert _same(held.table(name).select(*fresh.table(name).columns), fresh.table(name)), name
    monkeypatch.setattr(build, "write_table", write)
    build_all(spark, raw, root, check=False)
    assert _same(Models.from_tables(spark, root).engagement, Models(raw).engagement)
    assert _same(old.engagement, fresh.engagement)  # opened before: still readable
    snaps = Snapshots(spark, root)
    assert len(snaps.log.files.names(snaps.folder)) == 4 and snaps.expire() == 0
    assert snaps.expire(0) == 3 and snaps.expire(0) == 0
    assert _same(Models.from_tables(spark, root).engagement, Models(raw).engagement)


def test_only_a_sound_build_is_published(spark):
    from tidemark.plans.build import ChecksFailedError

    root = scratch_path(spark, "sound")
    build_all(spark, raw_events(spark, SF_SMALL, "e"), root, only_sound=True)
    before = Models.from_tables(spark, root).stg_events.count()
    faulty = raw_events(spark, SF_SMALL, "b").where(F.substring("event_time", 1, 10) > "2024-02-15")
    with pytest.raises(ChecksFailedError):
        build_all(spark, faulty, root, only_sound=True)
    assert Models.from_tables(spark, root).stg_events.count() == before


def test_bucketed_build_reads_user_tables_without_shuffle(spark):
    from tidemark.operators.growth import classify, growth_accounting
    from tidemark.plans.build import _bucketed_inputs

    raw = raw_events(spark, SF_SMALL, "o")
    root = scratch_path(spark, "bucketed")
    build_all(spark, raw, root, check=False, buckets=4, database="tidemark_test")
    stored = Models.from_tables(spark, root)
    fresh = Models.from_fixture(spark, SF_SMALL, "o")
    for name in ("rpt_growth_accounting", "rpt_cohort_retention", "rpt_net_growth"):
        assert _same(stored.table(name).select(*fresh.table(name).columns), fresh.table(name)), name
    b = _bucketed_inputs(spark, "tidemark_test")
    labels = classify(b["int_user_activity_periods"], prepartitioned=True)
    buf = io.StringIO()
    with redirect_stdout(buf):
        labels.explain("formatted")
    head = buf.getvalue().split("\n\n(1)")[0]
    assert "Window" in head and "Exchange" not in head
    assert _same(growth_accounting(labels, b["dim_users"]), fresh.growth_accounting)


def test_layered_sql_over_stored_tables(spark):
    from tidemark.operators import serving
    from tidemark.plans.build import register_tables

    root = scratch_path(spark, "sql")
    build_all(spark, raw_events(spark, SF_SMALL, "o"), root, check=False)
    names = register_tables(spark, root)
    assert "main_reports.rpt_growth_accounting" in names
    m = Models.from_tables(spark, root)
    gone = spark.sql("""
        SELECT date_format(period_start, 'yyyy') AS year, sum(user_count) AS lost
        FROM main_reports.rpt_growth_accounting
        WHERE cohort_type = 'churned' AND period_grain = 'week' GROUP BY 1""")
    weeks = serving.growth_week(m.growth_accounting).where("cohort_type = 'churned'")
    assert _same(gone, weeks.groupBy(F.date_format("period_start", "yyyy").alias("year")).agg(F.sum("user_count").alias("lost")))
    busiest = spark.sql("""
        WITH per AS (SELECT user_sk, count(*) AS events FROM main_marts.fct_events GROUP BY user_sk)
        SELECT u.country, max(p.events) AS most FROM per p JOIN main_marts.dim_users u USING (user_sk) GROUP BY u.country""")
    assert busiest.count() == m.dim_users.select("country").distinct().count()
    assert spark.sql("SELECT sum(transactions) FROM main_reports.rpt_miles_economy WHERE month IS NULL").first()[0] == \
        m.value_economy.where("month is null").agg(F.sum("transactions")).first()[0]
    assert spark.sql("SELECT count(*) FROM main_staging_stg_events").first()[0] == m.stg_events.count()
