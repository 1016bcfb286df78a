"""What tasks take in, and how often a log is computed, as tables grow."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, ev, raw_frame
from tidemark.operators.growth import classify
from tidemark.operators.marts import build_fct_events
from tidemark.operators.spine import activity_spine
from tidemark.operators.staging import clean_events
from tidemark.plans import loads, registry
from tidemark.plans.models import Models
from tidemark.session import TASK_FILE_BYTES, TASK_SHUFFLE_BYTES, bounded_tasks, clear_scratch

SHUFFLE, FILES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"


@pytest.fixture()
def sizes(spark):
    kept = {k: spark.conf.get(k) for k in (SHUFFLE, FILES)}
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_labels_take_one_shuffle_of_users(spark):
    """The spine's aggregate deals users; neither window nor label count deals them again."""
    raw = raw_frame(spark, [ev(f"2025-0{m}-0{d} 10:00:00", f"u{u}") for m in (1, 2) for d in (1, 2) for u in range(5)])
    models = Models(raw)
    assert _exchanges(models.activity_spine) == 1
    assert _exchanges(models.growth_classified) == 1


def test_spine_keeps_periods_of_null_dates_and_users(spark):
    day = dt.date(2025, 1, 8)
    rows = [("a", day), ("a", day), ("a", None), ("a", None), (None, day), ("b", dt.date(2025, 1, 9))]
    fct = spark.createDataFrame(rows, "user_id string, event_date date")
    got = sorted((str(r.user_id), r.period_grain, str(r.period_start)) for r in activity_spine(fct).collect())
    want = set()
    for user, d in rows:
        monday = d and d - dt.timedelta(days=d.weekday())
        for grain, start in (("day", d), ("week", monday), ("month", d and d.replace(day=1))):
            want.add((str(user), grain, str(start)))
    assert got == sorted(want)
    assert activity_spine(fct, ("month",)).count() == 4


@pytest.mark.parametrize("key", ["dq_expression_o", "dq_no_double_count_o", "dq_accepted_values_o", "growth_month_o"])
def test_queries_lower_what_a_task_takes(spark, sizes, key):
    spark.conf.set(SHUFFLE, "64m")
    spark.conf.set(FILES, "128m")
    clear_scratch(spark)
    registry.queries()[key](spark, SF_SMALL)
    assert (spark.conf.get(SHUFFLE), spark.conf.get(FILES)) == (f"{TASK_SHUFFLE_BYTES}b", f"{TASK_FILE_BYTES}b")


def test_a_session_that_asks_for_less_keeps_it(spark, sizes):
    spark.conf.set(SHUFFLE, "16k")
    spark.conf.set(FILES, "1m")
    bounded_tasks(spark)
    assert (spark.conf.get(SHUFFLE), spark.conf.get(FILES)) == ("16k", "1m")


@pytest.mark.parametrize("scenario", [loads.growth_by_loads, loads.growth_with_late_rows, loads.bitmaps_by_loads, loads.checks_by_loads])
def test_deliveries_are_read_from_the_log_written_once(spark, monkeypatch, scenario):
    """Not from the raw tables: their join was computed, and the users sent to the driver, for each read."""
    seen = []

    def noted(df):
        seen.append(df)
        raise StopIteration

    monkeypatch.setattr(loads, "quarters", noted)
    with pytest.raises(StopIteration):
        scenario(spark, SF_SMALL, "o")
    assert seen[0].inputFiles() and all("/log/" in f for f in seen[0].inputFiles())
    want = clean_events(loads.raw_events(spark, SF_SMALL, "o"))
    assert seen[0].exceptAll(want).count() == want.exceptAll(seen[0]).count() == 0


def test_labels_of_a_stored_spine_are_dealt_by_user(spark):
    raw = raw_frame(spark, [ev(f"2025-0{m}-01 10:00:00", f"u{u}") for m in (1, 3) for u in range(5)])
    spine = activity_spine(build_fct_events(clean_events(raw)))
    shuffled = spine.repartition(3, F.rand(1))
    assert sorted(classify(shuffled).collect()) == sorted(Models(raw).growth_classified.collect())
