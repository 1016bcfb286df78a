"""Growth reports kept up to date load by load (P3, P6-P8), against the full build."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, ev, raw_frame
from tidemark.operators.growth import classify, growth_accounting
from tidemark.operators.marts import build_dim_users, build_fct_events
from tidemark.operators.spine import activity_spine
from tidemark.operators.staging import clean_events
from tidemark.plans.loads import quarters
from tidemark.session import scratch_path
from tidemark.sources.fixtures import raw_events
from tidemark.streaming.growth_table import GrowthTable
from tidemark.streaming.incremental import IncrementalTable


def _stg(spark, rows):
    return clean_events(raw_frame(spark, rows))


def _full(stg):
    dim = build_dim_users(stg)
    return growth_accounting(classify(activity_spine(build_fct_events(stg))), dim), dim


def _same(a, b):
    a = a.select(*b.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _assert_equals_full(table, stg):
    ga, dim = _full(stg)
    assert _same(table.growth_accounting(), ga) and _same(table.dim_users(), dim)


def _events(seed, n, first="2024-01-01"):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        day = rng.choice([0, 1, 2, 3, 8, 9, 33, 40, 64, 65, 100])
        t = f"2024-{1 + day // 28:02d}-{1 + day % 28:02d} {rng.randrange(24):02d}:00:00"
        out.append(ev(t, f"u{rng.randrange(9)}", etype=rng.choice(["like", "share"]), platform=rng.choice(["web", "ios"]),
                      country=rng.choice(["SG", "MY"]), utm=rng.choice(["organic", None])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_loads_in_order(spark, seed):
    rows = sorted(_events(seed, 60))
    table, cuts = GrowthTable(spark, scratch_path(spark, "growth"), buckets=3), (0, 20, 21, 45, 60)
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        assert table.apply(_stg(spark, rows[a:b]), k)
        if k == 1:
            assert table.compact()
    _assert_equals_full(table, _stg(spark, rows))
    assert table.applied() == [0, 1, 2, 3]


@pytest.mark.parametrize("seed", [3, 4])
def test_loads_in_any_order(spark, seed):
    """Days before a user's last one, and first events found later."""
    rows = _events(seed, 50)
    table = GrowthTable(spark, scratch_path(spark, "growth"), buckets=3)
    for k in range(3):
        table.apply(_stg(spark, rows[k::3]), k)
        if k == 1:
            table.compact()
    _assert_equals_full(table, _stg(spark, rows))


def test_a_load_is_added_once(spark):
    rows = sorted(_events(5, 20))
    table = GrowthTable(spark, scratch_path(spark, "growth"), buckets=2)
    assert table.apply(_stg(spark, rows), 0) and not table.apply(_stg(spark, rows), 0)
    _assert_equals_full(table, _stg(spark, rows))


def test_a_load_that_died_and_one_without_rows(spark):
    rows = sorted(_events(6, 20))
    table = GrowthTable(spark, scratch_path(spark, "growth"), buckets=2)
    assert table.growth_accounting().isEmpty() and table.dim_users().isEmpty()
    table.apply(_stg(spark, rows[:10]), 0)
    # a dead attempt: folders without an entry
    table._write_users(_stg(spark, rows[10:]), f"{table.path}/users/load=00001-dead")
    table.apply(_stg(spark, rows[10:]).where("false"), 1)
    table.apply(_stg(spark, rows[10:]), 2)
    _assert_equals_full(table, _stg(spark, rows))


def test_two_writers(spark, monkeypatch):
    rows = sorted(_events(7, 30))
    path = scratch_path(spark, "growth")
    one, two = GrowthTable(spark, path, 2), GrowthTable(spark, path, 2)
    one.apply(_stg(spark, rows[:10]), 0)
    changes, state = GrowthTable._changes, {"other": True}

    def slow(self, *args):
        out = changes(self, *args)
        if self is one and state.pop("other", None):
            assert two.apply(_stg(spark, rows[10:20]), 1)
        return out

    monkeypatch.setattr(GrowthTable, "_changes", slow)
    assert one.apply(_stg(spark, rows[20:]), 2)
    _assert_equals_full(one, _stg(spark, rows))


def test_a_load_reads_its_own_buckets_only(spark, monkeypatch):
    table = GrowthTable(spark, scratch_path(spark, "growth"), buckets=32)
    table.apply(_stg(spark, [ev(f"2024-01-01 00:00:{i:02d}", f"u{i}") for i in range(60)]), 0)
    seen = []
    changes = GrowthTable._changes

    def watched(self, *args):
        out = changes(self, *args)
        seen.append(out._jdf.queryExecution().optimizedPlan().toString() + out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(GrowthTable, "_changes", watched)
    table.apply(_stg(spark, [ev("2024-01-02 00:00:00", "u1")]), 1)
    old_scan = [line for line in seen[0].splitlines() if "FileScan" in line and "PartitionFilters: [isnotnull(bucket" in line]
    assert old_scan and all("dates" not in line.split("ReadSchema")[1] for line in old_scan)  # days stay unread in order
    _assert_equals_full(table, _stg(spark, [ev(f"2024-01-01 00:00:{i:02d}", f"u{i}") for i in range(60)] + [ev("2024-01-02 00:00:00", "u1")]))


def test_follows_a_staging_table_with_late_rows(spark):
    stg = clean_events(raw_events(spark, SF_SMALL, "o"))
    base = scratch_path(spark, "follow")
    staging, table = IncrementalTable(spark, f"{base}/stg"), GrowthTable(spark, f"{base}/growth", 4)
    first, second, third, fourth = quarters(stg)
    for part in (first, fourth, second):
        staging.append(part, keep_late=True)
        assert table.follow(staging) in (0, 1)
    assert staging.late().count() == second.count()
    before = set(table.log.files.names(f"{table.path}/users")) | set(table.log.files.names(f"{table.path}/changes"))
    staging.replay_late()
    assert table.follow(staging) == 1 and table.follow(staging) == 0
    after = set(table.log.files.names(f"{table.path}/users")) | set(table.log.files.names(f"{table.path}/changes"))
    assert before < after and len(after) == len(before) + 2  # one folder of each kind more, none touched
    _assert_equals_full(table, first.union(second).union(fourth))
    # the changes of the late rows concern periods from the first late day on
    changed = spark.read.parquet(f"{table.path}/changes/{table.log.entries()[-1]['changes']}")
    day = changed.where("period_grain = 'day'").agg(F.min("period_start")).first()[0]
    assert day >= second.agg(F.min("event_date")).first()[0]
