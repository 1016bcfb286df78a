"""The check suite kept load by load (D1-D11), against the suite over whole tables."""

import pytest
from pyspark.sql import functions as F

from conftest import ev, raw_frame
from test_growth_table import _events
from tidemark.operators import quality
from tidemark.operators.marts import build_fct_events
from tidemark.operators.staging import clean_events
from tidemark.plans.models import Models
from tidemark.session import scratch_path
from tidemark.streaming.activity_bitmaps import ActivityBitmaps
from tidemark.streaming.growth_table import GrowthTable
from tidemark.streaming.load_checks import LoadChecks, bloom_of, filter_bits, may_hold


def _stg(spark, rows):
    return clean_events(raw_frame(spark, rows))


def _table(spark, buckets=2):
    base = scratch_path(spark, "load_checks")
    return LoadChecks(spark, f"{base}/checks", GrowthTable(spark, f"{base}/growth", 2), ActivityBitmaps(spark, f"{base}/bitmaps", 2), buckets)


def _add(table, load, load_id):
    for follower in (table.growth, table.bitmaps, table):
        assert follower.apply(load, load_id)


def _repeated(table):
    return {(r["value"], r["n_records"]) for r in table.repeated_keys().collect()}


def _repeated_at_once(stg):
    check = next(c for c in quality.COLUMN_CHECKS if c.table == "stg_events" and c.kind == "unique")
    return {(r["value"], r["n_records"]) for r in quality.duplicate_values(stg, check).collect()}


def test_suite_after_loads_equals_suite_at_once(spark):
    """Loads out of order, with faulty rows, and rows repeated in a load and over loads."""
    rows = _events(11, 24)
    faulty = [ev("2024-01-02 01:00:00", "u1", country="xx"), ev("2024-01-03 01:00:00", "u2", gender=None),
              ev("2024-02-03 01:00:00", "u77", etype="teleport", miles=-1.0),
              ev("2024-02-03 02:00:00", "u77", etype="miles_earned", miles=5.0, category="a", platform="fridge")]
    parts = [rows[:12] + rows[:2] + faulty[:2], rows[12:] + faulty[2:] + rows[:1], rows[:3] + rows[20:] + faulty[3:]]
    table = _table(spark)
    for k, part in enumerate(parts):
        _add(table, _stg(spark, part), k)
        if k == 1:
            assert table.compact()
    assert not table.apply(_stg(spark, rows), 1)
    raw = raw_frame(spark, [r for p in parts for r in p])
    models = Models(raw=raw).materialized()
    want = quality.run_checks(models.tables())
    got = table.run_checks()
    assert sorted(got.collect()) == sorted(want.collect())
    assert got.where("failing_rows > 0").count() >= 6
    assert _repeated(table) == _repeated_at_once(models.stg_events)


def test_keys_are_looked_for_only_where_times_meet(spark):
    rows = sorted(_events(3, 20))
    table = _table(spark)
    table.apply(_stg(spark, rows[:10]), 0)
    entries = table.log.entries()
    t = entries[0]["max_micros"]
    assert table.met_by({"min_micros": t + 1, "max_micros": t + 5}, entries) == []
    assert table.met_by({"min_micros": t, "max_micros": t + 5}, entries) == entries
    assert table.met_by({"min_micros": None, "max_micros": None}, entries) == []


def test_orphans_until_their_user_comes(spark):
    table = _table(spark)
    early = _stg(spark, [ev("2024-01-01 01:00:00", "a"), ev("2024-01-01 02:00:00", "a"), ev("2024-01-01 03:00:00", "b")])
    table.apply(early, 0)  # before the dimension has the load
    sk = {r["user_id"]: r["user_sk"] for r in build_fct_events(early).collect()}
    assert {tuple(r) for r in table.orphan_keys().collect()} == {(sk["a"], 2), (sk["b"], 1)}
    table.growth.apply(early.where("user_id = 'a'"), 0)
    assert {tuple(r) for r in table.orphan_keys().collect()} == {(sk["b"], 1)}
    with pytest.raises(ValueError, match="same loads"):
        table.run_checks()


def test_two_writers_count_keys_once(spark, monkeypatch):
    rows = sorted(_events(7, 16))
    table = _table(spark)
    other = LoadChecks(spark, table.path, table.growth, table.bitmaps, 2)
    write, state = LoadChecks._write_repeats, {"other": True}

    def slow(self, *args):
        write(self, *args)
        if self is table and state.pop("other", None):
            assert other.apply(_stg(spark, rows[:10]), 0)

    monkeypatch.setattr(LoadChecks, "_write_repeats", slow)
    assert table.apply(_stg(spark, rows[6:]), 1)
    assert _repeated(table) == _repeated_at_once(_stg(spark, rows[:10] + rows[6:]))


def test_filter(spark):
    """Every key of a filter is let through, few others; over several bitmaps."""
    n = 20_000
    bits = filter_bits(n)
    assert bits == 1 << 19 and filter_bits(0) == filter_bits(1) == 1 << 15
    keys = spark.range(2 * n).select(F.md5(F.col("id").cast("string")).alias("event_id"), (F.col("id") < n).alias("own"))
    bloom = bloom_of(keys.where("own"), bits)
    through = keys.join(may_hold(keys, bloom, bits), "event_id").groupBy("own").count().collect()
    counts = {r["own"]: r["count"] for r in through}
    assert counts[True] == n and counts.get(False, 0) < n // 100


def test_no_loads(spark):
    table = _table(spark)
    assert table.value_economy().isEmpty() and table.repeated_keys().isEmpty()
    assert not table.compact()
    _add(table, _stg(spark, []), 0)
    assert table.run_checks().where("failing_rows > 0").isEmpty()
