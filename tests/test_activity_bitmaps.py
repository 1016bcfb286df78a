"""Engagement and retention from bitmaps (P9, P10), against the reports over all events."""

import pytest

from conftest import raw_frame
from test_growth_table import _events
from tidemark.operators.engagement import engagement
from tidemark.operators.marts import build_dim_users, build_fct_events
from tidemark.operators.retention import cohort_retention
from tidemark.operators.spine import activity_spine
from tidemark.operators.staging import clean_events
from tidemark.session import scratch_path
from tidemark.streaming.activity_bitmaps import NUMBERS, ActivityBitmaps


def _stg(spark, rows):
    return clean_events(raw_frame(spark, rows))


def _same(a, b):
    a = a.select(*b.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _assert_equals_full(table, stg):
    fct = build_fct_events(stg)
    assert _same(table.engagement(), engagement(fct))
    assert _same(table.cohort_retention(), cohort_retention(build_dim_users(stg), activity_spine(fct)))


@pytest.mark.parametrize("seed,ordered", [(1, True), (2, False)])
def test_loads(spark, seed, ordered):
    """In any order: first events found later move users between cohorts."""
    rows = _events(seed, 60)
    rows = sorted(rows) if ordered else rows
    table = ActivityBitmaps(spark, scratch_path(spark, "bitmaps"), buckets=3)
    for k in range(4):
        assert table.apply(_stg(spark, rows[15 * k:15 * k + 15]), k)
        if k == 1:
            assert table.compact()
    assert not table.apply(_stg(spark, rows), 2)
    _assert_equals_full(table, _stg(spark, rows))
    numbers = [(r["user_id"], r["n"]) for r in table._read("numbers", NUMBERS, table.log.entries()).collect()]
    by_user = dict(numbers)
    assert len(set(by_user.values())) == len(by_user) and set(numbers) == set(by_user.items())  # one number each, never another


def test_numbers_over_several_slots(spark):
    """Numbers beyond one bitmap of 32,768 bits."""
    table = ActivityBitmaps(spark, scratch_path(spark, "bitmaps"), buckets=40_000)
    rows = _events(5, 40)
    table.apply(_stg(spark, rows), 0)
    assert table._read("numbers", NUMBERS, table.log.entries()).where("n >= 32768").count() > 0
    _assert_equals_full(table, _stg(spark, rows))


def test_two_writers_give_numbers_once(spark, monkeypatch):
    rows, path = sorted(_events(7, 30)), scratch_path(spark, "bitmaps")
    one, two = ActivityBitmaps(spark, path, 2), ActivityBitmaps(spark, path, 2)
    write, state = ActivityBitmaps._write, {"other": True}

    def slow(self, *args):
        write(self, *args)
        if self is one and state.pop("other", None):
            assert two.apply(_stg(spark, rows[:15]), 0)

    monkeypatch.setattr(ActivityBitmaps, "_write", slow)
    assert one.apply(_stg(spark, rows[15:]), 1)
    _assert_equals_full(one, _stg(spark, rows))


def test_empty(spark):
    table = ActivityBitmaps(spark, scratch_path(spark, "bitmaps"), buckets=2)
    assert table.engagement().isEmpty() and table.cohort_retention().isEmpty()
    table.apply(_stg(spark, []), 0)
    assert table.engagement().isEmpty() and table.cohort_retention().isEmpty()
