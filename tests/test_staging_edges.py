"""Edge rows of FIXTURES.md §4 through staging, marts and reports."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import ev, raw_frame
from tidemark.operators.engagement import engagement
from tidemark.operators.marts import build_dim_users, build_fct_events
from tidemark.operators.staging import STG_COLUMNS, clean_events
from tidemark.operators.value_flow import category_totals, value_flow
from tidemark.plans.models import Models

D = dt.date


def test_mandatory_nulls_drop_rows_others_pass(spark):
    rows = [
        ev(None, "u1"),
        (("2024-01-01 00:00:00", None, "male", "like", None, None, "web", "organic", "SG")),
        (("2024-01-01 00:00:00", "u1", "male", None, None, None, "web", "organic", "SG")),
        ev("2024-01-01 00:00:00", "u1", platform=None),
        ev("2024-01-01 00:00:00", "u1", country=None),
        ev("2024-01-01 00:00:01", "u1", gender=None, utm=None),  # kept: not mandatory
    ]
    out = clean_events(raw_frame(spark, rows)).collect()
    assert len(out) == 1 and out[0].gender is None and out[0].utm_source is None
    assert tuple(clean_events(raw_frame(spark, rows)).columns) == STG_COLUMNS


def test_blank_text_kept_as_empty_and_case_folded(spark):
    rows = [ev("2024-01-01 00:00:00", "  u_0001 ", etype=" Miles_Earned ", platform=" iOS",
               country=" sg ", gender="   ", utm=" Google", category=" Cat_1 ", miles=5.0)]
    r = clean_events(raw_frame(spark, rows)).first()
    assert (r.user_id, r.event_type, r.platform, r.country, r.gender, r.utm_source,
            r.transaction_category) == ("u_0001", "miles_earned", "ios", "SG", "", "google", "cat_1")


def test_key_uses_raw_text_so_case_variants_get_two_keys(spark):
    rows = [ev("2024-01-01 00:00:00", "u1", etype="LIKE"), ev("2024-01-01 00:00:00", "u1", etype="like")]
    out = clean_events(raw_frame(spark, rows)).collect()
    assert {r.event_type for r in out} == {"like"}
    assert len({r.event_id for r in out}) == 2
    import hashlib
    assert out[1].event_id == hashlib.md5(b"2024-01-01 00:00:00|u1|like").hexdigest() or \
        out[0].event_id == hashlib.md5(b"2024-01-01 00:00:00|u1|like").hexdigest()


def test_offset_text_date_from_text_instant_in_session_zone(spark):
    r = clean_events(raw_frame(spark, [ev("2025-03-01 23:30:00-05:00", "u1")])).first()
    assert r.event_date == D(2025, 3, 1)
    assert r.event_time == dt.datetime(2025, 3, 2, 4, 30)  # UTC session zone


def test_sunday_monday_skipped_month_year_change(spark):
    rows = [ev("2023-12-31 09:00:00", "u1"),   # Sunday, year end
            ev("2024-01-01 09:00:00", "u1"),   # Monday
            ev("2024-01-31 09:00:00", "u1"),
            ev("2024-03-01 09:00:00", "u1")]   # February skipped
    m = Models(raw=raw_frame(spark, rows))
    spine = {(r.period_grain, r.period_start, r.prior_period_start, r.next_period_start)
             for r in m.activity_spine.collect()}
    assert ("week", D(2023, 12, 25), D(2023, 12, 18), D(2024, 1, 1)) in spine
    assert ("week", D(2024, 1, 1), D(2023, 12, 25), D(2024, 1, 8)) in spine
    assert ("month", D(2024, 3, 1), D(2024, 2, 1), D(2024, 4, 1)) in spine
    labels = {(r.period_grain, r.period_start, r.cohort_type) for r in m.growth_classified.collect()}
    assert ("week", D(2024, 1, 1), "retained") in labels
    assert ("month", D(2024, 1, 1), "retained") in labels        # Dec -> Jan across the year
    assert ("month", D(2024, 2, 1), "churned") in labels
    assert ("month", D(2024, 3, 1), "resurrected") in labels


def test_first_event_tie_break_and_last_seen(spark):
    rows = [ev("2024-01-01 00:00:00", "u1", platform="ios", country="MY"),
            ev("2024-01-01 00:00:00", "u1", etype="share", platform="web", country="SG"),
            ev("2024-01-05 00:00:00", "u1", platform="android")]
    stg = clean_events(raw_frame(spark, rows))
    first_key = min(r.event_id for r in stg.collect() if r.event_time == dt.datetime(2024, 1, 1))
    winner = [r for r in stg.collect() if r.event_id == first_key][0]
    d = build_dim_users(stg).first()
    assert (d.first_platform, d.country) == (winner.platform, winner.country)
    assert d.last_seen_at == dt.datetime(2024, 1, 5)
    f = build_fct_events(stg)
    assert f.select("user_sk").distinct().first()[0] == d.user_sk


def test_single_event_user(spark):
    m = Models(raw=raw_frame(spark, [ev("2024-05-15 00:00:00", "solo")]))
    labels = {(r.period_grain, r.cohort_type) for r in m.growth_classified.collect()}
    assert labels == {(g, t) for g in ("day", "week", "month") for t in ("new", "churned")}
    assert m.cohort_retention.first().retention_pct == 100.0


def test_category_with_only_null_amounts(spark):
    rows = [ev("2024-01-01 00:00:00", "u1", etype="miles_earned", category="cat_x", miles=None),
            ev("2024-01-02 00:00:00", "u1", etype="miles_earned", category="cat_y", miles=2.5)]
    fct = build_fct_events(clean_events(raw_frame(spark, rows)))
    cats = {r.transaction_category: (r.total_miles, r.transactions) for r in category_totals(fct).collect()}
    assert cats == {"cat_x": (None, 1), "cat_y": (2.5, 1)}
    flow = value_flow(fct).collect()
    assert [(r.total_miles, r.transactions) for r in flow] == [(2.5, 1)]


def test_event_type_named_all_keeps_two_rows(spark):
    rows = [ev("2024-01-01 00:00:00", "u1", etype="all"), ev("2024-01-02 00:00:00", "u2", etype="like"),
            ev("2024-01-03 00:00:00", "u2", etype="like")]
    eng = engagement(build_fct_events(clean_events(raw_frame(spark, rows))))
    got = sorted((r.event_type, r.total_events, r.active_users, r.events_per_user) for r in eng.collect())
    assert got == [("all", 1, 1, 1.0), ("all", 3, 2, 1.5), ("like", 2, 1, 2.0)]


def test_engagement_without_type_or_user(spark):
    """A missing type is a type and a missing user a user; a user of several types is active once."""
    day = dt.date(2024, 1, 5)
    rows = [(day, None, "u1"), (day, "like", "u1"), (day, "like", "u1"), (day, "all", None), (day, "like", None),
            (dt.date(2024, 2, 1), None, None)]
    fct = spark.createDataFrame(rows, "event_date date, event_type string, user_id string")
    got = sorted(((r.month.month, r.event_type or "", r.total_events, r.active_users) for r in engagement(fct).collect()))
    assert got == [(1, "", 1, 1), (1, "all", 1, 1), (1, "all", 5, 2), (1, "like", 3, 2), (2, "", 1, 1), (2, "all", 1, 1)]
    assert engagement(fct.limit(0)).isEmpty()


def test_rounding_half_away_on_scaled_double(spark):
    from tidemark.functions.columns import round_half_away
    df = spark.createDataFrame([(23.0 / 40,), (1.0 / 8,), (2.0 / 3,)], "x double")
    got = [r[0] for r in df.select(round_half_away(F.col("x"), 2)).collect()]
    assert got == [0.57, 0.13, 0.67]


def test_fixture_lookup_keeps_null_ids_null(spark):
    from tidemark.sources.fixtures import COUNTRY_BY_MOD5, _pick
    df = spark.createDataFrame([(7,), (None,)], "k long")
    got = [r.v for r in df.select(_pick(COUNTRY_BY_MOD5, F.col("k") % 5).alias("v")).collect()]
    assert got == ["ph", None]
    assert df.select(_pick(COUNTRY_BY_MOD5, F.col("k") % 5).alias("v")).where("v is not null").count() == 1
