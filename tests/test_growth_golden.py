"""Hand-worked golden case (FIXTURES.md §3) and the growth invariants."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import ev, raw_frame
from tidemark.operators import serving
from tidemark.plans.models import Models

D = dt.date

GOLDEN = [
    ev("2024-01-05 10:00:00", "A"), ev("2024-02-03 10:00:00", "A"), ev("2024-04-10 10:00:00", "A"),
    ev("2024-02-20 10:00:00", "B"),
    ev("2024-01-31 10:00:00", "C"),
]


def _labels(models, grain):
    rows = (models.growth_classified.where(F.col("period_grain") == grain)
            .select("user_id", "period_start", "cohort_type").collect())
    return {(r.user_id, r.period_start, r.cohort_type) for r in rows}


def test_golden_month_labels(spark):
    m = Models(raw=raw_frame(spark, GOLDEN))
    assert _labels(m, "month") == {
        ("A", D(2024, 1, 1), "new"), ("A", D(2024, 2, 1), "retained"), ("A", D(2024, 3, 1), "churned"),
        ("A", D(2024, 4, 1), "resurrected"), ("A", D(2024, 5, 1), "churned"),
        ("B", D(2024, 2, 1), "new"), ("B", D(2024, 3, 1), "churned"),
        ("C", D(2024, 1, 1), "new"), ("C", D(2024, 2, 1), "churned"),
    }


def test_golden_week_labels_start_monday(spark):
    m = Models(raw=raw_frame(spark, GOLDEN))
    assert _labels(m, "week") == {
        ("A", D(2024, 1, 1), "new"), ("A", D(2024, 1, 8), "churned"),
        ("A", D(2024, 1, 29), "resurrected"), ("A", D(2024, 2, 5), "churned"),
        ("A", D(2024, 4, 8), "resurrected"), ("A", D(2024, 4, 15), "churned"),
        ("B", D(2024, 2, 19), "new"), ("B", D(2024, 2, 26), "churned"),
        ("C", D(2024, 1, 29), "new"), ("C", D(2024, 2, 5), "churned"),
    }


def test_golden_net_growth(spark):
    m = Models(raw=raw_frame(spark, GOLDEN))
    got = {r.period_start: tuple(r)[1:] for r in m.net_growth.collect()}
    # net, new, retained, resurrected, churned
    assert got == {
        D(2024, 1, 1): (2, 2, 0, 0, 0),
        D(2024, 2, 1): (0, 1, 1, 0, 1),
        D(2024, 3, 1): (-2, 0, 0, 0, 2),
        D(2024, 4, 1): (1, 0, 0, 1, 0),
        D(2024, 5, 1): (-1, 0, 0, 0, 1),
    }
    assert sum(v[0] for v in got.values()) == 0


def test_golden_retention(spark):
    m = Models(raw=raw_frame(spark, GOLDEN))
    got = {(r.cohort_month, r.months_since_first): (r.retained_users, r.cohort_size, r.retention_pct)
           for r in m.cohort_retention.collect()}
    assert got == {
        (D(2024, 1, 1), 0): (2, 2, 100.0),
        (D(2024, 1, 1), 1): (1, 2, 50.0),
        (D(2024, 1, 1), 3): (1, 2, 50.0),
        (D(2024, 2, 1), 0): (1, 1, 100.0),
    }
    tri = {r.cohort: r.asDict() for r in serving.retention_triangle(m.cohort_retention).collect()}
    assert tri["2024-01"] == {"cohort": "2024-01", "M+0": 100.0, "M+1": 50.0, "M+2": None, "M+3": 50.0}
    assert tri["2024-02"]["M+0"] == 100.0 and tri["2024-02"]["M+1"] is None


def test_invariants_on_order_stream(spark):
    """T9: per grain, new + resurrected - churned sums to zero and new counts every user."""
    from conftest import SF_SMALL
    m = Models.from_fixture(spark, SF_SMALL, "o")
    users = m.dim_users.count()
    sums = (m.growth_accounting.groupBy("period_grain")
            .pivot("cohort_type", ["new", "retained", "resurrected", "churned"]).sum("user_count")
            .collect())
    assert len(sums) == 3
    for r in sums:
        assert r["new"] == users
        assert r["new"] + r["resurrected"] - r["churned"] == 0


def test_plain_count_equals_distinct_count(spark):
    """R5: the growth and retention counts equal the reference's distinct counts."""
    from conftest import SF_SMALL
    m = Models.from_fixture(spark, SF_SMALL, "o")
    users = m.dim_users.select("user_id", "country", "acquisition_source", "first_platform")
    distinct = (m.growth_classified.join(users, "user_id")
                .groupBy("period_grain", "period_start", "cohort_type", "country",
                         "acquisition_source", "first_platform")
                .agg(F.countDistinct("user_id").alias("user_count")))
    assert distinct.exceptAll(m.growth_accounting).count() == 0
    assert m.growth_accounting.exceptAll(distinct).count() == 0


def test_serving_shapes(spark):
    m = Models(raw=raw_frame(spark, GOLDEN))
    gm = serving.growth_month(m.growth_accounting).collect()
    assert [(r.period_start, r.cohort_type, r.signed_user_count) for r in gm][:3] == [
        (D(2024, 1, 1), "new", 2), (D(2024, 2, 1), "churned", -1), (D(2024, 2, 1), "new", 1)]
    ns = serving.net_growth_series(m.net_growth).collect()
    assert [r.direction for r in ns] == ["growth", "growth", "contraction", "growth", "contraction"]
