"""Column order of every model (the reference's SELECT lists) and the
high-water append's functional form."""

from conftest import SF_SMALL
from tidemark.operators.engagement import ENGAGEMENT_COLUMNS
from tidemark.operators.growth import GA_KEYS, NET_COLUMNS
from tidemark.operators.marts import DIM_COLUMNS, FCT_COLUMNS
from tidemark.operators.quality import SUMMARY_COLUMNS, run_checks
from tidemark.operators.retention import RETENTION_COLUMNS
from tidemark.operators.spine import SPINE_COLUMNS
from tidemark.operators.staging import STG_COLUMNS
from tidemark.operators.value_flow import ECONOMY_COLUMNS
from tidemark.plans.models import Models
from tidemark.session import scratch_path
from tidemark.streaming.incremental import IncrementalTable, append_above_high_water


def test_model_column_order(spark):
    m = Models.from_fixture(spark, SF_SMALL, "e")
    assert tuple(m.stg_events.columns) == STG_COLUMNS
    assert tuple(m.dim_users.columns) == DIM_COLUMNS
    assert tuple(m.fct_events.columns) == FCT_COLUMNS
    assert tuple(m.activity_spine.columns) == SPINE_COLUMNS
    assert tuple(m.growth_accounting.columns) == GA_KEYS + ("user_count",)
    assert tuple(m.net_growth.columns) == NET_COLUMNS
    assert tuple(m.cohort_retention.columns) == RETENTION_COLUMNS
    assert tuple(m.engagement.columns) == ENGAGEMENT_COLUMNS
    assert tuple(m.value_economy.columns) == ECONOMY_COLUMNS
    assert tuple(run_checks(m.tables()).columns) == SUMMARY_COLUMNS


def test_functional_append(spark):
    m = Models.from_fixture(spark, SF_SMALL, "e")
    target = IncrementalTable(spark, scratch_path(spark, "functional"))
    res = append_above_high_water(target, m.stg_events)
    assert res.rows == m.stg_events.count() and target.read().count() == res.rows


def test_growth_join_reuses_the_user_partitioning(spark):
    """The spine's one repartition by user serves the window and the join; the
    dimension side is partitioned by its own aggregate: two exchanges on
    user_id in total, none added for the join."""
    import io
    import re
    from contextlib import redirect_stdout

    m = Models.from_fixture(spark, SF_SMALL, "o")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        buf = io.StringIO()
        with redirect_stdout(buf):
            m.growth_accounting.explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    text = buf.getvalue()
    head = text.split("\n\n(1)")[0]
    assert "SortMergeJoin" in head and "Window" in head
    by_user = re.findall(r"Arguments: hashpartitioning\(user_id#\d+, \d+\)", text)
    assert len(by_user) == 2, by_user


def test_reports_of_one_grain_build_no_other(spark):
    """No expansion of events to grains below a report that reads one; the
    retention report scans the two tables of its log at most twice each."""
    import io
    import re
    from contextlib import redirect_stdout

    from tidemark.plans.registry import queries

    for key in ("growth_month_o", "growth_week_o", "net_growth_o", "cohort_retention_o"):
        buf = io.StringIO()
        with redirect_stdout(buf):
            queries()[key](spark, SF_SMALL).explain("formatted")
        text = buf.getvalue()
        assert "week" not in text or key == "growth_week_o", key
        assert not re.search(r"inline\(array\(.*(day|week|month).*(day|week|month)", text), key
        assert len(re.findall(r"Scan parquet", text.split("\n\n(1)")[0])) <= 4, key


def test_spine_and_engagement_plan_shapes(spark):
    """Spine: all grains from one expansion and one dedup exchange.
    Engagement: events are counted before any exchange and never doubled; the
    rows of users cross two exchanges, those of (month, type) two small ones."""
    import io
    import re
    from contextlib import redirect_stdout

    def plan(df):
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        return buf.getvalue()

    m = Models.from_fixture(spark, SF_SMALL, "e")
    spine = plan(m.activity_spine)
    assert len(re.findall(r"Scan parquet", spine.split("\n\n(1)")[0])) == 1
    assert len(re.findall(r"Generate \(\d+\)", spine)) == 1
    assert len(re.findall(r"Arguments: hashpartitioning\(", spine)) == 1
    eng = plan(m.engagement)
    assert not re.search(r"Expand \(\d+\)", eng)
    keys = re.findall(r"Arguments: hashpartitioning\(([^)]*), \d+\)", eng)
    assert len(keys) == 4 and sum("user_id" in k for k in keys) == 2
    assert re.search(r"HashAggregate\s*\nInput.*\nKeys \[3\]: .*\nFunctions \[1\]: \[partial_count", eng)
