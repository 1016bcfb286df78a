"""The check suite: catalogue shape, clean runs, and one mutation per check kind."""

from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.operators import quality
from tidemark.plans.models import Models


def test_catalogue_matches_declared_counts():
    kinds = Counter(c.kind for c in quality.COLUMN_CHECKS)
    assert kinds == {"not_null": 58, "expression": 11, "accepted_values": 9, "unique": 5, "relationships": 1}
    assert len(quality.ALL_CHECKS) == 90
    assert len({c.check_name for c in quality.ALL_CHECKS}) == 90


def _summary(tables):
    return {r.check_name: r.failing_rows for r in quality.run_checks(tables).collect()}


def test_clean_fixture_passes_every_check(spark):
    tables = Models.from_fixture(spark, SF_SMALL, "e").tables()
    failing = {k: v for k, v in _summary(tables).items() if v}
    assert failing == {}


def _mutated(spark, table, mutate):
    tables = Models.from_fixture(spark, SF_SMALL, "e").tables()
    tables[table] = mutate(tables[table])
    return {k: v for k, v in _summary(tables).items() if v}


def test_mutations_are_caught(spark):
    def one_row_with(df, **cols):
        bad = df.limit(1)
        for name, value in cols.items():
            bad = bad.withColumn(name, value.cast(df.schema[name].dataType))
        return df.unionByName(bad)

    failing = _mutated(spark, "stg_events", lambda df: one_row_with(df, gender=F.lit("robot")))
    assert failing == {"accepted_values_stg_events_gender": 1, "unique_stg_events_event_id": 1}

    failing = _mutated(spark, "stg_events", lambda df: one_row_with(df, event_id=F.lit(None)))
    assert failing == {"not_null_stg_events_event_id": 1}

    failing = _mutated(spark, "stg_events", lambda df: one_row_with(
        df, event_id=F.lit("x"), miles_amount=F.lit(-1.0)))
    assert failing == {"expression_stg_events_miles_amount": 1}

    failing = _mutated(spark, "fct_events", lambda df: one_row_with(
        df, event_id=F.lit("y"), user_sk=F.lit("orphan")))
    assert failing == {"relationships_fct_events_user_sk": 1}

    failing = _mutated(spark, "rpt_net_growth", lambda df: one_row_with(
        df, net_growth=F.lit(999)))
    assert failing == {"unique_rpt_net_growth_period_start": 1, "dq_net_balances": 1}

    failing = _mutated(spark, "rpt_cohort_retention", lambda df: df.withColumn(
        "retention_pct", F.when(F.col("months_since_first") == 0, F.lit(99.0)).otherwise(F.col("retention_pct"))))
    assert failing == {"dq_retention_m0": 1}


def _some(condition, column, by=1):
    return F.when(condition, F.col(column) + by).otherwise(F.col(column))


def test_invariants_over_two_tables_catch_mutations(spark):
    every = F.lit(True)
    failing = _mutated(spark, "rpt_cohort_retention", lambda df: df.withColumn("cohort_size", _some(every, "cohort_size", 5)))
    assert failing == {"dq_cohort_size": 1}

    failing = _mutated(spark, "rpt_engagement", lambda df: df.withColumn(
        "active_users", _some(F.col("event_type") == "all", "active_users")))
    assert failing == {"dq_engagement_active": 1}

    failing = _mutated(spark, "rpt_growth_accounting", lambda df: df.withColumn("user_count", _some(
        (F.col("period_grain") == "month") & (F.col("cohort_type") == "new"), "user_count")))
    assert failing == {"dq_growth_active": 1}

    tables = Models.from_fixture(spark, SF_SMALL, "e").tables()
    spine = tables["int_user_activity_periods"].withColumn("next_period_start", F.col("period_start"))
    twice = quality.singular_failures("dq_no_double_count", {**tables, "int_user_activity_periods": spine})
    assert twice.count() == spine.count() and {r.cohort_count for r in twice.collect()} == {2}


def test_every_check_key_finds_the_faulty_log_s_faults(spark):
    from tidemark.plans.registry import CHECK_QUERIES, queries
    qs = queries()
    for key in CHECK_QUERIES:
        rows = qs[f"{key}_b"](spark, SF_SMALL).collect()
        assert any(r.failing_rows for r in rows) if "failing_rows" in rows[0] else rows, key


def test_checks_of_a_log_share_one_build_and_scratch_is_removed(spark):
    import os

    from tidemark.plans import registry
    from tidemark.session import clear_scratch, ensure_checkpoint_dir
    first = registry._build(spark, SF_SMALL, "e")
    assert registry._build(spark, SF_SMALL, "e") is first
    root = os.path.join(ensure_checkpoint_dir(spark), "tidemark").replace("file:", "")
    assert os.listdir(root)
    assert clear_scratch(spark) > 0 and not [n for n in os.listdir(root) if not n.startswith(".")]
    assert registry._build(spark, SF_SMALL, "e") is not first


def test_duplicate_event_keys_found_on_order_stream(spark):
    tables = Models.from_fixture(spark, "/root/testdata/sf0.01", "o").tables()
    dups = quality.unique_failures(tables).where(F.col("table_name") == "stg_events")
    assert dups.count() == 11


def test_singular_checks_pass_on_both_fixtures(spark):
    for fixture in ("e", "o"):
        tables = Models.from_fixture(spark, SF_SMALL, fixture).tables()
        for name in quality.SINGULAR:
            assert quality.singular_failures(name, tables).count() == 0, (fixture, name)


def test_months_that_one_side_lacks(spark):
    """Inner (the reference's form): compared where both are.  Full: told apart with nulls."""
    from tidemark.operators.quality import engagement_active_mismatch

    eng = spark.sql("select date'2024-01-01' as month, 'all' as event_type, 2L as active_users union all "
                    "select date'2024-02-01', 'all', 1L union all select date'2024-02-01', 'like', 9L")
    fct = spark.sql("select date'2024-01-05' as event_date, 'u1' as user_id union all select date'2024-03-05', 'u1'")
    inner = {str(r.month): (r.eng_active, r.fct_active, r["diff"]) for r in engagement_active_mismatch(eng, fct).collect()}
    full = {str(r.month): (r.eng_active, r.fct_active, r["diff"]) for r in engagement_active_mismatch(eng, fct, full=True).collect()}
    assert inner == {"2024-01-01": (2, 1, 1)}
    assert full == inner | {"2024-02-01": (1, None, 1), "2024-03-01": (None, 1, -1)}
