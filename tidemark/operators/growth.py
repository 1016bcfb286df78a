"""P6 ``growth_classified``, P7 ``growth_accounting``, P8 ``net_growth``.

Labels per user and period:

* new         - the user's first active period at this grain
* retained    - active now and in the immediately prior period
* resurrected - active now, not in the prior period, seen before
* churned     - active in a period but not in the next one; the row goes to
                the missed (next) period, so the last active period of every
                user always yields one churn row after it.

Plan: the spine is hash-partitioned by ``user_id`` once (by its own aggregate,
or here when it is read from a table).  That one exchange
serves the window (clustered by user and grain, a superset of user) and the
inner join to ``dim_users`` (whose own group-by is also partitioned by user),
so the classification and the join add no further shuffle.  Each window row
emits one or two label rows through ``inline`` instead of a second pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

COHORT_TYPES = ("new", "retained", "resurrected", "churned")
DIMENSIONS = ("country", "acquisition_source", "first_platform")
GA_KEYS = ("period_grain", "period_start", "cohort_type") + DIMENSIONS
NET_COLUMNS = ("period_start", "net_growth", "new_users", "retained_users",
               "resurrected_users", "churned_users")


def windowed(spine: DataFrame, prepartitioned: bool = False) -> DataFrame:
    """Spine rows with previous / following active period and first period.

    ``prepartitioned=True`` when the spine comes out of ``activity_spine`` or
    is read from a table bucketed by ``user_id``: its partitioning then
    satisfies the window and the join, and no shuffle is added at all.
    """
    by_user = spine if prepartitioned else spine.repartition("user_id")
    w = Window.partitionBy("user_id", "period_grain").orderBy("period_start")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return by_user.select(
        "user_id", "period_grain", "period_start", "prior_period_start", "next_period_start",
        F.lag("period_start").over(w).alias("active_before"),
        F.lead("period_start").over(w).alias("active_after"),
        F.min("period_start").over(whole).alias("first_active"),
    )


def classify(spine: DataFrame, prepartitioned: bool = False) -> DataFrame:
    """(user_id, period_grain, period_start, cohort_type): one label per user and period."""
    win = windowed(spine, prepartitioned)
    start = F.col("period_start")
    active = (F.when(start == F.col("first_active"), F.lit("new"))
               .when(F.col("active_before") == F.col("prior_period_start"), F.lit("retained"))
               .otherwise(F.lit("resurrected")))
    lead, nxt = F.col("active_after"), F.col("next_period_start")
    churns = lead.isNull() | (lead != nxt)
    rows = F.array_compact(F.array(
        F.struct(start.alias("period_start"), active.alias("cohort_type")),
        F.when(churns, F.struct(nxt.alias("period_start"), F.lit("churned").alias("cohort_type"))),
    ))
    return win.select("user_id", "period_grain", F.inline(rows))


def growth_accounting(classified: DataFrame, dim_users: DataFrame) -> DataFrame:
    """Users per (grain, period, cohort type, country, source, first platform).

    The reference counts distinct users; a plain row count is equal here
    because a user has exactly one label per period (``dq_no_double_count``)
    and one dimension row (``dim_users.user_id`` unique), which the test
    suite asserts.  That saves the extra shuffle of a distinct count.
    """
    users = dim_users.select("user_id", *DIMENSIONS)
    return (classified.join(users, "user_id", "inner")
            .groupBy(*GA_KEYS)
            .agg(F.count(F.lit(1)).alias("user_count")))


def net_growth(ga: DataFrame) -> DataFrame:
    """Monthly net = new + resurrected - churned, with the four counts."""
    t, n = F.col("cohort_type"), F.col("user_count")

    def only(label):
        return F.sum(F.when(t == label, n).otherwise(F.lit(0))).cast("long")

    signed = (F.when(t.isin("new", "resurrected"), n)
               .when(t == "churned", -n)
               .otherwise(F.lit(0)))
    return (ga.where(F.col("period_grain") == "month")
            .groupBy("period_start")
            .agg(F.sum(signed).cast("long").alias("net_growth"),
                 only("new").alias("new_users"),
                 only("retained").alias("retained_users"),
                 only("resurrected").alias("resurrected_users"),
                 only("churned").alias("churned_users")))
