"""P9 ``cohort_retention``: share of each first-month cohort active N months later.

The cohort of a user is the month of ``first_seen_at``; activity is the month
grain of the spine.  A user's active months are gathered to one row (bounded
by the calendar) and joined with the user's one dimension row; both sides are
partitioned by ``user_id``, so neither step adds a shuffle.  Each user then
gives one row per active month and one without a month; the latter count the
cohort, so the dimension is read once.  No zero rows are produced: a month
with no active cohort member is absent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import month_start, months_apart, round_half_away

RETENTION_COLUMNS = ("cohort_month", "months_since_first", "retained_users", "cohort_size", "retention_pct")


def cohort_retention(dim_users: DataFrame, spine: DataFrame, prepartitioned: bool = False) -> DataFrame:
    cohorts = dim_users.select("user_id", month_start("first_seen_at").alias("cohort_month"))
    monthly = spine.where(F.col("period_grain") == "month").select("user_id", "period_start")
    if not prepartitioned:  # a spine bucketed by user already is
        monthly = monthly.repartition("user_id")
    months = monthly.groupBy("user_id").agg(F.collect_set("period_start").alias("months"))
    no_month = F.array(F.lit(None).cast("date"))
    each = cohorts.join(months, "user_id", "left").select(
        "cohort_month", F.explode(F.concat(no_month, F.coalesce("months", F.expr("cast(array() as array<date>)")))).alias("month"))
    counts = each.groupBy("cohort_month", "month").agg(F.count(F.lit(1)).alias("users"))
    size = F.max(F.when(F.col("month").isNull(), F.col("users"))).over(Window.partitionBy("cohort_month"))
    ratio = F.col("users") * F.lit(100.0) / F.col("cohort_size")
    return (counts.withColumn("cohort_size", size).where(F.col("month").isNotNull())
            .select("cohort_month",
                    months_apart("month", "cohort_month").alias("months_since_first"),
                    F.col("users").alias("retained_users"), "cohort_size",
                    round_half_away(ratio, 1).alias("retention_pct")))
