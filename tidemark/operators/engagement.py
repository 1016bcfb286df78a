"""P10 ``engagement``: monthly events, active users and events per user,
overall (``event_type = 'all'``) and per event type.

One scan, counted by (month, type, user) with partial aggregation, so each
event is one update of one hash table.  Those rows, at most one per user,
month and type, are brought together by (month, user); there the first row of
each user is marked, and the sums of the marks over the types are the month's
active users.  The summary is rolled up from the few (month, type) rows and
stays apart from an event type literally named ``all``, which still yields its
own row next to it, as the reference's union does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import month_start, round_half_away

SUMMARY_LABEL = "all"
ENGAGEMENT_COLUMNS = ("month", "event_type", "total_events", "active_users", "events_per_user")


def engagement(fct: DataFrame) -> DataFrame:
    base = fct.select(month_start("event_date").alias("month"), "event_type", "user_id")
    per_user = base.groupBy("month", "event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    of_user = Window.partitionBy("month", "user_id").orderBy("event_type")
    per_type = (per_user.withColumn("first", (F.row_number().over(of_user) == 1).cast("long"))
                .groupBy("month", "event_type")
                .agg(F.sum("n").alias("total_events"), F.count(F.lit(1)).alias("active_users"),
                     F.sum("first").alias("new_users")))
    per_group = (per_type.select("month", F.inline(F.array(
        F.struct(F.lit(False).alias("summary"), "event_type", "total_events", "active_users"),
        F.struct(F.lit(True).alias("summary"), F.lit(SUMMARY_LABEL).alias("event_type"), "total_events",
                 F.col("new_users").alias("active_users")))))
        .groupBy("month", "summary", "event_type")
        .agg(F.sum("total_events").alias("total_events"), F.sum("active_users").alias("active_users")))
    per_active = F.col("total_events").cast("double") / F.col("active_users").cast("double")
    return per_group.select(
        "month", "event_type", "total_events", "active_users",
        round_half_away(per_active, 2).alias("events_per_user"),
    )
