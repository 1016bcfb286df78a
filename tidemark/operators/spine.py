"""P5 ``activity_spine``: distinct (user, grain, period) with prior / next period start.

A report of one grain asks for that grain alone.  All grains come from one scan: each user's dates are gathered to one set
(bounded by the calendar), whose partial (map-side) step removes the
events-per-date repetition before the shuffle, and the periods of every grain
are taken from that set after it.  So the shuffle carries a user's dates once,
not a row per date and grain, and no hash table holds the spine's rows.
A hot user cannot skew the result: it owns at most one date per calendar day.
The rows come out partitioned by ``user_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.periods import DEFAULT_GRAINS, GRAINS, next_start, prior_start

SPINE_COLUMNS = ("user_id", "period_grain", "period_start", "prior_period_start", "next_period_start")


def activity_spine(fct: DataFrame, grains=DEFAULT_GRAINS) -> DataFrame:
    date = F.col("event_date")
    if len(grains) == 1:  # one start per period is enough
        date = GRAINS[grains[0]].start(date)
    # in a struct, for a set leaves nulls out
    users = fct.groupBy("user_id").agg(F.collect_set(F.struct(date.alias("date"))).alias("dates"))
    dates = F.transform("dates", lambda d: d["date"])

    def periods(name: str):
        starts = F.array_distinct(F.transform(dates, GRAINS[name].start))
        return F.transform(starts, lambda s: F.struct(F.lit(name).alias("period_grain"), s.alias("period_start")))

    distinct = users.select("user_id", F.inline(F.concat(*[periods(name) for name in grains])))
    grain, start = F.col("period_grain"), F.col("period_start")
    return distinct.select(
        "user_id", "period_grain", "period_start",
        prior_start(grain, start, grains).alias("prior_period_start"),
        next_start(grain, start, grains).alias("next_period_start"),
    )
