"""P3 ``dim_users`` and P4 ``fct_events``.

``dim_users`` is a single aggregate grouped by user: the first event's
attributes are the minimum of a struct whose leading fields are the order
keys (time, then event key, then the attributes themselves, so even exact
duplicates resolve deterministically), and ``last_seen_at`` is a plain max.
One exchange, with partial aggregation on the map side, so a user holding a
third of all events still sends one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIM_COLUMNS = (
    "user_sk", "user_id", "gender", "country", "first_platform",
    "acquisition_source", "first_event_type", "first_seen_at", "last_seen_at",
)

FCT_COLUMNS = (
    "event_id", "user_sk", "user_id", "event_time", "event_date", "event_type",
    "transaction_category", "miles_amount", "platform", "utm_source", "country",
)

# order of the first-event choice: time, event key, then the attributes
FIRST_EVENT_ORDER = ("event_time", "event_id", "gender", "country", "platform",
                     "utm_source", "event_type")


def build_fct_events(stg: DataFrame) -> DataFrame:
    """One row per event; the user key is derived by hash, no join needed."""
    return stg.select(
        "event_id",
        F.md5(F.col("user_id")).alias("user_sk"),
        "user_id", "event_time", "event_date", "event_type",
        "transaction_category", "miles_amount", "platform", "utm_source", "country",
    )


def first_and_last(events: DataFrame) -> DataFrame:
    """(user_id, first, last_seen_at): the dimension's aggregate state.

    ``first`` is the minimum first-event struct and ``last_seen_at`` the
    maximum time; both are idempotent and associative, so partial results
    (map-side, or per micro-batch) merge by applying the same aggregate.
    """
    first = F.min(F.struct(*[F.col(c) for c in FIRST_EVENT_ORDER])).alias("first")
    return events.groupBy("user_id").agg(first, F.max("event_time").alias("last_seen_at"))


def merge_first_and_last(states: DataFrame) -> DataFrame:
    """Merge several (user_id, first, last_seen_at) states into one per user."""
    return states.groupBy("user_id").agg(F.min("first").alias("first"),
                                         F.max("last_seen_at").alias("last_seen_at"))


def dim_from_state(state: DataFrame) -> DataFrame:
    return state.select(
        F.md5(F.col("user_id")).alias("user_sk"),
        "user_id",
        F.col("first.gender").alias("gender"),
        F.col("first.country").alias("country"),
        F.col("first.platform").alias("first_platform"),
        F.col("first.utm_source").alias("acquisition_source"),
        F.col("first.event_type").alias("first_event_type"),
        F.col("first.event_time").alias("first_seen_at"),
        "last_seen_at",
    )


def build_dim_users(stg: DataFrame) -> DataFrame:
    """One row per user, anchored on the user's first event."""
    return dim_from_state(first_and_last(stg))
