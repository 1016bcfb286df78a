"""Raw event logs derived by Spark from the driver's tables.

No raw rows ship with the reference, so two raw logs with exactly the nine raw
columns are derived from the given tables (mapping fixed in FIXTURES.md §2):

* ``E`` from ``events``: 30 days of one month; exercises day / week grains,
  dropped rows (null platform), case and blank noise, first-event choice.
* ``O`` from ``orders`` joined to ``customer``: 80 months; every cohort label
  at every grain, duplicate event keys, first-day ties.
* ``B`` from ``events``: E spread over three months, with faults of every kind
  that passes cleaning (nulls, values outside the lists, negative amounts,
  rows that come twice); ``faulty_tables`` adds those that cleaning or the
  models cannot produce.

The same expressions are written in DuckDB SQL in ``oracle/sql.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.raw_events import RAW_COLUMNS

# Fixed values of the fixture mapping (FIXTURES.md §2), in natural order.
GENDER_BY_MOD4 = ["Male", "FEMALE", " non-binary", "Prefer not to say"]
UTM_BY_MOD5 = ["Facebook", "google", "organic", "referral", "tiktok"]
COUNTRY_BY_MOD5 = ["sg", "my", "ph", "id", "th"]
PLATFORM_BY_MOD3 = ["Web", "iOS", "ANDROID"]
# raw event type for events.event_type, and for the first digit of o_orderpriority
EVENT_TYPE_BY_KIND = {
    "view": "Miles_Earned",
    "purchase": "miles_redeemed ",
    "signup": "reward_search",
    "error": "SHARE",
    "click": "like",
}
EVENT_TYPE_BY_PRIORITY = {
    "1": "Miles_Earned",
    "2": "miles_redeemed ",
    "3": "reward_search",
    "4": "SHARE",
    "5": "like",
}
PLATFORM_BY_STATUS = {"F": "web", "O": "ios", "P": "android"}
UTM_BY_SEGMENT = {  # market segments in alphabetical order -> UTM_BY_MOD5
    "AUTOMOBILE": "Facebook",
    "BUILDING": "google",
    "FURNITURE": "organic",
    "HOUSEHOLD": "referral",
    "MACHINERY": "tiktok",
}
TIME_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

FIXTURES = ("e", "o")


def _pick(labels: list[str], index: Column) -> Column:
    """labels[index] for a non-negative integer index; null for a null index.

    Written as a CASE: ``element_at`` over a literal array is typed
    non-nullable, so a null index silently picks an element and a later
    not-null filter on the result is optimised away.
    """
    expr = None
    for i, v in enumerate(labels):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr


def _lookup(mapping: dict[str, str], key: Column) -> Column:
    """CASE key WHEN k THEN v ... END (null for an unknown key)."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == k, F.lit(v)) if expr is None else expr.when(key == k, F.lit(v))
    return expr


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def raw_events_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped(_read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")).drop("n")


def _mapped(ev: DataFrame) -> DataFrame:
    """The raw columns of rows of ``events``, and their event number ``n``."""
    kind, eid, uid = F.col("event_type"), F.col("event_id"), F.col("user_id")
    earned, redeemed = kind == "view", kind == "purchase"
    category = F.concat(F.lit(" Cat_"), (eid % 7).cast("string"))
    return ev.select(
        eid.alias("n"),
        F.date_format("ts", TIME_TEXT_FORMAT).alias("event_time"),
        F.concat(F.lit(" u_"), F.format_string("%04d", uid)).alias("user_id"),
        _pick(GENDER_BY_MOD4, uid % 4).alias("gender"),
        _lookup(EVENT_TYPE_BY_KIND, kind).alias("event_type"),
        F.when(earned | redeemed | ((kind == "signup") & (eid % 3 == 0)), category)
         .alias("transaction_category"),
        F.when(redeemed | (earned & (eid % 101 != 0)), F.col("value")).alias("miles_amount"),
        F.when(eid % 97 != 0, _pick(PLATFORM_BY_MOD3, eid % 3)).alias("platform"),
        _pick(UTM_BY_MOD5, uid % 5).alias("utm_source"),
        _pick(COUNTRY_BY_MOD5, (uid + eid) % 5).alias("country"),
    )


def raw_events_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = F.expr("ts + make_ym_interval(0, int(event_id % 3))")
    rows = _mapped(_read(spark, sf_dir, "events").withColumn("ts", spread))
    n = F.col("n")

    def every(k: int, value, column: str) -> Column:
        return F.when(n % k == 0, value).otherwise(F.col(column))

    faulty = rows.select(
        "n", "event_time", "user_id", "transaction_category",
        F.when(n % 53 == 0, F.lit(None)).when(n % 59 == 0, "Unknown").otherwise(F.col("gender")).alias("gender"),
        every(61, F.lit("Teleport"), "event_type").alias("event_type"),
        every(83, -F.col("miles_amount"), "miles_amount").alias("miles_amount"),
        every(67, F.lit("fridge"), "platform").alias("platform"),
        F.when(n % 71 == 0, F.lit(None)).when(n % 73 == 0, "pigeon").otherwise(F.col("utm_source")).alias("utm_source"),
        every(79, F.lit("xx"), "country").alias("country"))
    times = F.when(n % 89 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return faulty.withColumn("time", F.explode(times))


def faulty_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables of a build with faults that cleaning and the models cannot
    produce: users missing from the dimension, a next period that is the
    period itself, and totals that do not add up."""
    number = F.regexp_extract("user_id", "[0-9]+", 0).cast("int")
    grain, label = F.col("period_grain"), F.col("cohort_type")
    offset = F.col("months_since_first")

    def changed(name: str, **columns: Column) -> DataFrame:
        return tables[name].withColumns(columns)

    return {
        **tables,
        "dim_users": tables["dim_users"].where(number % 10 != 3),
        "int_user_activity_periods": changed("int_user_activity_periods", next_period_start=F.when(
            number % 7 == 2, F.col("period_start")).otherwise(F.col("next_period_start"))),
        "rpt_growth_accounting": changed("rpt_growth_accounting", user_count=F.col("user_count") + F.when(
            (grain == "month") & (label == "retained") & (F.col("country") == "SG"), 1).otherwise(0)),
        "rpt_net_growth": changed("rpt_net_growth", net_growth=F.col("net_growth") + 1),
        "rpt_cohort_retention": changed(
            "rpt_cohort_retention",
            retained_users=F.when(offset == 2, 0).otherwise(F.col("retained_users")),
            retention_pct=F.when(offset == 0, F.col("retention_pct") - 0.5).otherwise(F.col("retention_pct"))),
        "rpt_engagement": changed("rpt_engagement", active_users=F.col("active_users") + F.when(
            F.col("event_type") == "all", 1).otherwise(0)),
        "rpt_miles_economy": changed("rpt_miles_economy", total_miles=F.when(
            F.col("transactions") % 2 == 0, -F.col("total_miles")).otherwise(F.col("total_miles"))),
    }


def months_missing(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The faulty tables, each side of a comparison without a month that the
    other has (the faulty log's events lie in January to March)."""
    def without(name: str, column: str, month: int) -> DataFrame:
        return tables[name].where(F.month(column) != month)

    return {**tables, "dim_users": without("dim_users", "first_seen_at", 1),
            "rpt_cohort_retention": without("rpt_cohort_retention", "cohort_month", 2),
            "fct_events": without("fct_events", "event_date", 2), "rpt_engagement": without("rpt_engagement", "month", 3),
            "rpt_growth_accounting": without("rpt_growth_accounting", "period_start", 3)}


def raw_events_o(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # Plain equi-join: Catalyst broadcasts the customer side only when its
    # estimated size is under spark.sql.autoBroadcastJoinThreshold, and AQE
    # re-checks that with the real shuffle size; otherwise sort-merge.
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    prio = F.substring("o_orderpriority", 1, 1)
    money = prio.isin("1", "2")
    cust = F.col("o_custkey")
    return joined.select(
        F.date_format("o_orderdate", TIME_TEXT_FORMAT).alias("event_time"),
        F.concat(F.lit("c_"), cust.cast("string")).alias("user_id"),
        _pick(GENDER_BY_MOD4, cust % 4).alias("gender"),
        _lookup(EVENT_TYPE_BY_PRIORITY, prio).alias("event_type"),
        F.when(money, F.concat(F.lit("Seg_"), (F.col("o_orderkey") % 7).cast("string")))
         .alias("transaction_category"),
        F.when(money, F.col("o_totalprice")).alias("miles_amount"),
        _lookup(PLATFORM_BY_STATUS, F.col("o_orderstatus")).alias("platform"),
        _lookup(UTM_BY_SEGMENT, F.col("c_mktsegment")).alias("utm_source"),
        _pick(COUNTRY_BY_MOD5, F.col("c_nationkey") % 5).alias("country"),
    )


def raw_events(spark: SparkSession, sf_dir: str, fixture: str) -> DataFrame:
    df = {"e": raw_events_e, "o": raw_events_o, "b": raw_events_b}[fixture](spark, sf_dir)
    return df.select(*RAW_COLUMNS)
