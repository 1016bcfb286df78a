"""Q1-Q11: the dashboard's queries over the stored models, finished in Spark.

Charts are not drawn; each function returns the small DataFrame a chart
would plot, with the client-side touches (signed churn, direction label,
``M+n`` pivot, series label) done as Column expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import capitalised, months_apart, titled_label

SUMMARY_LABEL = "all"


def growth_by_grain(ga: DataFrame, grain: str) -> DataFrame:
    """Users per period and cohort type at one grain; churn also signed negative."""
    users = F.sum("user_count").cast("long")
    out = (ga.where(F.col("period_grain") == grain)
           .groupBy("period_start", "cohort_type")
           .agg(users.alias("user_count")))
    signed = F.when(F.col("cohort_type") == "churned", -F.col("user_count")).otherwise(F.col("user_count"))
    return (out.select("period_start", "cohort_type", "user_count", signed.alias("signed_user_count"),
                       capitalised("cohort_type").alias("label"))
            .orderBy("period_start", "cohort_type"))


def growth_month(ga: DataFrame) -> DataFrame:
    return growth_by_grain(ga, "month")


def growth_week(ga: DataFrame) -> DataFrame:
    return growth_by_grain(ga, "week")


def net_growth_series(net: DataFrame) -> DataFrame:
    direction = F.when(F.col("net_growth") >= 0, F.lit("growth")).otherwise(F.lit("contraction"))
    return net.select("*", direction.alias("direction")).orderBy("period_start")


def retention_long(ret: DataFrame) -> DataFrame:
    return ret.orderBy("cohort_month", "months_since_first")


def retention_triangle(ret: DataFrame) -> DataFrame:
    """Cohort (``yyyy-MM``) x ``M+n`` matrix of retention percentages.

    The pivot columns are M+0 to the number of calendar months between the
    first cohort and the last active month, so they follow from the log's span
    alone and not from which offsets happen to have a user.  An offset before
    M+0 (an activity dated before the first event) raises.
    """
    span = ret.agg(
        F.max(months_apart(F.expr("add_months(cohort_month, int(months_since_first))"), F.lit("1970-01-01"))).alias("last"),
        F.min(months_apart("cohort_month", F.lit("1970-01-01"))).alias("first"),
        F.min("months_since_first").alias("least")).first()
    offsets = range(span["last"] - span["first"] + 1) if span["last"] is not None else range(0)
    if span["least"] is not None and span["least"] < 0:
        raise ValueError(f"retention offset {span['least']} lies before the cohort's first month")
    labelled = ret.select(
        F.date_format("cohort_month", "yyyy-MM").alias("cohort"),
        F.concat(F.lit("M+"), F.col("months_since_first").cast("string")).alias("offset"),
        "retention_pct",
    )
    return (labelled.groupBy("cohort")
            .pivot("offset", [f"M+{n}" for n in offsets])
            .agg(F.first("retention_pct"))
            .orderBy("cohort"))


def engagement_all(eng: DataFrame) -> DataFrame:
    return eng.where(F.col("event_type") == SUMMARY_LABEL).orderBy("month")


def event_mix(eng: DataFrame) -> DataFrame:
    return eng.where(F.col("event_type") != SUMMARY_LABEL).orderBy("month", "event_type")


def event_types(eng: DataFrame) -> DataFrame:
    """Distinct event types of the per-type engagement rows (one chart series each)."""
    return eng.where(F.col("event_type") != SUMMARY_LABEL).select("event_type").distinct().orderBy("event_type")


def users_by(dim: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    name = alias or column
    return (dim.groupBy(F.col(column).alias(name))
            .agg(F.count(F.lit(1)).alias("users"))
            .orderBy(F.col("users").desc(), F.col(name).asc_nulls_last()))


def users_by_source(dim: DataFrame) -> DataFrame:
    return users_by(dim, "acquisition_source")


def users_by_country(dim: DataFrame) -> DataFrame:
    return users_by(dim, "country")


def users_by_platform(dim: DataFrame) -> DataFrame:
    return users_by(dim, "first_platform", "platform")


def value_flow_series(economy: DataFrame) -> DataFrame:
    return (economy.where(F.col("month").isNotNull())
            .select("*", titled_label("event_type").alias("series"))
            .orderBy("month", "event_type"))


def top_categories(economy: DataFrame) -> DataFrame:
    return (economy.where(F.col("month").isNull())
            .orderBy(F.col("total_miles").desc_nulls_last(), F.col("transaction_category")))
