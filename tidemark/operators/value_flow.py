"""P11 ``value_flow``, P12 ``category_totals``, P13 ``value_economy``.

Flow: earned / redeemed miles per month, rows without an amount excluded.
Category totals: all-time earned miles per category; rows without an amount
are *not* excluded there, so ``transactions`` counts them and the total of a
category with only null amounts is null (kept as in the reference).
Totals are sums of doubles, unrounded; their last bits depend on the order in
which partial sums meet, so the registered keys round them (``money_rounded``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import month_start

EARNED, REDEEMED = "miles_earned", "miles_redeemed"
ECONOMY_COLUMNS = ("month", "event_type", "total_miles", "transactions", "transaction_category")


def value_flow(fct: DataFrame) -> DataFrame:
    return (fct.where(F.col("event_type").isin(EARNED, REDEEMED) & F.col("miles_amount").isNotNull())
            .groupBy(month_start("event_date").alias("month"), "event_type")
            .agg(F.sum("miles_amount").alias("total_miles"),
                 F.count(F.lit(1)).alias("transactions"))
            .select(*ECONOMY_COLUMNS[:4], F.lit(None).cast("string").alias("transaction_category")))


def category_totals(fct: DataFrame) -> DataFrame:
    return (fct.where((F.col("event_type") == EARNED) & F.col("transaction_category").isNotNull())
            .groupBy("transaction_category")
            .agg(F.sum("miles_amount").alias("total_miles"),
                 F.count(F.lit(1)).alias("transactions"))
            .select(F.lit(None).cast("date").alias("month"), F.lit(EARNED).alias("event_type"),
                    "total_miles", "transactions", "transaction_category"))


def money_rounded(economy: DataFrame) -> DataFrame:
    """Totals to whole cents: equal for any order of summation."""
    return economy.withColumn("total_miles", F.round("total_miles", 2))


def value_economy(fct: DataFrame) -> DataFrame:
    return value_flow(fct).unionByName(category_totals(fct))
