"""D1-D11: the data-quality suite.  Every check passes when it returns no row.

* Column checks (not-null, accepted values, expression) are row predicates:
  all checks of one table are counted in **one** aggregate, i.e. one scan.
* Uniqueness groups the non-null values with partial aggregation and keeps
  values seen more than once.
* Relationships pre-aggregate the child keys (a hot key becomes one row per
  map task) before the anti join to the parent keys.
* The six end-to-end invariants (D6-D11) return their failing rows.

``run_checks(models)`` returns one row per declared check with the number of
failing rows: offending records for row predicates and relationships,
duplicated values for uniqueness.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import month_start
from tidemark.operators.growth import classify

# Accepted-value lists of the declared column checks.
GENDERS = ("male", "female", "non-binary", "prefer not to say")
EVENT_TYPES = ("miles_earned", "miles_redeemed", "reward_search", "share", "like")
PLATFORMS = ("web", "ios", "android")
UTM_SOURCES = ("facebook", "google", "organic", "referral", "tiktok")
COUNTRIES = ("SG", "MY", "PH", "ID", "TH")
PERIOD_GRAINS = ("day", "week", "month")
COHORT_TYPES = ("new", "retained", "resurrected", "churned")


@dataclass(frozen=True)
class Check:
    check_id: int
    table: str
    column: str
    kind: str  # not_null | unique | accepted_values | relationships | expression | singular
    values: tuple = ()
    expression: str | None = None
    where: str | None = None
    to_table: str | None = None
    to_column: str | None = None
    name: str | None = None

    @property
    def check_name(self) -> str:
        return self.name or f"{self.kind}_{self.table}_{self.column}"


def _checks() -> list[Check]:
    rows = [
        # The 84 declared column checks, in declaration order
        # (table, column, kind, argument).
        ("stg_events", "event_id", "not_null", None),
        ("stg_events", "event_id", "unique", None),
        ("stg_events", "event_time", "not_null", None),
        ("stg_events", "event_date", "not_null", None),
        ("stg_events", "user_id", "not_null", None),
        ("stg_events", "gender", "not_null", None),
        ("stg_events", "gender", "accepted_values", GENDERS),
        ("stg_events", "event_type", "not_null", None),
        ("stg_events", "event_type", "accepted_values", EVENT_TYPES),
        ("stg_events", "miles_amount", "expression", ("> 0", "miles_amount is not null", None)),
        ("stg_events", "platform", "not_null", None),
        ("stg_events", "platform", "accepted_values", PLATFORMS),
        ("stg_events", "utm_source", "not_null", None),
        ("stg_events", "utm_source", "accepted_values", UTM_SOURCES),
        ("stg_events", "country", "not_null", None),
        ("stg_events", "country", "accepted_values", COUNTRIES),
        ("int_user_activity_periods", "user_id", "not_null", None),
        ("int_user_activity_periods", "period_grain", "not_null", None),
        ("int_user_activity_periods", "period_grain", "accepted_values", PERIOD_GRAINS),
        ("int_user_activity_periods", "period_start", "not_null", None),
        ("int_user_activity_periods", "prior_period_start", "not_null", None),
        ("int_user_activity_periods", "next_period_start", "not_null", None),
        ("dim_users", "user_sk", "not_null", None),
        ("dim_users", "user_sk", "unique", None),
        ("dim_users", "user_id", "not_null", None),
        ("dim_users", "user_id", "unique", None),
        ("dim_users", "gender", "not_null", None),
        ("dim_users", "country", "not_null", None),
        ("dim_users", "first_platform", "not_null", None),
        ("dim_users", "acquisition_source", "not_null", None),
        ("dim_users", "first_event_type", "not_null", None),
        ("dim_users", "first_seen_at", "not_null", None),
        ("dim_users", "last_seen_at", "not_null", None),
        ("fct_events", "event_id", "not_null", None),
        ("fct_events", "event_id", "unique", None),
        ("fct_events", "user_sk", "not_null", None),
        ("fct_events", "user_sk", "relationships", ("dim_users", "user_sk")),
        ("fct_events", "user_id", "not_null", None),
        ("fct_events", "event_time", "not_null", None),
        ("fct_events", "event_date", "not_null", None),
        ("fct_events", "event_type", "not_null", None),
        ("fct_events", "event_type", "accepted_values", EVENT_TYPES),
        ("fct_events", "platform", "not_null", None),
        ("fct_events", "utm_source", "not_null", None),
        ("fct_events", "country", "not_null", None),
        ("rpt_growth_accounting", "period_grain", "not_null", None),
        ("rpt_growth_accounting", "period_grain", "accepted_values", PERIOD_GRAINS),
        ("rpt_growth_accounting", "period_start", "not_null", None),
        ("rpt_growth_accounting", "cohort_type", "not_null", None),
        ("rpt_growth_accounting", "cohort_type", "accepted_values", COHORT_TYPES),
        ("rpt_growth_accounting", "country", "not_null", None),
        ("rpt_growth_accounting", "acquisition_source", "not_null", None),
        ("rpt_growth_accounting", "first_platform", "not_null", None),
        ("rpt_growth_accounting", "user_count", "not_null", None),
        ("rpt_growth_accounting", "user_count", "expression", ("> 0", None, None)),
        ("rpt_net_growth", "period_start", "not_null", None),
        ("rpt_net_growth", "period_start", "unique", None),
        ("rpt_net_growth", "net_growth", "not_null", None),
        ("rpt_net_growth", "new_users", "not_null", None),
        ("rpt_net_growth", "retained_users", "not_null", None),
        ("rpt_net_growth", "resurrected_users", "not_null", None),
        ("rpt_net_growth", "churned_users", "not_null", None),
        ("rpt_cohort_retention", "cohort_month", "not_null", None),
        ("rpt_cohort_retention", "months_since_first", "not_null", None),
        ("rpt_cohort_retention", "months_since_first", "expression", (">= 0", None, None)),
        ("rpt_cohort_retention", "retained_users", "not_null", None),
        ("rpt_cohort_retention", "retained_users", "expression", ("> 0", None, None)),
        ("rpt_cohort_retention", "retained_users", "expression",
         ("<= cohort_size", None, "retained_users_never_exceeds_cohort_size")),
        ("rpt_cohort_retention", "cohort_size", "not_null", None),
        ("rpt_cohort_retention", "cohort_size", "expression", ("> 0", None, None)),
        ("rpt_cohort_retention", "retention_pct", "not_null", None),
        ("rpt_cohort_retention", "retention_pct", "expression",
         (">= 0 and retention_pct <= 100", None, None)),
        ("rpt_engagement", "month", "not_null", None),
        ("rpt_engagement", "event_type", "not_null", None),
        ("rpt_engagement", "total_events", "not_null", None),
        ("rpt_engagement", "active_users", "not_null", None),
        ("rpt_engagement", "active_users", "expression", (">= 1", None, None)),
        ("rpt_engagement", "events_per_user", "not_null", None),
        ("rpt_engagement", "events_per_user", "expression", (">= 1", None, None)),
        ("rpt_miles_economy", "event_type", "not_null", None),
        ("rpt_miles_economy", "total_miles", "not_null", None),
        ("rpt_miles_economy", "total_miles", "expression", ("> 0", None, None)),
        ("rpt_miles_economy", "transactions", "not_null", None),
        ("rpt_miles_economy", "transactions", "expression", ("> 0", None, None)),
    ]
    out = []
    for i, (table, column, kind, arg) in enumerate(rows, start=1):
        if kind == "accepted_values":
            out.append(Check(i, table, column, kind, values=arg))
        elif kind == "expression":
            expr, where, name = arg
            out.append(Check(i, table, column, kind, expression=expr, where=where, name=name))
        elif kind == "relationships":
            out.append(Check(i, table, column, kind, to_table=arg[0], to_column=arg[1]))
        else:
            out.append(Check(i, table, column, kind))
    return out


COLUMN_CHECKS: list[Check] = _checks()

SINGULAR = ("dq_retention_m0", "dq_cohort_size", "dq_engagement_active",
            "dq_growth_active", "dq_net_balances", "dq_no_double_count")
SINGULAR_TABLE = {
    "dq_retention_m0": "rpt_cohort_retention",
    "dq_cohort_size": "rpt_cohort_retention",
    "dq_engagement_active": "rpt_engagement",
    "dq_growth_active": "rpt_growth_accounting",
    "dq_net_balances": "rpt_net_growth",
    "dq_no_double_count": "int_user_activity_periods",
}
# models each singular check reads
SINGULAR_INPUTS = {
    "dq_retention_m0": ("rpt_cohort_retention",),
    "dq_cohort_size": ("dim_users", "rpt_cohort_retention"),
    "dq_engagement_active": ("rpt_engagement", "fct_events"),
    "dq_growth_active": ("rpt_growth_accounting", "fct_events"),
    "dq_net_balances": ("rpt_net_growth",),
    "dq_no_double_count": ("int_user_activity_periods",),
}
SINGULAR_CHECKS: list[Check] = [
    Check(len(COLUMN_CHECKS) + i, SINGULAR_TABLE[n], "", "singular", name=n)
    for i, n in enumerate(SINGULAR, start=1)
]
ALL_CHECKS: list[Check] = COLUMN_CHECKS + SINGULAR_CHECKS

ROW_KINDS = ("not_null", "accepted_values", "expression")


def tables_of(kind: str) -> tuple[str, ...]:
    """Tables a kind of column check reads (parents of relationships included)."""
    names = [c.table for c in COLUMN_CHECKS if c.kind == kind]
    names += [c.to_table for c in COLUMN_CHECKS if c.kind == kind and c.to_table]
    return tuple(dict.fromkeys(names))
SUMMARY_COLUMNS = ("check_id", "check_name", "kind", "table_name", "column_name", "failing_rows")


# ---------------------------------------------------------------- column checks

def failing_predicate(check: Check) -> Column:
    """True on a failing row; null (not failing) when the predicate is unknown."""
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return ~c.isin(*check.values)
    if check.kind == "expression":
        fail = ~F.expr(f"{check.column} {check.expression}")
        return fail if check.where is None else (F.expr(check.where) & fail)
    raise ValueError(f"{check.kind} is not a row predicate")


def _meta(check: Check) -> list[Column]:
    return [F.lit(check.check_id).alias("check_id"), F.lit(check.check_name).alias("check_name"),
            F.lit(check.kind).alias("kind"), F.lit(check.table).alias("table_name"),
            F.lit(check.column).alias("column_name")]


def row_check_counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row-predicate checks of one table in a single aggregate (one scan)."""
    counts = df.agg(*[F.count(F.when(failing_predicate(c), F.lit(1))).alias(f"c{c.check_id}")
                      for c in checks])
    return named_counts(counts, checks)


def named_counts(counts: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check from a single row of counts, one column each."""
    rows = F.array(*[F.struct(*_meta(c), F.col(f"c{c.check_id}").cast("long").alias("failing_rows"))
                     for c in checks])
    return counts.select(F.inline(rows))


def duplicate_values(df: DataFrame, check: Check) -> DataFrame:
    """Values seen more than once: (value, n_records)."""
    c = F.col(check.column)
    return (df.where(c.isNotNull()).groupBy(c.cast("string").alias("value"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def rejected_values(df: DataFrame, check: Check) -> DataFrame:
    """Values outside the accepted list: (value, n_records); nulls pass."""
    c = F.col(check.column)
    return (df.where(failing_predicate(check)).groupBy(c.cast("string").alias("value"))
            .agg(F.count(F.lit(1)).alias("n_records")))


def orphan_keys(child: DataFrame, parent: DataFrame, check: Check) -> DataFrame:
    """Child keys without a parent row: (value, n_records)."""
    c = F.col(check.column)
    keys = (child.where(c.isNotNull()).groupBy(c.alias("value"))
            .agg(F.count(F.lit(1)).alias("n_records")))
    parents = parent.select(F.col(check.to_column).alias("value"))
    return keys.join(parents, "value", "left_anti").select(
        F.col("value").cast("string").alias("value"), "n_records")


def _listing(tables: dict[str, DataFrame], kind: str) -> DataFrame:
    parts = []
    for c in COLUMN_CHECKS:
        if c.kind != kind:
            continue
        df = tables[c.table]
        body = {"unique": lambda: duplicate_values(df, c),
                "accepted_values": lambda: rejected_values(df, c),
                "relationships": lambda: orphan_keys(df, tables[c.to_table], c)}[kind]()
        parts.append(body.select(*_meta(c)[:1], *_meta(c)[3:], "value", "n_records"))
    return union_all(parts)


def unique_failures(tables: dict[str, DataFrame]) -> DataFrame:
    return _listing(tables, "unique")


def accepted_values_failures(tables: dict[str, DataFrame]) -> DataFrame:
    return _listing(tables, "accepted_values")


def relationship_failures(tables: dict[str, DataFrame]) -> DataFrame:
    return _listing(tables, "relationships")


def row_check_summary(tables: dict[str, DataFrame], kinds=ROW_KINDS) -> DataFrame:
    parts = []
    for table in dict.fromkeys(c.table for c in COLUMN_CHECKS):
        checks = [c for c in COLUMN_CHECKS if c.table == table and c.kind in kinds]
        if checks:
            parts.append(row_check_counts(tables[table], checks))
    return union_all(parts)


# ---------------------------------------------------------------- singular checks

def retention_m0(ret: DataFrame) -> DataFrame:
    return (ret.where((F.col("months_since_first") == 0) & (F.col("retention_pct") != 100.0))
            .select("cohort_month", "months_since_first", "retention_pct"))


def _compared(left: DataFrame, right: DataFrame, key: str, a: str, b: str, full: bool) -> DataFrame:
    """Keys whose values differ.  The reference joins inner, so a key that one
    side lacks is not compared; with ``full`` it is a failing row, the missing
    value null, the difference against 0."""
    if not full:
        return (left.join(right, key, "inner").where(F.col(a) != F.col(b))
                .select(key, a, b, (F.col(a) - F.col(b)).alias("diff")))
    zero = F.lit(0)
    return (left.join(right, key, "full").where(~F.col(a).eqNullSafe(F.col(b)))
            .select(key, a, b, (F.coalesce(F.col(a), zero) - F.coalesce(F.col(b), zero)).alias("diff")))


def cohort_size_mismatch(dim: DataFrame, ret: DataFrame, full: bool = False) -> DataFrame:
    dim_sizes = (dim.groupBy(month_start("first_seen_at").alias("cohort_month"))
                 .agg(F.count(F.lit(1)).alias("dim_size")))
    rpt_sizes = ret.groupBy("cohort_month").agg(F.max("cohort_size").alias("rpt_size"))
    return _compared(dim_sizes, rpt_sizes, "cohort_month", "dim_size", "rpt_size", full)


def _fct_monthly_active(fct: DataFrame, name: str, key: str) -> DataFrame:
    # distinct (month, user) pairs first: the partial aggregate drops repeats
    # before the shuffle, then a plain count per month
    return (fct.select(month_start("event_date").alias(key), "user_id").distinct()
            .groupBy(key).agg(F.count(F.lit(1)).alias(name)))


def engagement_active_mismatch(eng: DataFrame, fct: DataFrame, full: bool = False) -> DataFrame:
    e = eng.where(F.col("event_type") == "all").select("month", F.col("active_users").alias("eng_active"))
    f = _fct_monthly_active(fct, "fct_active", "month")
    return _compared(e, f, "month", "eng_active", "fct_active", full)


def growth_active_mismatch(ga: DataFrame, fct: DataFrame, full: bool = False) -> DataFrame:
    g = (ga.where((F.col("period_grain") == "month") & F.col("cohort_type").isin("new", "retained", "resurrected"))
         .groupBy("period_start").agg(F.sum("user_count").cast("long").alias("ga_active_users")))
    f = _fct_monthly_active(fct, "fct_active_users", "period_start")
    return _compared(g, f, "period_start", "ga_active_users", "fct_active_users", full)


def net_balance_mismatch(net: DataFrame) -> DataFrame:
    calc = F.col("new_users") + F.col("resurrected_users") - F.col("churned_users")
    return (net.where(F.col("net_growth") != calc)
            .select("period_start", "net_growth", calc.alias("calculated"),
                    (F.col("net_growth") - calc).alias("diff")))


def double_counted(spine: DataFrame) -> DataFrame:
    """Users with more than one label in one period.  The labels come out of
    ``classify`` partitioned by user, so this group-by adds no shuffle."""
    return (classify(spine).groupBy("user_id", "period_grain", "period_start")
            .agg(F.count(F.lit(1)).alias("cohort_count"))
            .where(F.col("cohort_count") > 1))


def singular_failures(name: str, tables: dict[str, DataFrame]) -> DataFrame:
    t = tables
    return {
        "dq_retention_m0": lambda: retention_m0(t["rpt_cohort_retention"]),
        "dq_cohort_size": lambda: cohort_size_mismatch(t["dim_users"], t["rpt_cohort_retention"]),
        "dq_engagement_active": lambda: engagement_active_mismatch(t["rpt_engagement"], t["fct_events"]),
        "dq_growth_active": lambda: growth_active_mismatch(t["rpt_growth_accounting"], t["fct_events"]),
        "dq_net_balances": lambda: net_balance_mismatch(t["rpt_net_growth"]),
        "dq_no_double_count": lambda: double_counted(t["int_user_activity_periods"]),
    }[name]()


# D7 to D9 in the form that also tells of months that one side lacks
FULL: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "dq_cohort_size_full": lambda t: cohort_size_mismatch(t["dim_users"], t["rpt_cohort_retention"], full=True),
    "dq_engagement_active_full": lambda t: engagement_active_mismatch(t["rpt_engagement"], t["fct_events"], full=True),
    "dq_growth_active_full": lambda t: growth_active_mismatch(t["rpt_growth_accounting"], t["fct_events"], full=True),
}


# ---------------------------------------------------------------- whole suite

def count_rows(df: DataFrame, check: Check, weight: str | None = None) -> DataFrame:
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return df.agg(F.coalesce(n, F.lit(0)).cast("long").alias("failing_rows")).select(
        *_meta(check), "failing_rows")


def run_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per check (90): id, name, kind, table, column, failing rows."""
    parts = [row_check_summary(tables)]
    for c in COLUMN_CHECKS:
        if c.kind == "unique":
            parts.append(count_rows(duplicate_values(tables[c.table], c), c))
        elif c.kind == "relationships":
            parts.append(count_rows(orphan_keys(tables[c.table], tables[c.to_table], c), c, "n_records"))
    for c in SINGULAR_CHECKS:
        parts.append(count_rows(singular_failures(c.check_name, tables), c))
    return union_all(parts)


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
