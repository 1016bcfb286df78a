"""DuckDB SQL for the data-quality keys, from the oracle's own catalogue.

The catalogue below states the declared checks in declaration order.  A check
fails on the rows its query returns.  For the faulty log the tables are
changed first, as ``CHANGES`` states, because cleaning cannot produce every
fault.
"""

from __future__ import annotations

from oracle.sql import with_models

# The declared column checks.  "table: column check ..."; a
# check is n (not null), u (unique), v:LIST (accepted values), r:TABLE.COLUMN
# (relationship) or e:"..." (must hold; "condition => ..." only where the
# condition holds; "name = ..." where the check is named).
LISTS = {
    "gender": "male|female|non-binary|prefer not to say",
    "type": "miles_earned|miles_redeemed|reward_search|share|like",
    "platform": "web|ios|android",
    "utm": "facebook|google|organic|referral|tiktok",
    "country": "SG|MY|PH|ID|TH",
    "grain": "day|week|month",
    "label": "new|retained|resurrected|churned",
}
DECLARED = """
stg_events: event_id n u
stg_events: event_time n
stg_events: event_date n
stg_events: user_id n
stg_events: gender n v:gender
stg_events: event_type n v:type
stg_events: miles_amount e:miles_amount is not null => > 0
stg_events: platform n v:platform
stg_events: utm_source n v:utm
stg_events: country n v:country
int_user_activity_periods: user_id n
int_user_activity_periods: period_grain n v:grain
int_user_activity_periods: period_start n
int_user_activity_periods: prior_period_start n
int_user_activity_periods: next_period_start n
dim_users: user_sk n u
dim_users: user_id n u
dim_users: gender n
dim_users: country n
dim_users: first_platform n
dim_users: acquisition_source n
dim_users: first_event_type n
dim_users: first_seen_at n
dim_users: last_seen_at n
fct_events: event_id n u
fct_events: user_sk n r:dim_users.user_sk
fct_events: user_id n
fct_events: event_time n
fct_events: event_date n
fct_events: event_type n v:type
fct_events: platform n
fct_events: utm_source n
fct_events: country n
rpt_growth_accounting: period_grain n v:grain
rpt_growth_accounting: period_start n
rpt_growth_accounting: cohort_type n v:label
rpt_growth_accounting: country n
rpt_growth_accounting: acquisition_source n
rpt_growth_accounting: first_platform n
rpt_growth_accounting: user_count n e:> 0
rpt_net_growth: period_start n u
rpt_net_growth: net_growth n
rpt_net_growth: new_users n
rpt_net_growth: retained_users n
rpt_net_growth: resurrected_users n
rpt_net_growth: churned_users n
rpt_cohort_retention: cohort_month n
rpt_cohort_retention: months_since_first n e:>= 0
rpt_cohort_retention: retained_users n e:> 0
rpt_cohort_retention: retained_users e:retained_users_never_exceeds_cohort_size = <= cohort_size
rpt_cohort_retention: cohort_size n e:> 0
rpt_cohort_retention: retention_pct n e:>= 0 and retention_pct <= 100
rpt_engagement: month n
rpt_engagement: event_type n
rpt_engagement: total_events n
rpt_engagement: active_users n e:>= 1
rpt_engagement: events_per_user n e:>= 1
rpt_miles_economy: event_type n
rpt_miles_economy: total_miles n e:> 0
rpt_miles_economy: transactions n e:> 0
"""

# the invariants over several tables, with the table each is listed under
INVARIANTS = {
    # everyone of a cohort is there in its own month
    "dq_retention_m0": ("rpt_cohort_retention", """
        select cohort_month, months_since_first, retention_pct from {rpt_cohort_retention}
        where months_since_first = 0 and retention_pct <> 100"""),
    # a cohort is as large in the report as in the dimension
    "dq_cohort_size": ("rpt_cohort_retention", """
        with sizes as (
            select date_trunc('month', first_seen_at)::date as cohort_month, 1 as in_dim, null as in_rpt from {dim_users}
            union all select cohort_month, null, cohort_size from {rpt_cohort_retention})
        select cohort_month, sum(in_dim)::bigint as dim_size, max(in_rpt) as rpt_size,
               (sum(in_dim) - max(in_rpt))::bigint as diff
        from sizes group by cohort_month having sum(in_dim) <> max(in_rpt)"""),
    # a month has as many active users in the engagement report as in the log
    "dq_engagement_active": ("rpt_engagement", """
        select month, active_users as eng_active, fct_active, active_users - fct_active as diff
        from {rpt_engagement},
             lateral (select count(distinct user_id) as fct_active from fct_events
                      where date_trunc('month', event_date)::date = month) seen
        where event_type = 'all' and fct_active > 0 and active_users <> fct_active"""),
    # new, retained and resurrected users of a month are its active users
    "dq_growth_active": ("rpt_growth_accounting", """
        with actives as (
            select date_trunc('month', event_date)::date as period_start, count(distinct user_id) as fct_active_users
            from fct_events group by all)
        select period_start, sum(user_count)::bigint as ga_active_users, fct_active_users,
               (sum(user_count) - fct_active_users)::bigint as diff
        from {rpt_growth_accounting} join actives using (period_start)
        where period_grain = 'month' and cohort_type <> 'churned'
        group by period_start, fct_active_users having sum(user_count) <> fct_active_users"""),
    # net growth is what came less what went
    "dq_net_balances": ("rpt_net_growth", """
        select period_start, net_growth, net_growth - gap as calculated, gap as diff
        from (select *, net_growth - list_sum([new_users, resurrected_users, -churned_users])::bigint as gap from {rpt_net_growth})
        where gap <> 0"""),
    # a user has one label in a period
    "dq_no_double_count": ("int_user_activity_periods", """
        select user_id, period_grain, period_start, len(list(cohort_type)) as cohort_count
        from classified group by user_id, period_grain, period_start having len(list(cohort_type)) > 1"""),
}

# Changes of the faulty log's tables, stated on either side.
NUMBER = "regexp_extract(user_id, '[0-9]+')::int"
CHANGES = {
    "dim_users": f"select * from dim_users where {NUMBER} % 10 <> 3",
    "int_user_activity_periods": f"""
        select * replace (if({NUMBER} % 7 = 2, period_start, next_period_start) as next_period_start)
        from int_user_activity_periods""",
    "rpt_growth_accounting": """
        select * replace (user_count + if(period_grain = 'month' and cohort_type = 'retained' and country = 'SG', 1, 0) as user_count)
        from rpt_growth_accounting""",
    "rpt_net_growth": "select * replace (net_growth + 1 as net_growth) from rpt_net_growth",
    "rpt_cohort_retention": """
        select * replace (if(months_since_first = 2, 0, retained_users) as retained_users,
                          if(months_since_first = 0, retention_pct - 0.5, retention_pct) as retention_pct)
        from rpt_cohort_retention""",
    "rpt_engagement": "select * replace (active_users + if(event_type = 'all', 1, 0) as active_users) from rpt_engagement",
    "rpt_miles_economy": """
        select * replace (if(transactions % 2 = 0, -total_miles, total_miles) as total_miles) from rpt_miles_economy""",
}


def _catalogue() -> list[tuple]:
    """(id, table, column, kind, argument, name) of each declared check."""
    out: list[tuple] = []
    for line in DECLARED.strip().splitlines():
        table, rest = line.split(": ", 1)
        rest, _, must = rest.partition(" e:")
        column, *marks = rest.split(" ")
        for mark in marks + ([f"e:{must}"] if must else []):
            kind = {"n": "not_null", "u": "unique", "v": "accepted_values", "r": "relationships", "e": "expression"}[mark[0]]
            name, argument = f"{kind}_{table}_{column}", mark[2:]
            if kind == "expression" and " = " in argument and "=>" not in argument:
                name, argument = argument.split(" = ", 1)
            out.append((len(out) + 1, table, column, kind, argument, name))
    return out


CATALOGUE = _catalogue()


def _table(fixture: str, name: str) -> str:
    return f"changed_{name}" if fixture == "b" and name in CHANGES else name


def _named(c: tuple, full: bool = True) -> str:
    i, table, column, kind, _, name = c
    more = f"'{name}' as check_name, '{kind}' as kind, " if full else ""
    return f"{i} as check_id, {more}'{table}' as table_name, '{column}' as column_name"


def _bad(c: tuple) -> str:
    """The condition of a failing row."""
    _, _, column, kind, argument, _ = c
    if kind == "not_null":
        return f"{column} is null"
    if kind == "accepted_values":
        return f"not list_contains(string_split('{LISTS[argument]}', '|'), {column})"
    condition, _, must = argument.rpartition(" => ")
    return f"{condition or 'true'} and ({column} {must}) = false"


def _records(fixture: str, c: tuple) -> str:
    """(value, n_records) of what fails a check on values."""
    _, table, column, kind, argument, _ = c
    source = _table(fixture, table)
    value = f"{column}::varchar as value, count(*) as n_records from {source}"
    if kind == "unique":
        return f"select {value} group by {column} having count({column}) > 1"
    if kind == "accepted_values":
        return f"select {value} where {_bad(c)} group by {column}"
    parent, key = argument.split(".")
    return f"select {value} where {column} not in (select {key} from {_table(fixture, parent)} where {key} is not null) group by {column}"


def _counted(fixture: str, c: tuple) -> str:
    """One row: how much fails."""
    kind = c[3]
    if kind in ("not_null", "accepted_values", "expression"):
        return f"select {_named(c)}, count_if({_bad(c)})::bigint as failing_rows from {_table(fixture, c[1])}"
    n = "count(*)" if kind == "unique" else "coalesce(sum(n_records), 0)::bigint"
    return f"select {_named(c)}, {n} as failing_rows from ({_records(fixture, c)})"


def _invariant(fixture: str, name: str) -> str:
    tables = {t: _table(fixture, t) for t in (
        "dim_users", "rpt_growth_accounting", "rpt_net_growth", "rpt_cohort_retention", "rpt_engagement")}
    return f"from ({INVARIANTS[name][1].format(**tables)})"


# the comparisons that also tell of months that one side lacks, on the faulty
# log's tables with such months taken out
FULL = {
    "dq_cohort_size_full": """
        with months as (
            select date_trunc('month', first_seen_at)::date as cohort_month, count(*) as dim_size, null::bigint as rpt_size
            from changed_dim_users where month(first_seen_at) <> 1 group by all
            union all select cohort_month, null, max(cohort_size) from changed_rpt_cohort_retention
            where month(cohort_month) <> 2 group by cohort_month)
        select cohort_month, max(dim_size) as dim_size, max(rpt_size) as rpt_size,
               coalesce(max(dim_size), 0) - coalesce(max(rpt_size), 0) as diff
        from months group by cohort_month having max(dim_size) is distinct from max(rpt_size)""",
    "dq_engagement_active_full": """
        with months as (
            select month, active_users as eng_active, null::bigint as fct_active
            from changed_rpt_engagement where event_type = 'all' and month(month) <> 3
            union all select date_trunc('month', event_date)::date, null, count(distinct user_id)
            from fct_events where month(event_date) <> 2 group by 1)
        select month, max(eng_active) as eng_active, max(fct_active) as fct_active,
               coalesce(max(eng_active), 0) - coalesce(max(fct_active), 0) as diff
        from months group by month having max(eng_active) is distinct from max(fct_active)""",
    "dq_growth_active_full": """
        with months as (
            select period_start, sum(user_count)::bigint as ga_active_users, null::bigint as fct_active_users
            from changed_rpt_growth_accounting
            where period_grain = 'month' and cohort_type <> 'churned' and month(period_start) <> 3 group by period_start
            union all select date_trunc('month', event_date)::date, null, count(distinct user_id)
            from fct_events where month(event_date) <> 2 group by 1)
        select period_start, max(ga_active_users) as ga_active_users, max(fct_active_users) as fct_active_users,
               coalesce(max(ga_active_users), 0) - coalesce(max(fct_active_users), 0) as diff
        from months group by period_start having max(ga_active_users) is distinct from max(fct_active_users)""",
}


def _all_counts(fixture: str, double_count: str) -> list[str]:
    """One statement per check: how much fails."""
    counts = [_counted(fixture, c) for c in CATALOGUE]
    for i, (name, (table, _)) in enumerate(INVARIANTS.items(), len(CATALOGUE) + 1):
        body = f"({double_count})" if name == "dq_no_double_count" else f"({_invariant(fixture, name)})"
        counts.append(f"select {_named((i, table, '', 'singular', '', name))}, count(*) as failing_rows from {body}")
    return counts


def check_sql(fixture: str) -> dict[str, str]:
    """key -> SQL of the check keys over a fixture's tables."""
    changed = "".join(f",\nchanged_{t} as ({sql})" for t, sql in CHANGES.items()) if fixture == "b" else ""
    join = " union all ".join
    kinds = {"dq_not_null": "not_null", "dq_expression": "expression"}
    lists = {"dq_unique": "unique", "dq_accepted_values": "accepted_values", "dq_relationships": "relationships"}
    parts = {k: join(_counted(fixture, c) for c in CATALOGUE if c[3] == kind) for k, kind in kinds.items()}
    for key, kind in lists.items():
        parts[key] = join(f"select {_named(c, False)}, * from ({_records(fixture, c)})" for c in CATALOGUE if c[3] == kind)
    out = {k: with_models(fixture, v, extra=changed) for k, v in parts.items()}
    out |= {n: with_models(fixture, _invariant(fixture, n), extra=changed) for n in INVARIANTS if n != "dq_no_double_count"}
    # labels of the changed spine
    spine = f"({CHANGES['int_user_activity_periods']})" if fixture == "b" else "int_user_activity_periods"
    out["dq_no_double_count"] = with_models(fixture, _invariant(fixture, "dq_no_double_count"), spine=spine)
    out["dq_summary"] = with_models(fixture, join(_all_counts(fixture, out["dq_no_double_count"])), extra=changed)
    # kept load by load: from the log itself, no table changed after the build
    labels = with_models(fixture, _invariant("e", "dq_no_double_count"))
    out["dq_summary_by_loads"] = with_models(fixture, join(_all_counts("e", labels)))
    if fixture == "b":
        out |= {n: with_models(fixture, f"from ({sql})", extra=changed) for n, sql in FULL.items()}
    return out
