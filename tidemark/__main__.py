"""Command line: the three steps of the reference's workflow.

    python -m tidemark build --raw DIR --out ROOT [--daily] [--from D --to D] [--buckets N] [--strict]
    python -m tidemark check --out ROOT
    python -m tidemark serve --out ROOT [QUERY ...] [--csv DIR]
    python -m tidemark sql --out ROOT "SELECT ... FROM main_reports.rpt_net_growth"

``build`` loads the raw CSV log incrementally and rebuilds every table,
``check`` runs the 90 checks over the stored tables (exit status 1 when one
fails), ``serve`` prints (or writes as CSV) the dashboard queries.  Run it
with ``spark-submit -m``-style launchers or plain ``python``; the session
takes the submit configuration when there is one.
"""

from __future__ import annotations

import argparse
import sys

from tidemark.operators import serving
from tidemark.operators.quality import run_checks
from tidemark.plans.build import build_all, register_tables
from tidemark.plans.models import Models
from tidemark.session import build_session
from tidemark.sources.raw_events import read_raw_csv, read_raw_daily

SERVING = {
    "growth_month": lambda m: serving.growth_month(m.growth_accounting),
    "growth_week": lambda m: serving.growth_week(m.growth_accounting),
    "net_growth_series": lambda m: serving.net_growth_series(m.net_growth),
    "retention": lambda m: serving.retention_long(m.cohort_retention),
    "retention_triangle": lambda m: serving.retention_triangle(m.cohort_retention),
    "engagement_all": lambda m: serving.engagement_all(m.engagement),
    "event_mix": lambda m: serving.event_mix(m.engagement),
    "event_types": lambda m: serving.event_types(m.engagement),
    "users_by_source": lambda m: serving.users_by_source(m.dim_users),
    "users_by_country": lambda m: serving.users_by_country(m.dim_users),
    "users_by_platform": lambda m: serving.users_by_platform(m.dim_users),
    "value_flow_series": lambda m: serving.value_flow_series(m.value_economy),
    "top_categories": lambda m: serving.top_categories(m.value_economy),
}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="load the raw log and rebuild every table")
    b.add_argument("--raw", required=True, help="folder holding event_stream.csv, or daily date=* folders")
    b.add_argument("--out", required=True, help="warehouse root")
    b.add_argument("--daily", action="store_true", help="raw folder is laid out as date=YYYY-MM-DD/")
    b.add_argument("--from", dest="date_from")
    b.add_argument("--to", dest="date_to")
    b.add_argument("--buckets", type=int, default=None)
    b.add_argument("--strict", action="store_true", help="an empty existing target never loads")
    b.add_argument("--no-check", action="store_true")
    c = sub.add_parser("check", help="run the check suite over stored tables")
    c.add_argument("--out", required=True)
    s = sub.add_parser("serve", help="print the dashboard queries")
    s.add_argument("--out", required=True)
    s.add_argument("queries", nargs="*", default=list(SERVING))
    s.add_argument("--csv", default=None, help="write each result as CSV below this folder")
    q = sub.add_parser("sql", help="run SQL over the stored layers (main_reports.*, main_marts.*, ...)")
    q.add_argument("--out", required=True)
    q.add_argument("statement")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session()
    if args.cmd == "build":
        raw = (read_raw_daily(spark, args.raw, args.date_from, args.date_to) if args.daily
               else read_raw_csv(spark, args.raw))
        res = build_all(spark, raw, args.out, on_empty="strict" if args.strict else "full",
                        check=not args.no_check, buckets=args.buckets)
        print(f"load {res.load.load_id}: {res.load.rows} rows added, {res.load.late_rows} late rows dropped")
        for name, sec in res.seconds.items():
            print(f"  {name:28s} {sec:8.2f}s")
        if res.checks is not None:
            return _report(res.checks)
        return 0
    if args.cmd == "sql":
        register_tables(spark, args.out)
        _print_all(spark.sql(args.statement))
        return 0
    models = Models.from_tables(spark, args.out)
    if args.cmd == "check":
        return _report(run_checks(models.tables()))
    for name in args.queries:
        df = SERVING[name](models)
        if args.csv:
            df.write.mode("overwrite").option("header", True).csv(f"{args.csv}/{name}")
        else:
            print(f"== {name}")
            _print_all(df)
    return 0


def _print_all(df) -> None:
    """Every row, tab-separated, streamed a partition at a time."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def _report(checks) -> int:
    failing = checks.where("failing_rows > 0").orderBy("check_id").collect()
    total = checks.count()
    for r in failing:
        print(f"FAIL {r.check_name} ({r.table_name}.{r.column_name}): {r.failing_rows}")
    print(f"{total - len(failing)} of {total} checks passed")
    return 1 if failing else 0


if __name__ == "__main__":
    sys.exit(main())
