"""Every registered key against its DuckDB oracle on the sf0.001 tables
(the driver runs the same comparison at sf0.01; tools/compare_oracle.py too)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle.sql import oracle_sql
from tidemark.plans.registry import queries
from tools.compare_oracle import TABLES, _digest, frame_rows

QUERIES = queries()
SQL = oracle_sql()
LOAD_KEYS = {"stg_events_incremental", "stg_events_stream", "dim_users_stream", "stored_growth_month", "layered_sql",
             "stg_events_csv", "stg_events_daily"}
FAST_KEYS = sorted(k for k in QUERIES if k.removesuffix("_o") not in LOAD_KEYS)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("key", FAST_KEYS)
def test_matches_oracle(spark, duck, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    srows = frame_rows(sdf.columns, [tuple(r) for r in sdf.collect()])
    cur = duck.execute(SQL[key])
    cols = [d[0] for d in cur.description]
    drows = frame_rows(cols, cur.fetchall())
    assert sorted(sdf.columns) == sorted(cols)
    assert len(srows) == len(drows)
    assert _digest(srows) == _digest(drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["period_start", "cohort_type", "user_count", "signed_user_count", "label"]
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_triangle_spans_the_calendar_at_another_scale(spark):
    """The columns follow from the log's months, whatever offsets have users."""
    names = [QUERIES["retention_triangle_o"](spark, d).columns for d in (SF_SMALL, "/root/testdata/sf0.01")]
    assert names[0] == names[1] == ["cohort"] + [f"M+{n}" for n in range(80)]
