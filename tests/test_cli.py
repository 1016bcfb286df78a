"""The command line: build -> check -> serve -> sql on a raw CSV log."""

import glob
import os
import shutil

from conftest import SF_SMALL
from tidemark.__main__ import main
from tidemark.session import scratch_path
from tidemark.sources.fixtures import raw_events
from tidemark.sources.raw_events import write_raw_csv


def test_cli_round_trip(spark, capsys):
    base = scratch_path(spark, "cli").replace("file:", "")
    raw = raw_events(spark, SF_SMALL, "e")
    write_raw_csv(raw.coalesce(1), f"{base}/staging_csv")
    os.makedirs(f"{base}/in")
    shutil.copy(glob.glob(f"{base}/staging_csv/part-*.csv")[0], f"{base}/in/event_stream.csv")

    assert main(["build", "--raw", f"{base}/in", "--out", f"{base}/wh"]) == 0
    out = capsys.readouterr().out
    assert f"{raw.where('platform is not null').count()} rows added" in out
    assert "90 of 90 checks passed" in out

    assert main(["build", "--raw", f"{base}/in", "--out", f"{base}/wh", "--no-check"]) == 0
    assert "0 rows added" in capsys.readouterr().out

    assert main(["check", "--out", f"{base}/wh"]) == 0
    assert main(["serve", "--out", f"{base}/wh", "growth_month", "users_by_country"]) == 0
    out = capsys.readouterr().out
    assert "== growth_month" in out and "== users_by_country" in out
    assert main(["sql", "--out", f"{base}/wh",
                 "SELECT count(*) AS n FROM main_reports.rpt_net_growth"]) == 0
    assert capsys.readouterr().out.splitlines()[-2:] == ["n", "2"]  # January and the trailing churn month
    assert main(["sql", "--out", f"{base}/wh", "SELECT user_id FROM main_marts.dim_users"]) == 0
    users = raw.where("platform is not null").select("user_id").distinct().count()
    assert len(capsys.readouterr().out.splitlines()) >= users + 1  # every row, however many
