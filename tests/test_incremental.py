"""High-water-mark loads (P2, ST1-ST5): split loads, ties, empty targets, drift, replay."""

import datetime as dt
import io
import os
from concurrent.futures import ThreadPoolExecutor
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, ev, raw_frame
from tidemark.operators.staging import clean_events
from tidemark.plans.loads import dim_stream, incremental_replay, stream_replay
from tidemark.session import scratch_path
from tidemark.sources.fixtures import raw_events
from tidemark.sources.raw_events import RAW_COLUMNS, write_raw_csv
from tidemark.streaming import commits
from tidemark.streaming.incremental import IncrementalTable, SchemaDriftError
from tidemark.streaming.stream import compact_dim_users, dim_users_stream, read_dim_users, stage_events_stream


def _stg(spark, rows):
    return clean_events(raw_frame(spark, rows))


def test_split_loads_equal_one_load(spark):
    stg = clean_events(raw_events(spark, SF_SMALL, "e"))
    times = sorted({r.event_time for r in stg.select("event_time").collect()})
    cuts = [times[len(times) // 3], times[2 * len(times) // 3]]
    target = IncrementalTable(spark, scratch_path(spark, "split"))
    lo = None
    for hi in cuts + [None]:
        part = stg
        if lo is not None:
            part = part.where(F.col("event_time") > F.lit(lo))
        if hi is not None:
            part = part.where(F.col("event_time") <= F.lit(hi))
        target.append(part)
        lo = hi
    assert target.read().exceptAll(stg).count() == 0
    assert stg.exceptAll(target.read()).count() == 0
    assert [r.load_id for r in target.manifest().collect()] == [0, 1, 2]


def test_rerun_adds_nothing_and_counts_late(spark):
    stg = clean_events(raw_events(spark, SF_SMALL, "o"))
    target = IncrementalTable(spark, scratch_path(spark, "rerun"))
    first = target.append(stg)
    second = target.append(stg)
    assert first.rows == stg.count() and second.rows == 0 and second.late_rows == stg.count()
    assert target.read().count() == stg.count()


def test_tie_and_late_rows_are_lost(spark):
    target = IncrementalTable(spark, scratch_path(spark, "tie"))
    target.append(_stg(spark, [ev("2024-01-02 00:00:00", "u1")]))
    res = target.append(_stg(spark, [ev("2024-01-02 00:00:00", "u2"),    # tie: lost
                                     ev("2024-01-01 00:00:00", "u3"),    # late: lost
                                     ev("2024-01-03 00:00:00", "u4")]))  # loaded
    assert (res.rows, res.late_rows) == (1, 2)
    assert sorted(r.user_id for r in target.read().collect()) == ["u1", "u4"]
    assert target.high_water_mark() == dt.datetime(2024, 1, 3)


def test_empty_target_strict_and_full(spark):
    empty = _stg(spark, [ev("2024-01-01 00:00:00", "u1")]).where(F.lit(False))
    batch = _stg(spark, [ev("2024-01-05 00:00:00", "u1")])
    strict = IncrementalTable(spark, scratch_path(spark, "strict"))
    strict.append(empty)
    assert strict.exists() and strict.high_water_mark() is None
    res = strict.append(batch, on_empty="strict")
    assert res.rows == 0 and strict.read().count() == 0
    full = IncrementalTable(spark, scratch_path(spark, "full"))
    full.append(empty)
    assert full.append(batch).rows == 1 and full.read().count() == 1


def test_schema_drift_fails_before_write(spark):
    target = IncrementalTable(spark, scratch_path(spark, "drift"))
    batch = _stg(spark, [ev("2024-01-01 00:00:00", "u1")])
    with pytest.raises(SchemaDriftError):
        target.append(batch.withColumn("extra", F.lit(1)))
    with pytest.raises(SchemaDriftError):
        target.append(batch.withColumn("miles_amount", F.col("miles_amount").cast("string")))
    assert not target.exists()


def test_replayed_batch_is_skipped(spark):
    target = IncrementalTable(spark, scratch_path(spark, "replay"))
    batch = _stg(spark, [ev("2024-01-01 00:00:00", "u1")])
    assert not target.append(batch, writer="s", batch_id=7).skipped
    again = target.append(batch, writer="s", batch_id=7)
    assert again.skipped and again.rows == 1 and target.read().count() == 1
    later = _stg(spark, [ev("2024-01-02 00:00:00", "u2")])
    assert target.append(later, writer="other", batch_id=7).rows == 1


def _users(target):
    return sorted(r.user_id for r in target.read().collect())


def test_stream_after_batch_load_keeps_both(spark):
    base = scratch_path(spark, "mixed")
    target = IncrementalTable(spark, f"{base}/t")
    target.append(_stg(spark, [ev("2024-01-01 00:00:00", "u1")]))
    write_raw_csv(raw_frame(spark, [ev("2024-01-09 00:00:00", "u9")]), f"{base}/in")
    stage_events_stream(spark, f"{base}/in", target, f"{base}/cp").awaitTermination()
    assert _users(target) == ["u1", "u9"]
    # a lost checkpoint: the stream begins anew, reads all again, loads what is later
    write_raw_csv(raw_frame(spark, [ev("2024-02-01 00:00:00", "u10")]), f"{base}/in", "append")
    stage_events_stream(spark, f"{base}/in", target, f"{base}/cp-new").awaitTermination()
    assert _users(target) == ["u1", "u10", "u9"]
    assert len({r.writer for r in target.manifest().collect()}) == 3


def test_stream_fails_on_a_bad_row(spark):
    base = scratch_path(spark, "bad-row").replace("file:", "")
    os.makedirs(f"{base}/in")
    with open(f"{base}/in/a.csv", "w") as f:
        f.write(",".join(RAW_COLUMNS) + "\n2024-01-01 00:00:00,u1,male,like,,abc,web,organic,sg\n")
    target = IncrementalTable(spark, f"{base}/t")
    with pytest.raises(Exception):
        stage_events_stream(spark, f"{base}/in", target, f"{base}/cp").awaitTermination()
    assert not target.exists()


def test_mark_reaches_the_scan(spark, monkeypatch):
    target = IncrementalTable(spark, scratch_path(spark, "pushed"))
    target.append(_stg(spark, [ev("2024-01-01 00:00:00", "u1")]))
    path = scratch_path(spark, "pushed-batch")
    _stg(spark, [ev("2024-01-02 00:00:00", "u2")]).write.parquet(path)
    plans = []
    layout = IncrementalTable._layout

    def seen(self, df):
        buf = io.StringIO()
        with redirect_stdout(buf):
            layout(self, df).explain("formatted")
        plans.append(buf.getvalue())
        return layout(self, df)

    monkeypatch.setattr(IncrementalTable, "_layout", seen)
    assert target.append(spark.read.parquet(path)).rows == 1
    assert "GreaterThan(event_time,2024-01-01" in plans[0]
    assert plans[0].index("Exchange") < plans[0].index("Filter")  # the plan prints from the top


def _day(spark, day, user):
    return _stg(spark, [ev(f"2024-01-{day:02d} 00:00:00", user)])


def test_log_is_compacted(spark, monkeypatch):
    monkeypatch.setattr(commits, "COMPACT_EVERY", 2)
    target = IncrementalTable(spark, scratch_path(spark, "compact"))
    for day in range(1, 6):
        target.append(_day(spark, day, f"u{day}"))
    assert [n for n in target.log.files.names(target.log.path) if n.startswith("upto")] == ["upto-0000000001.json", "upto-0000000003.json"]
    assert [r.load_id for r in target.manifest().collect()] == [0, 1, 2, 3, 4]
    seen = []
    read = commits.Files.read
    monkeypatch.setattr(commits.Files, "read", lambda self, path: seen.append(path.rsplit("/", 1)[1]) or read(self, path))
    assert _users(target) == ["u1", "u2", "u3", "u4", "u5"]
    assert seen == ["upto-0000000003.json", "entry-0000000004.json"]


@pytest.mark.parametrize("left", ["", '{"load_id": 0}', '{"load_id": 0}\n{"entries": 3}', '{"load_id": 0}\n{"load'])
def test_a_compaction_left_half_way_loses_nothing(spark, left):
    target = IncrementalTable(spark, scratch_path(spark, "killed"))
    for day in (1, 2, 3):
        target.append(_day(spark, day, f"u{day}"))
    assert target.log.files.put_if_absent(f"{target.log.path}/upto-0000000002.json", left)
    assert target.log.files.put_if_absent(f"{target.log.path}/upto-0000000063.json", left)
    assert target.exists() and _users(target) == ["u1", "u2", "u3"]
    assert target.append(_day(spark, 4, "u4")).load_id == 3
    assert _users(target) == ["u1", "u2", "u3", "u4"]


def test_an_entry_that_is_gone_is_told(spark):
    target = IncrementalTable(spark, scratch_path(spark, "gap"))
    for day in (1, 2, 3):
        target.append(_day(spark, day, f"u{day}"))
    target.log.files.delete(target.log._entry(1))
    with pytest.raises(commits.BrokenLogError):
        target.read()


@pytest.mark.parametrize("how", ["put_if_absent", "renamed"])
def test_an_entry_is_put_once(spark, how):
    files, path = commits.Files(spark), scratch_path(spark, "put") + "/entry"
    put = getattr(files, how)
    assert put(path, "one é") and not put(path, "two")
    assert files.read(path) == "one é" and files.names(os.path.dirname(path)) == ["entry"]


def test_two_writers_of_one_load_id_both_survive(spark, monkeypatch):
    path = scratch_path(spark, "two")
    one, two = IncrementalTable(spark, path), IncrementalTable(spark, path)
    one.append(_day(spark, 1, "u1"))
    write = IncrementalTable._write
    state = {"other": True}

    def slow(self, *args):
        out = write(self, *args)
        if self is one and state.pop("other", None):  # the other writer commits between this one's write and commit
            assert two.append(_stg(spark, [ev("2024-01-03 00:00:00", "u3")])).load_id == 1
        return out

    monkeypatch.setattr(IncrementalTable, "_write", slow)
    res = one.append(_stg(spark, [ev("2024-01-02 00:00:00", "late now"), ev("2024-01-04 00:00:00", "u4")]))
    assert (res.load_id, res.rows, res.late_rows) == (2, 1, 1)
    assert _users(one) == ["u1", "u3", "u4"]
    assert len(one.log.files.names(one.data_root)) == 3  # the first attempt is gone


def test_writers_at_the_same_time(spark):
    path = scratch_path(spark, "threads")

    def load(i):
        return IncrementalTable(spark, path).append(_day(spark, i + 1, f"u{i}"), keep_late=True)

    with ThreadPoolExecutor(4) as pool:
        results = list(pool.map(load, range(4)))
    table = IncrementalTable(spark, path)
    assert sorted(r.load_id for r in results) == [0, 1, 2, 3] == [x.load_id for x in table.loads()]
    assert table.read().count() + table.late().count() == 4 and table.high_water_mark() == dt.datetime(2024, 1, 4)
    table.replay_late()
    assert _users(table) == ["u0", "u1", "u2", "u3"]


def test_late_rows_are_kept_and_replayed_once(spark):
    target = IncrementalTable(spark, scratch_path(spark, "late"))
    target.append(_day(spark, 5, "u5"))
    assert target.replay_late() is None
    target.append(_day(spark, 3, "u3").union(_day(spark, 6, "u6")), keep_late=True)
    target.append(_day(spark, 6, "tie").union(_day(spark, 4, "dropped")))
    assert sorted(r.user_id for r in target.late().collect()) == ["u3"]
    res = target.replay_late()
    assert (res.load_id, res.rows) == (3, 1) and target.replay_late() is None and target.late().count() == 0
    assert _users(target) == ["u3", "u5", "u6"] and target.high_water_mark() == dt.datetime(2024, 1, 6)
    assert target.append(_day(spark, 7, "u7").union(_day(spark, 1, "u1")), keep_late=True).late_rows == 1
    assert [r.user_id for r in target.late().collect()] == ["u1"]


def test_vacuum_removes_what_no_entry_names(spark):
    target = IncrementalTable(spark, scratch_path(spark, "vacuum"))
    target.append(_day(spark, 1, "u1"))
    _day(spark, 9, "u9").write.parquet(f"{target.data_root}/load_id=00001-dead")
    assert target.vacuum() == 0 and target.vacuum(0) == 1 and target.vacuum(0) == 0
    assert _users(target) == ["u1"]


def test_a_merge_left_half_way_is_passed_over(spark):
    base = scratch_path(spark, "merge")
    for i, user in enumerate(("u1", "u2")):
        write_raw_csv(raw_frame(spark, [ev(f"2024-01-0{i + 1} 00:00:00", user)]), f"{base}/in", "append")
        dim_users_stream(spark, f"{base}/in", f"{base}/t", f"{base}/cp").awaitTermination()
    for left in ("merged=000001", "batch=000002"):  # no mark of success
        read_dim_users(spark, f"{base}/t").limit(0).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{base}/t/{left}")
    assert sorted(r.user_id for r in read_dim_users(spark, f"{base}/t").collect()) == ["u1", "u2"]


def test_dimension_folders_are_merged(spark):
    base = scratch_path(spark, "dim")
    for i, user in enumerate(("u1", "u2", "u1")):
        write_raw_csv(raw_frame(spark, [ev(f"2024-01-0{i + 1} 00:00:00", user)]), f"{base}/in", "append")
        dim_users_stream(spark, f"{base}/in", f"{base}/t", f"{base}/cp").awaitTermination()
        if i == 1:
            compact_dim_users(spark, f"{base}/t")
    got = {r.user_id: (r.first_seen_at.day, r.last_seen_at.day) for r in read_dim_users(spark, f"{base}/t").collect()}
    assert got == {"u1": (1, 3), "u2": (2, 2)}


def test_uncommitted_load_folder_is_ignored(spark):
    target = IncrementalTable(spark, scratch_path(spark, "orphan"))
    target.append(_stg(spark, [ev("2024-01-01 00:00:00", "u1")]))
    # a crashed load: data written, manifest row missing
    _stg(spark, [ev("2024-01-09 00:00:00", "u9")]).write.parquet(f"{target.data_root}/load_id=00001")
    assert target.read().count() == 1
    assert target.high_water_mark() == dt.datetime(2024, 1, 1)
    res = target.append(_stg(spark, [ev("2024-01-02 00:00:00", "u2")]))
    assert res.load_id == 1 and sorted(r.user_id for r in target.read().collect()) == ["u1", "u2"]


def test_registered_scenarios_return_whole_log(spark):
    stg = clean_events(raw_events(spark, SF_SMALL, "e"))
    for scenario in (incremental_replay, stream_replay):
        out = scenario(spark, SF_SMALL, "e")
        assert out.exceptAll(stg).count() == 0 and stg.exceptAll(out).count() == 0
    from tidemark.operators.marts import build_dim_users
    dim = dim_stream(spark, SF_SMALL, "o")
    ref = build_dim_users(clean_events(raw_events(spark, SF_SMALL, "o")))
    assert dim.exceptAll(ref.select(*dim.columns)).count() == 0 and dim.count() == ref.count()


def test_time_range_read_prunes_loads_and_months(spark):
    import io
    from contextlib import redirect_stdout

    stg = clean_events(raw_events(spark, SF_SMALL, "o"))
    target = IncrementalTable(spark, scratch_path(spark, "ranges"))
    target.append(stg.where(F.col("event_time") < F.lit("1997-01-01").cast("timestamp")))
    target.append(stg)
    lo, hi = dt.datetime(1998, 3, 15), dt.datetime(1998, 6, 30, 23, 59)
    got = target.read(lo, hi)
    want = stg.where(F.col("event_time").between(F.lit(lo), F.lit(hi)))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    buf = io.StringIO()
    with redirect_stdout(buf):
        got.explain("formatted")
    plan = buf.getvalue()
    assert "PartitionFilters: [isnotnull(event_month" in plan
    assert "load_id=00000" not in plan  # the first load ends before the range
