"""Point queries through the file index: only the files that may hold a value are opened."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.operators.staging import clean_events
from tidemark.plans.loads import quarters
from tidemark.session import scratch_path
from tidemark.sources.fixtures import raw_events
from tidemark.streaming.file_index import FileIndex
from tidemark.streaming.incremental import IncrementalTable


@pytest.fixture(scope="module")
def staged(spark):
    base = scratch_path(spark, "file_index")
    staging = IncrementalTable(spark, f"{base}/stg_events")
    index = FileIndex(spark, f"{base}/index", staging)
    for k, part in enumerate(quarters(clean_events(raw_events(spark, SF_SMALL, "o")))):
        staging.append(part)
        if k == 2:
            assert index.follow(staging) == 3 and index.follow(staging) == 0
    return staging, index  # the last load is not indexed


def _all_files(staging):
    return {f for load in staging.loads()[:3] for f in staging.read_load(load.load_id).inputFiles()}


def test_point_query_opens_only_matching_files(staged):
    staging, index = staged
    event = staging.read_load(1).orderBy("event_time", "event_id").first()
    rows = index.read_where("event_id", [event.event_id])
    assert sorted(rows.collect()) == sorted(staging.read().where(F.col("event_id") == event.event_id).collect())
    indexed = _all_files(staging)
    opened = set(rows.inputFiles()) & indexed
    # the file that holds it, and rarely one that the filter lets through
    assert 1 <= len(opened) <= 2 and len(indexed) > 50


def test_every_value_is_found(staged):
    """No file that holds a value is passed over, for every user of the log."""
    staging, index = staged
    users = [r[0] for r in staging.read().select("user_id").distinct().orderBy("user_id").collect()]
    got = index.read_where("user_id", users[::7])
    want = staging.read().where(F.col("user_id").isin(users[::7]))
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() > 0


def test_unknown_values_and_columns(staged):
    staging, index = staged
    assert index.files_with("event_id", ["no such key"]) == [] and index.files_with("event_id", []) == []
    assert index.read_where("event_id", ["no such key"]).isEmpty()
    with pytest.raises(ValueError, match="not indexed"):
        index.files_with("country", ["SG"])


def test_table_without_loads(spark):
    base = scratch_path(spark, "file_index_empty")
    staging = IncrementalTable(spark, f"{base}/stg_events")
    index = FileIndex(spark, f"{base}/index", staging)
    assert index.follow(staging) == 0 and index.read_where("user_id", ["a"]).isEmpty()
