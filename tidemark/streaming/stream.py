"""ST5 / ST6: the incremental load and the user dimension as Structured Streaming.

* ``stage_events_stream``: a file source over raw CSV deliveries, each
  micro-batch cleaned and appended by high-water mark inside
  ``foreachBatch``.  The load carries the stream's id (kept in its checkpoint)
  and the batch id: a micro-batch replayed after a failure finds both in the
  manifest and is skipped.  Batch loads, other streams, and a stream begun
  anew with an empty checkpoint have other ids, so none of theirs is skipped.
  ``maxFilesPerTrigger`` stays unset: one delivery is one micro-batch, which
  is what makes "late" mean the same as in a batch load.
* ``dim_users_stream``: the dimension's one aggregate (min of the
  first-event struct, max of time) runs unchanged on a stream in **update**
  mode: each trigger appends only the users it changed, as one folder per
  batch id (overwritten on replay, so idempotent).  Because the aggregate is
  a min / max, ``read_dim_users`` merges the folders with the same
  aggregate; no trigger rewrites the whole dimension, and the state store
  (one row per user) is spread over the executors.  ``compact_dim_users``
  merges the folders so far into one; a reader opens the newest merged folder
  and the batches after it.

``withWatermark`` is deliberately not used for ST5: its cut-off rule is not
"strictly above the stored maximum".
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.marts import dim_from_state, first_and_last, merge_first_and_last
from tidemark.operators.staging import clean_events
from tidemark.sources.raw_events import read_raw_stream
from tidemark.streaming.commits import Files
from tidemark.streaming.incremental import IncrementalTable


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark keeps in a stream's checkpoint: the same after a restart,
    another one for a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def stage_events_stream(spark: SparkSession, source_dir: str, target: IncrementalTable,
                        checkpoint: str, on_empty: str = "full") -> StreamingQuery:
    """Start an available-now stream loading every new delivery into ``target``."""

    def load(batch: DataFrame, batch_id: int) -> None:
        target.append(clean_events(batch), on_empty=on_empty, writer=stream_id(spark, checkpoint), batch_id=batch_id)

    return (read_raw_stream(spark, source_dir).writeStream
            .foreachBatch(load)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def dim_users_stream(spark: SparkSession, source_dir: str, table_path: str,
                     checkpoint: str) -> StreamingQuery:
    """Maintain ``dim_users`` from raw deliveries (update mode, changed users only)."""

    def publish(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{table_path}/batch={batch_id:06d}")

    state = first_and_last(clean_events(read_raw_stream(spark, source_dir)))
    return (state.writeStream.outputMode("update")
            .foreachBatch(publish)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def _dim_folders(spark: SparkSession, table_path: str) -> list[str]:
    """The newest merged folder and the batches after it; folders that a
    writer left half-way lack the mark of success and do not count."""
    files = Files(spark)
    names = [n for n in files.names(table_path) if files.exists(f"{table_path}/{n}/_SUCCESS")]
    merged = max((n for n in names if n.startswith("merged=")), default=None)
    last = int(merged.split("=")[1]) if merged else -1
    later = [n for n in names if n.startswith("batch=") and int(n.split("=")[1]) > last]
    return [f"{table_path}/{n}" for n in ([merged] if merged else []) + later]


def _dim_state(spark: SparkSession, table_path: str) -> DataFrame:
    updates = spark.read.parquet(*_dim_folders(spark, table_path)).select("user_id", "first", "last_seen_at")
    return merge_first_and_last(updates)


def compact_dim_users(spark: SparkSession, table_path: str) -> None:
    """Merge all batches so far into one folder; run it between triggers."""
    last = _dim_folders(spark, table_path)[-1].rsplit("=", 1)[1]
    _dim_state(spark, table_path).write.mode("overwrite").parquet(f"{table_path}/merged={last}")


def read_dim_users(spark: SparkSession, table_path: str) -> DataFrame:
    """The dimension as of the last committed trigger: merge of all updates."""
    return dim_from_state(_dim_state(spark, table_path))
