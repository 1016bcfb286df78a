"""Spark session defaults and the shared scratch folder.

The library never assumes a machine-local folder on a cluster: scratch
tables (lineage cuts, incremental targets built by the registered queries)
go under ``spark.checkpoint.dir``.  Only a local-mode session (tests, bench)
gets a private folder created for it when that setting is unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Semantics are pinned to UTC: event text is cast to an instant in the
# session zone, exactly as the reference casts in its session zone.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of a DataFrame are removed once it is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    On a cluster pass ``master=None`` and let the submit configuration win;
    ``shuffle_partitions`` should then be sized so that one shuffle partition
    holds roughly 128-256 MB of the widest exchange (the event dedup).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


#: Compressed bytes that a task reads from a shuffle and from files, at most.
#: Rows of the event log take some thirty times as much in memory.
TASK_SHUFFLE_BYTES = 8 << 20
TASK_FILE_BYTES = 32 << 20


def bounded_tasks(spark: SparkSession) -> None:
    """Lower what one task takes in, so that larger tables make more tasks, not
    larger ones.  A session that asks for less keeps its own values."""
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in (("spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_SHUFFLE_BYTES),
                      ("spark.sql.files.maxPartitionBytes", TASK_FILE_BYTES)):
        if size(spark.conf.get(key)) > most:
            spark.conf.set(key, f"{most}b")


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is unset; on a cluster it must name a shared folder"
        )
    path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


# scratch folders of this process that still stand, by application
_scratch: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "tidemark", f"{name}-{uuid.uuid4().hex[:12]}")
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_epoch(spark: SparkSession) -> tuple[str, int]:
    """Changes when the scratch folders are cleared; what is kept by it is valid as long as it stays."""
    app = spark.sparkContext.applicationId
    return app, _cleared.get(app, 0)


_cleared: dict[str, int] = {}


def clear_scratch(spark: SparkSession) -> int:
    """Remove every scratch folder made so far and return their number.  Call
    it when no result that reads them is needed any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    app = spark.sparkContext.applicationId
    paths = _scratch.pop(app, [])
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    _cleared[app] = _cleared.get(app, 0) + 1
    return len(paths)
