"""Tables that cut lineage, written below the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.  A lost
    executor costs a reread, never a recomputation of what came before.  The
    shuffle files of the write go with its end, not when the driver collects
    its garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.parquet(path)


def text_batches(spark: SparkSession, records: int = 500) -> None:
    """Whole documents go to Python in batches of at most so many rows, so a
    batch of long texts stays small.  Results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))


def text_input(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, typed; any other column of docs is left out, so
    none can clash with an operator's own."""
    text_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
