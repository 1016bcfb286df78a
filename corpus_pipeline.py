"""The training-data pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept, and returns a DataFrame that is written as Parquet and read back as the
next stage's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import contaminated_words
from tidemark.llm.minhash_dedup import near_duplicates
from tidemark.llm.mixing import repeated
from tidemark.llm.store import stored
from tidemark.llm.token_files import token_files
from tidemark.llm.toxicity import classified
from tidemark.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among docs, rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = docs.select(F.struct("*").alias("doc"), "doc_id", "text")  # no column of docs can clash
    return classified(rows, labels).where("predicted = 0").select("doc.*")


def _rows(docs: DataFrame) -> DataFrame:
    """(row, doc): every row with a number of its own, so that a stage decides on
    rows, whatever their ids.  docs are the stage's stored input: its scan
    numbers the rows alike each time it is read."""
    return docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc"))


def _texts(rows: DataFrame) -> DataFrame:
    """Rows as the operators take them, under their numbers."""
    return rows.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text"))


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    return rows.join(gone, "row", "left_anti").select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: of the smallest
    doc_id (null after all others), of equal ones the first row.  Rows with
    equal or null ids are documents of their own."""
    rows = _rows(docs)
    found = stored(near_duplicates(_texts(rows)).select(F.col("doc_id").alias("row"), "component_id", "kept"), "pipeline-groups")
    groups = found.join(found.where("not kept").select("component_id").distinct(), "component_id", "left_semi")
    members = groups.join(rows.select("row", F.col("doc.doc_id").alias("id")), "row").select(
        "component_id", F.struct(F.col("id").isNull().alias("last"), "id", "row").alias("place"))
    stays = members.groupBy("component_id").agg(F.min("place").alias("first"))
    gone = members.join(stays, "component_id").where("place.row <> first.row").select("place.row")
    return _without(rows, gone)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = _rows(docs)
    return _without(rows, contaminated_words(_texts(rows), items).where("contaminated").select(F.col("doc_id").alias("row")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return repeated(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; one row per document, read back from them."""
    return token_files(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_token_files),
]

#: Fitted scores, cube sampling and the tokenizer are outside SQL, so no SQL
#: gives run()'s rows; tests/llm hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
