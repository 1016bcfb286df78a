"""The raw event log: a header CSV read with a fixed schema (no inference).

The reference reads one CSV with inferred types, forcing ``event_time`` to
text and ``miles_amount`` to double.  All nine columns are declared here so a
scan never samples the data; text columns stay text, since cleaning decides
what they mean.

Every reader (batch, daily, stream) uses the same options: the header must
name the declared columns in their order (a renamed, moved, missing or added
column fails the read, which is how drift of the raw log shows), a malformed
row fails the read, and a quote inside a quoted field is doubled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_COLUMNS = (
    "event_time", "user_id", "gender", "event_type", "transaction_category",
    "miles_amount", "platform", "utm_source", "country",
)

RAW_SCHEMA = T.StructType([
    T.StructField(name, T.DoubleType() if name == "miles_amount" else T.StringType(), True)
    for name in RAW_COLUMNS
])

DEFAULT_FILE = "event_stream.csv"

# raw text is written verbatim (no blank trimming): the event key hashes it
CSV_WRITE_OPTIONS = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def csv_read_options() -> dict[str, object]:
    """Options shared by every reader of raw CSV."""
    return {"header": True, "mode": "FAILFAST", "enforceSchema": False, "escape": '"'}


def read_raw_csv(spark: SparkSession, path: str, file_name: str | None = DEFAULT_FILE) -> DataFrame:
    """Scan the raw log.  ``path`` is a folder (the reference's data-path
    variable); ``file_name=None`` reads every CSV below it, e.g. daily files
    ``date=YYYY-MM-DD/*.csv`` of a production layout.
    """
    target = path if file_name is None else f"{path.rstrip('/')}/{file_name}"
    reader = spark.read.schema(RAW_SCHEMA).options(**csv_read_options())
    if file_name is None:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    return reader.csv(target).select(*RAW_COLUMNS)


def read_raw_stream(spark: SparkSession, source_dir: str) -> DataFrame:
    """The raw log as a stream of CSV deliveries."""
    return spark.readStream.schema(RAW_SCHEMA).options(**csv_read_options()).csv(source_dir)


def write_raw_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a raw log in the same CSV layout (used to stage deliveries)."""
    df.select(*RAW_COLUMNS).write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path)


# -- daily-partitioned layout (S3): root/date=YYYY-MM-DD/*.csv ---------------

DAILY_SCHEMA = T.StructType(RAW_SCHEMA.fields + [T.StructField("date", T.DateType(), True)])


def read_raw_daily(spark: SparkSession, root: str, date_from: str | None = None,
                   date_to: str | None = None) -> DataFrame:
    """Scan daily raw files; a date range becomes a partition filter, so only
    the folders of those days are listed and read."""
    df = spark.read.schema(DAILY_SCHEMA).options(**csv_read_options()).csv(root)
    if date_from is not None:
        df = df.where(F.col("date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        df = df.where(F.col("date") <= F.lit(date_to).cast("date"))
    return df.select(*RAW_COLUMNS)


def write_raw_daily(df: DataFrame, root: str) -> None:
    """Lay a raw log out as daily folders by the date written in ``event_time``."""
    day = F.substring(F.col("event_time"), 1, 10).cast("date")
    (df.select(*RAW_COLUMNS, day.alias("date")).write.mode("overwrite")
     .options(**CSV_WRITE_OPTIONS).partitionBy("date").csv(root))
