"""A file index for point queries on staged events (S3, S8).

For every data file and indexed column the index keeps the least and greatest
value and a Bloom filter in bitmaps of 32,768 bits.  A point query opens only
the files whose range and filter let one of its values through; loads that are
not indexed yet are read whole, so the answer never depends on the index.

The index follows the loads of a staging table: one load costs a scan of its own
indexed columns.  Filters are as large as the files' rows ask for, so a file's
share of the index does not depend on the table's size.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.streaming.growth_table import LoadFollower
from tidemark.streaming.incremental import IncrementalTable
from tidemark.streaming.load_checks import BITS_PER_KEY, PLACES, SLOT_BITS, bit_is_set

INDEXED = ("user_id", "event_id")
FILES = "file string, column string, low string, high string, filter_bits long"
FILTERS = "file string, column string, slot long, bits binary"


def _places(value: str) -> Column:
    """A value's places in a filter of ``filter_bits`` bits, each once."""
    return F.array_distinct(F.array(*[F.xxhash64(value, F.lit(i)).bitwiseAND(F.col("filter_bits") - 1) for i in range(PLACES)]))


class FileIndex(LoadFollower):
    """Which files of a staging table may hold a value."""

    def __init__(self, spark: SparkSession, path: str, staging: IncrementalTable, columns: Sequence[str] = INDEXED):
        super().__init__(spark, path)
        self.staging, self.columns = staging, tuple(columns)

    def _file(self) -> Column:
        """A file's path below the table's data folder: the table may move."""
        return F.substring_index("_metadata.file_path", "/data/", -1)

    def apply(self, load: DataFrame, load_id: int) -> bool:
        """Index the files of one load; False when they were indexed before."""
        folder = f"load={load_id:05d}-{uuid.uuid4().hex[:8]}"
        if load_id in self.applied():
            return False
        at = f"{self.staging.data_root}/{self.staging.loads()[load_id].folder}"
        stored = self.spark.read.schema(self.staging.schema).parquet(at)
        pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in self.columns]))
        values = stored.select(self._file().alias("file"), pairs).where("value is not null")
        size = F.pow(F.lit(2.0), F.greatest(F.lit(float(SLOT_BITS)), F.ceil(F.log2(F.col("n") * BITS_PER_KEY)).cast("double"))).cast("long")
        ranges = (values.groupBy("file", "column").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count("value").alias("n"))
                  .select("file", "column", "low", "high", size.alias("filter_bits")))
        ranges.write.parquet(f"{self.path}/files/{folder}")
        sizes = self.spark.read.schema(FILES).parquet(f"{self.path}/files/{folder}").select("file", "column", "filter_bits")
        places = values.distinct().join(sizes, ["file", "column"]).select("file", "column", F.explode(_places("value")).alias("place"))
        (places.groupBy("file", "column", F.shiftright("place", SLOT_BITS).alias("slot"))
         .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit((1 << SLOT_BITS) - 1))).alias("bits"))
         .write.parquet(f"{self.path}/filters/{folder}"))
        while True:
            entries = self.log.entries()
            if load_id in (e["load_id"] for e in entries):
                for kind in ("files", "filters"):
                    self.log.files.delete(f"{self.path}/{kind}/{folder}")
                return False
            if self.log.put(len(entries), {"load_id": load_id, "compacts": False, "folder": folder}):
                return True

    def files_with(self, column: str, values: Sequence[str]) -> list[str]:
        """Indexed files, below the table's data folder, that may hold one of the values."""
        folders = [e["folder"] for e in self.log.entries()]
        if column not in self.columns:
            raise ValueError(f"{column} is not indexed")
        if not folders or not values:
            return []
        files = self.spark.read.schema(FILES).parquet(*[f"{self.path}/files/{f}" for f in folders])
        filters = self.spark.read.schema(FILTERS).parquet(*[f"{self.path}/filters/{f}" for f in folders])
        wanted = files.where(F.col("column") == column).select(
            "file", "filter_bits", "low", "high", F.explode(F.array(*[F.lit(v) for v in values])).alias("value"))
        wanted = wanted.where("value between low and high").withColumn("places", _places("value"))
        asked = wanted.select("file", "value", F.size("places").alias("asked"), F.explode("places").alias("place"))
        slots = filters.where(F.col("column") == column).select("file", "slot", "bits")
        held = asked.withColumn("slot", F.shiftright("place", SLOT_BITS)).join(slots, ["file", "slot"]).where(bit_is_set("bits", "place"))
        full = held.groupBy("file", "value", "asked").agg(F.count(F.lit(1)).alias("hits")).where("hits = asked")
        return sorted(r["file"] for r in full.select("file").distinct().collect())  # names of the files to open

    def read_where(self, column: str, values: Sequence[str]) -> DataFrame:
        """The committed rows that hold one of the values, from the files that may hold them."""
        done = set(self.applied())
        rest = [x.folder for x in self.staging.loads() if x.rows > 0 and x.load_id not in done]
        paths = [f"{self.staging.data_root}/{p}" for p in [*self.files_with(column, values), *rest]]
        if not paths:
            return self.spark.createDataFrame([], self.staging.schema)
        rows = self.spark.read.schema(self.staging.schema).option("basePath", self.staging.data_root).parquet(*paths)
        return rows.where(F.col(column).isin(*values)).select(*self.staging.schema.fieldNames())
