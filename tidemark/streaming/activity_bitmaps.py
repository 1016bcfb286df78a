"""P9, P10, A6 from bitmaps: distinct counts that loads add to without a recount.

Every user gets a number when first seen.  Numbers are dense (the rank within a
hash bucket, interleaved), so a set of users is a few bitmaps of 32,768 bits,
and sets of different loads merge by OR.  Per load the table keeps

* ``numbers``  user, number and cohort month of the load's new users (and of
  users whose first event turned out to be in an earlier month), by bucket;
* ``active``   per month, event type and slot of numbers: the bitmap of the
  load's active users, and its events;
* ``cohorts``  per cohort month and slot: bitmaps of users that joined, and of
  users that left for an earlier month (late rows).

Active users of a month and type are the bits of the ORed bitmaps; of a month
over all types, of the OR of its types.  Retained users are the bits of cohort
AND month, less those that left the cohort; a user leaves a cohort once and
never comes back, so the difference of two counts is exact.

One load reads its own rows and the numbers of its own buckets.  Users arrive in
order, so a cohort is found in few slots, and the join of cohorts with months
by slot makes few pairs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import month_start, months_apart, round_half_away
from tidemark.operators.engagement import SUMMARY_LABEL
from tidemark.streaming.growth_table import LoadFollower


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


NUMBERS = _schema(("user_id", T.StringType()), ("n", T.LongType()), ("cohort_month", T.DateType()), ("first_seen_at", T.TimestampType()),
                  ("bucket", T.IntegerType()))
ACTIVE = _schema(("month", T.DateType()), ("event_type", T.StringType()), ("slot", T.LongType()), ("bits", T.BinaryType()),
                 ("events", T.LongType()))
COHORTS = _schema(("cohort_month", T.DateType()), ("joined", T.BooleanType()), ("slot", T.LongType()), ("bits", T.BinaryType()))


class ActivityBitmaps(LoadFollower):
    """Engagement and cohort retention, maintained by loads of staged events."""

    # ------------------------------------------------------------------ loads
    def apply(self, load: DataFrame, load_id: int) -> bool:
        """Add one load; False when it was added before.  Safe to repeat, and to
        run from several writers: numbers are given anew when another came between."""
        base = f"load={load_id:05d}-{uuid.uuid4().hex[:8]}"
        per_user = f"{self.path}/scratch/{base}"
        tries = 0
        while True:
            entries = self.log.entries()
            if load_id in (e["load_id"] for e in entries):
                self._forget(base, tries)
                return False
            if not tries:
                (load.groupBy("user_id", month_start("event_date").alias("month"), "event_type")
                 .agg(F.count(F.lit(1)).alias("events"), F.min("event_time").alias("first")).write.parquet(per_user))
            folder = f"{base}.{tries}"
            self._write(self.spark.read.parquet(per_user), folder, entries)
            tries += 1
            if self.log.put(len(entries), {"load_id": load_id, "compacts": False, "folder": folder}):
                self.log.files.delete(per_user)
                return True

    def _forget(self, base: str, tries: int) -> None:
        self.log.files.delete(f"{self.path}/scratch/{base}")
        for i in range(tries):
            for kind in ("numbers", "active", "cohorts"):
                self.log.files.delete(f"{self.path}/{kind}/{base}.{i}")

    def _write(self, per_user: DataFrame, folder: str, entries: list[dict]) -> None:
        at = {kind: f"{self.path}/{kind}/{folder}" for kind in ("numbers", "active", "cohorts")}
        users = per_user.groupBy("user_id").agg(F.min("first").alias("first")).withColumn("bucket", self._bucket())
        buckets = sorted(r[0] for r in users.select("bucket").distinct().collect())  # at most self.buckets
        old = self._read("numbers", NUMBERS, entries).where(F.col("bucket").isin(buckets))
        known = (old.join(users.select("user_id"), "user_id", "left_semi").groupBy("user_id")
                 .agg(F.min("n").alias("old_n"), F.min("first_seen_at").alias("old_first")))
        given = old.groupBy("bucket").agg((F.max("n") + self.buckets).alias("next"))
        both = users.join(known, "user_id", "left").join(F.broadcast(given), "bucket", "left")  # one row per bucket
        rank = F.row_number().over(Window.partitionBy("bucket", F.col("old_n").isNull()).orderBy("user_id")) - 1
        n = F.coalesce("old_n", F.coalesce("next", F.col("bucket").cast("long")) + rank * self.buckets)
        numbered = both.withColumn("n", n).where(F.col("old_first").isNull() | (F.col("first") < F.col("old_first")))
        (numbered.select("user_id", "n", month_start("first").alias("cohort_month"), F.col("first").alias("first_seen_at"), "bucket")
         .repartition("bucket").write.partitionBy("bucket").parquet(at["numbers"]))

        new = self.spark.read.schema(NUMBERS).parquet(at["numbers"]).select("user_id", "n", "cohort_month", "first_seen_at")
        before = old.join(new.select("user_id"), "user_id", "left_semi").groupBy("user_id").agg(
            F.min("n").alias("n"), F.min_by("cohort_month", "first_seen_at").alias("was"))
        moved = new.join(before.select("user_id", "was"), "user_id", "left")
        joins = moved.where(F.col("was").isNull() | (F.col("was") != F.col("cohort_month"))).select(
            "n", F.inline(F.array_compact(F.array(
                F.struct(F.col("cohort_month").alias("month"), F.lit(True).alias("joined")),
                F.when(F.col("was").isNotNull(), F.struct(F.col("was").alias("month"), F.lit(False).alias("joined")))))))
        (joins.groupBy(F.col("month").alias("cohort_month"), "joined", F.bitmap_bucket_number("n").alias("slot"))
         .agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits")).write.parquet(at["cohorts"]))

        every = old.select("user_id", "n").unionByName(new.select("user_id", "n")).groupBy("user_id").agg(F.min("n").alias("n"))
        (per_user.join(every, "user_id").groupBy("month", "event_type", F.bitmap_bucket_number("n").alias("slot"))
         .agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits"), F.sum("events").alias("events")).write.parquet(at["active"]))

    def compact(self) -> bool:
        """Put all folders so far into one; False when another writer came between or there is nothing to gain."""
        entries = self.log.entries()
        if len(self._live(entries)) < 2:
            return False
        folder = f"upto={len(entries) - 1:05d}-{uuid.uuid4().hex[:8]}"
        numbers = self._read("numbers", NUMBERS, entries).groupBy("bucket", "user_id").agg(
            F.min("n").alias("n"), F.min_by("cohort_month", "first_seen_at").alias("cohort_month"), F.min("first_seen_at").alias("first_seen_at"))
        numbers.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/numbers/{folder}")
        self._active(entries).write.parquet(f"{self.path}/active/{folder}")
        self._cohorts(entries).write.parquet(f"{self.path}/cohorts/{folder}")
        if self.log.put(len(entries), {"load_id": None, "compacts": True, "folder": folder}):
            return True
        for kind in ("numbers", "active", "cohorts"):
            self.log.files.delete(f"{self.path}/{kind}/{folder}")
        return False

    # ------------------------------------------------------------------ reads
    def _active(self, entries: list[dict]) -> DataFrame:
        return self._read("active", ACTIVE, entries).groupBy("month", "event_type", "slot").agg(
            F.bitmap_or_agg("bits").alias("bits"), F.sum("events").alias("events"))

    def _cohorts(self, entries: list[dict]) -> DataFrame:
        return self._read("cohorts", COHORTS, entries).groupBy("cohort_month", "joined", "slot").agg(F.bitmap_or_agg("bits").alias("bits"))

    def engagement(self) -> DataFrame:
        """P10, from bitmaps."""
        active = self._active(self.log.entries())
        per_type = active.groupBy("month", "event_type").agg(
            F.sum("events").alias("total_events"), F.sum(F.bitmap_count("bits")).alias("active_users"))
        overall = (active.groupBy("month", "slot").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("events").alias("events"))
                   .groupBy("month").agg(F.sum("events").alias("total_events"), F.sum(F.bitmap_count("bits")).alias("active_users")))
        rows = per_type.unionByName(overall.withColumn("event_type", F.lit(SUMMARY_LABEL)))
        per_active = F.col("total_events").cast("double") / F.col("active_users").cast("double")
        return rows.select("month", "event_type", "total_events", "active_users", round_half_away(per_active, 2).alias("events_per_user"))

    def cohort_retention(self) -> DataFrame:
        """P9, from bitmaps."""
        entries = self.log.entries()
        cohorts = self._cohorts(entries)
        months = self._active(entries).groupBy("month", "slot").agg(F.bitmap_or_agg("bits").alias("month_bits"))
        signed = F.when(F.col("joined"), F.lit(1)).otherwise(F.lit(-1))
        sizes = cohorts.groupBy("cohort_month").agg(F.sum(F.bitmap_count("bits") * signed).alias("cohort_size"))
        both = cohorts.join(months, "slot").select(
            "cohort_month", "joined", "slot", "month", F.explode(F.array("bits", "month_bits")).alias("bits"))
        shared = both.groupBy("cohort_month", "joined", "month", "slot").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("users"))
        kept = (shared.groupBy("cohort_month", "month").agg(F.sum(F.col("users") * signed).alias("retained_users"))
                .where("retained_users > 0").join(sizes, "cohort_month"))
        ratio = F.col("retained_users") * F.lit(100.0) / F.col("cohort_size")
        return kept.select("cohort_month", months_apart("month", "cohort_month").alias("months_since_first"),
                           "retained_users", "cohort_size", round_half_away(ratio, 1).alias("retention_pct"))
