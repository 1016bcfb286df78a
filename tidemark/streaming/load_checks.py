"""D1-D11 kept load by load: the suite's counts without reading old loads again.

Staging and the fact table are the tables that grow with the log.  Their checks
become state that loads add to:

* ``counts``   failing rows of each row predicate (not null, accepted values,
  expression): plain sums;
* ``keys``     the load's event keys with their number of rows, in hash buckets,
  and ``bloom``, a filter of those keys in bitmaps of 32,768 bits;
* ``repeats``  the records that a load adds to keys seen more than once;
* ``orphans``  fact rows whose user was not in the dimension when they came;
  those whose user came later are taken out when the suite is read;
* ``economy``  the load's value flow and category totals: sums.

A key can only be repeated by an event of the same time, for the key hashes the
time's text.  So a load's keys are looked for only in loads whose time range
meets its own (none when loads come in order), there in the filter first, and
exactly only where the filter says they may be, in those keys' buckets.

The other tables are read from what the load-by-load reports keep: dimension,
growth and active days per user from ``GrowthTable``, engagement and retention
from ``ActivityBitmaps``.  The active days are also what the invariants compare
engagement and growth with, so the two sides of D8 come from different state.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import quality
from tidemark.operators.marts import build_fct_events
from tidemark.operators.spine import activity_spine
from tidemark.operators.value_flow import ECONOMY_COLUMNS, value_economy
from tidemark.session import scratch_path
from tidemark.streaming.activity_bitmaps import ActivityBitmaps
from tidemark.streaming.growth_table import USERS_SCHEMA, GrowthTable, LoadFollower
from tidemark.streaming.incremental import IncrementalTable

LOG_TABLES = ("stg_events", "fct_events")
SLOT_BITS = 15  # a bitmap holds 2 ** 15 bits
#: Places of a key in the filter, and bits for each key at least: 0.3 % of other keys pass.
PLACES = 4
BITS_PER_KEY = 16

KINDS = {
    "counts": "check_id int, failing_rows long",
    "keys": "event_id string, n long, bucket int",
    "bloom": "slot long, bits binary",
    "repeats": "event_id string, n_records long",
    "orphans": "user_sk string, n_records long",
    "economy": "month date, event_type string, total_miles double, transactions long, transaction_category string",
}


def filter_bits(keys: int) -> int:
    """Size of a filter: a power of two, one bitmap at least."""
    return max(1 << SLOT_BITS, 1 << max(0, keys * BITS_PER_KEY - 1).bit_length())


def _places(bits: int) -> Column:
    return F.array(*[F.xxhash64("event_id", F.lit(i)).bitwiseAND(F.lit(bits - 1)) for i in range(PLACES)])


def _slot(place: str) -> Column:
    return F.shiftright(place, SLOT_BITS)


def _bit(place: str) -> Column:
    return F.col(place).bitwiseAND(F.lit((1 << SLOT_BITS) - 1))


def bit_is_set(bits: str, place: str) -> Column:
    """Whether a bitmap holds a place of its slot (bit b is bit b % 8 of byte b / 8)."""
    byte = F.conv(F.hex(F.substr(bits, (F.floor(_bit(place) / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    weight = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (F.col(place) % 8 + 1).cast("int"))
    return byte.bitwiseAND(weight) != 0


def bloom_of(keys: DataFrame, bits: int) -> DataFrame:
    """(slot, bits): the filter of the keys."""
    return (keys.select(F.explode(_places(bits)).alias("place")).groupBy(_slot("place").alias("slot"))
            .agg(F.bitmap_construct_agg(_bit("place")).alias("bits")))


def may_hold(keys: DataFrame, bloom: DataFrame, bits: int) -> DataFrame:
    """event_id of the keys all of whose places are set."""
    asked = keys.select("event_id", F.explode(_places(bits)).alias("place"))
    both = asked.withColumn("slot", _slot("place")).join(bloom, "slot")
    return both.where(bit_is_set("bits", "place")).groupBy("event_id").agg(F.count(F.lit(1)).alias("hits")).where(F.col("hits") == PLACES).select("event_id")


def _merged_economy(rows: DataFrame) -> DataFrame:
    return (rows.groupBy("month", "event_type", "transaction_category")
            .agg(F.sum("total_miles").alias("total_miles"), F.sum("transactions").alias("transactions")).select(*ECONOMY_COLUMNS))


class LoadChecks(LoadFollower):
    """The check suite and the value report, maintained by loads of staged events."""

    def __init__(self, spark: SparkSession, path: str, growth: GrowthTable, bitmaps: ActivityBitmaps, buckets: int = 64):
        super().__init__(spark, path, buckets)
        self.growth, self.bitmaps = growth, bitmaps

    def follow(self, staging: IncrementalTable) -> int:
        """Bring the reports that the suite reads up to date, then the suite's own state."""
        self.growth.follow(staging)
        self.bitmaps.follow(staging)
        return super().follow(staging)

    def _state(self, kind: str, entries: list[dict]) -> DataFrame:
        return self._read(kind, T._parse_datatype_string(KINDS[kind]), entries)

    def _own(self, kind: str, folder: str) -> DataFrame:
        path = f"{self.path}/{kind}/{folder}"
        return self.spark.read.schema(KINDS[kind]).option("basePath", path).parquet(path)

    # ------------------------------------------------------------------ loads
    def apply(self, load: DataFrame, load_id: int) -> bool:
        """Add one load; False when it was added before.  Safe to repeat, and to
        run from several writers: keys are looked up anew when another came between."""
        folder = f"load={load_id:05d}-{uuid.uuid4().hex[:8]}"
        spread = None
        tries = 0
        while True:
            entries = self.log.entries()
            if load_id in (e["load_id"] for e in entries):
                self._forget(folder, tries)
                return False
            if spread is None:
                spread = self._write_load(load, folder)
            attempt = f"{folder}.{tries}"
            self._write_repeats(folder, attempt, spread, entries)
            tries += 1
            if self.log.put(len(entries), {"load_id": load_id, "compacts": False, "folder": folder, "repeats": attempt, **spread}):
                self.log.files.delete(f"{self.path}/scratch/{attempt}")
                return True

    def _forget(self, folder: str, tries: int) -> None:
        for kind in KINDS:
            self.log.files.delete(f"{self.path}/{kind}/{folder}")
        for i in range(tries):
            for kind in ("repeats", "scratch"):
                self.log.files.delete(f"{self.path}/{kind}/{folder}.{i}")

    def _write_load(self, load: DataFrame, folder: str) -> dict:
        """What depends on the load alone (and, for orphans, on the dimension as it stands)."""
        fct = build_fct_events(load)
        counts = [quality.row_check_counts(df, [c for c in quality.COLUMN_CHECKS if c.table == name and c.kind in quality.ROW_KINDS])
                  for name, df in zip(LOG_TABLES, (load, fct))]
        counts[0].unionByName(counts[1]).select("check_id", "failing_rows").write.parquet(f"{self.path}/counts/{folder}")
        value_economy(fct).write.parquet(f"{self.path}/economy/{folder}")
        keys = load.where("event_id is not null").groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
        (keys.withColumn("bucket", F.pmod(F.xxhash64("event_id"), F.lit(self.buckets)).cast("int"))
         .repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/keys/{folder}"))
        bits = filter_bits(self._own("keys", folder).count())
        bloom_of(self._own("keys", folder), bits).write.parquet(f"{self.path}/bloom/{folder}")

        users = fct.where("user_sk is not null").groupBy("user_id", "user_sk").agg(F.count(F.lit(1)).alias("n_records"))
        known = self.growth._read("users", USERS_SCHEMA, self.growth.log.entries()).select(F.md5("user_id").alias("user_sk"), "bucket")
        # a user's rows are in the bucket of its id alone, so buckets meet buckets
        users = users.withColumn("bucket", self.growth._bucket())
        users.join(known, ["bucket", "user_sk"], "left_anti").select("user_sk", "n_records").write.parquet(f"{self.path}/orphans/{folder}")
        t = F.unix_micros("event_time")
        return {"bits": bits, **load.agg(F.min(t).alias("min_micros"), F.max(t).alias("max_micros")).first().asDict()}

    def _write_repeats(self, folder: str, attempt: str, spread: dict, entries: list[dict]) -> None:
        mine, met = self._own("keys", folder), self.met_by(spread, entries)
        repeats = mine.where("n > 1").select("event_id", F.col("n").alias("n_records"))
        if met:
            scratch = f"{self.path}/scratch/{attempt}"
            maybe = [may_hold(mine, self._own("bloom", e["folder"]), e["bits"]).withColumn("place", F.lit(i)) for i, e in enumerate(met)]
            quality.union_all(maybe).join(mine.select("event_id", "bucket"), "event_id").write.parquet(scratch)
            maybe = self.spark.read.schema("event_id string, place int, bucket int").parquet(scratch)
            buckets = [r[0] for r in maybe.select("bucket").distinct().collect()]  # at most self.buckets
            held = [self._own("keys", e["folder"]).where(F.col("bucket").isin(buckets)).withColumn("place", F.lit(i)) for i, e in enumerate(met)]
            old = (quality.union_all(held).join(maybe, ["place", "bucket", "event_id"], "left_semi")
                   .groupBy("event_id").agg(F.sum("n").alias("old_n")))
            # a key seen twice or more before is in the repeats with its earlier records
            earlier = F.when(F.col("old_n") >= 2, 0).otherwise(F.coalesce("old_n", F.lit(0)))
            repeats = (mine.join(old, "event_id", "left").where("n > 1 or old_n is not null")
                       .select("event_id", (F.col("n") + earlier).cast("long").alias("n_records")))
        repeats.write.parquet(f"{self.path}/repeats/{attempt}")

    def met_by(self, spread: dict, entries: list[dict]) -> list[dict]:
        """Entries whose loads hold events of the time range."""
        if spread["min_micros"] is None:
            return []
        return [e for e in self._live(entries) if e["min_micros"] is not None
                and e["min_micros"] <= spread["max_micros"] and e["max_micros"] >= spread["min_micros"]]

    def compact(self) -> bool:
        """Put all folders so far into one; False when another writer came between or there is nothing to gain."""
        entries = self.log.entries()
        live = self._live(entries)
        if len(live) < 2:
            return False
        folder = f"upto={len(entries) - 1:05d}-{uuid.uuid4().hex[:8]}"

        def put(kind: str, rows: DataFrame) -> None:
            rows.write.parquet(f"{self.path}/{kind}/{folder}")

        def summed(kind: str, key: str, value: str) -> DataFrame:
            return self._state(kind, entries).groupBy(key).agg(F.sum(value).alias(value))

        put("counts", summed("counts", "check_id", "failing_rows"))
        put("repeats", summed("repeats", "event_id", "n_records"))
        put("orphans", summed("orphans", "user_sk", "n_records"))
        put("economy", _merged_economy(self._state("economy", entries)))
        (self._state("keys", entries).groupBy("bucket", "event_id").agg(F.sum("n").alias("n"))
         .repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/keys/{folder}"))
        bits = filter_bits(self._own("keys", folder).count())
        put("bloom", bloom_of(self._own("keys", folder), bits))
        times = [(e["min_micros"], e["max_micros"]) for e in live if e["min_micros"] is not None]
        if self.log.put(len(entries), {"load_id": None, "compacts": True, "folder": folder, "bits": bits,
                                       "min_micros": min((a for a, _ in times), default=None),
                                       "max_micros": max((b for _, b in times), default=None)}):
            return True
        self._forget(folder, 0)
        return False

    # ------------------------------------------------------------------ reads
    def value_economy(self) -> DataFrame:
        """P13, from the loads' sums."""
        return _merged_economy(self._state("economy", self.log.entries()))

    def repeated_keys(self) -> DataFrame:
        """(value, n_records): event keys seen more than once."""
        return (self._state("repeats", self.log.entries()).groupBy(F.col("event_id").alias("value"))
                .agg(F.sum("n_records").alias("n_records")))

    def orphan_keys(self) -> DataFrame:
        """(value, n_records): users of fact rows that the dimension lacks."""
        rows = self._state("orphans", self.log.entries()).groupBy("user_sk").agg(F.sum("n_records").alias("n_records"))
        return (rows.join(self.growth.dim_users().select("user_sk"), "user_sk", "left_anti")
                .select(F.col("user_sk").alias("value"), "n_records"))

    def active_days(self) -> DataFrame:
        """(user_id, event_date): each day on which a user was active, once."""
        users = self.growth._read("users", USERS_SCHEMA, self.growth.log.entries())
        return users.select("user_id", F.explode("dates").alias("event_date")).distinct()

    def run_checks(self) -> DataFrame:
        """One row per check (90), as ``quality.run_checks`` gives over all tables."""
        if not set(self.applied()) == set(self.growth.applied()) == set(self.bitmaps.applied()):
            raise ValueError("the reports do not hold the same loads: call follow() first")
        days = self.active_days()
        tables = {
            "dim_users": self.growth.dim_users(), "fct_events": days, "int_user_activity_periods": activity_spine(days),
            "rpt_growth_accounting": self.growth.growth_accounting(), "rpt_net_growth": self.growth.net_growth(),
            "rpt_cohort_retention": self.bitmaps.cohort_retention(), "rpt_engagement": self.bitmaps.engagement(),
            "rpt_miles_economy": self.value_economy(),
        }
        # many checks read each of them: merged from the loads once, not once per check
        root = scratch_path(self.spark, "load-checks")
        for name, df in tables.items():
            df.write.parquet(f"{root}/{name}")
            tables[name] = self.spark.read.schema(df.schema).parquet(f"{root}/{name}")
        own = [c for c in quality.COLUMN_CHECKS if c.table in LOG_TABLES and c.kind in quality.ROW_KINDS]
        sums = self._state("counts", self.log.entries()).agg(*[
            F.coalesce(F.sum(F.when(F.col("check_id") == c.check_id, F.col("failing_rows"))), F.lit(0)).alias(f"c{c.check_id}") for c in own])
        parts = [quality.named_counts(sums, own)]
        for name, df in tables.items():
            checks = [c for c in quality.COLUMN_CHECKS if c.table == name and c.kind in quality.ROW_KINDS]
            if name not in LOG_TABLES:
                parts.append(quality.row_check_counts(df, checks))
        for c in quality.COLUMN_CHECKS:
            if c.kind == "unique":
                rows = self.repeated_keys() if c.table in LOG_TABLES else quality.duplicate_values(tables[c.table], c)
                parts.append(quality.count_rows(rows, c))
            elif c.kind == "relationships":
                parts.append(quality.count_rows(self.orphan_keys(), c, "n_records"))
        for c in quality.SINGULAR_CHECKS:
            parts.append(quality.count_rows(quality.singular_failures(c.check_name, tables), c))
        return quality.union_all(parts)
