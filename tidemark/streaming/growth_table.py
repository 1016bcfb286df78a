"""P3, P6-P8 kept up to date load by load, without reading old events again.

Growth labels need, of all that a user did before a load, only the user's first
event and last active day: a label is fixed by the active period before it, and
the one label that a later period can take back is the churn after the last one.
So a load changes the report by small signed counts, and the report is the sum
of the changes.

Layout below ``path``::

    users/<attempt>/bucket=17/     the load's users: first event, last time, last day, active days
    changes/<attempt>/period_grain=month/   (period_start, cohort_type, dimensions, change)
    _log/                          which folders count (``commits.py``)

One load costs one aggregate of its own events by user, a join of its users
with their earlier rows, and a small aggregate of changes:

* earlier rows are looked for in the load's own buckets only, and only their
  first event and last day are read;
* folders written before are never changed: closed periods stay as they are.

Late rows (a replay of what the high-water mark refused, or a date in the text
that lies before an earlier one) can go before a user's last day, or even before
the first event.  Then, and only for the users concerned, all active days are
read, and the labels they had are taken back and given anew.  Whether a load can
hold such rows is known from the times in the log.

``compact`` puts all folders so far into one; the log entry that names it takes
the place of those before in one step.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.periods import DEFAULT_GRAINS, GRAINS, Grain
from tidemark.operators.growth import GA_KEYS, net_growth
from tidemark.operators.marts import FIRST_EVENT_ORDER, dim_from_state, merge_first_and_last
from tidemark.operators.staging import STG_SCHEMA
from tidemark.streaming.commits import CommitLog
from tidemark.streaming.incremental import IncrementalTable

_FIRST = T.StructType([STG_SCHEMA[c] for c in FIRST_EVENT_ORDER])
USERS_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("first", _FIRST), T.StructField("last_seen_at", T.TimestampType()),
    T.StructField("last_date", T.DateType()), T.StructField("dates", T.ArrayType(T.DateType())), T.StructField("bucket", T.IntegerType())])
CHANGES_SCHEMA = T.StructType([
    *(T.StructField(c, T.DateType() if c == "period_start" else T.StringType()) for c in GA_KEYS if c != "period_grain"),
    T.StructField("change", T.LongType()), T.StructField("period_grain", T.StringType())])


def labels(grain: Grain, periods: Column, last: Column | None, sign: int = 1) -> Column:
    """Signed labels of sorted new periods after a last active one (None, or null: none before).

    Each period is new, retained or resurrected by the one before it; each
    that is not followed at once gives a churn in the next; and the churn after
    ``last`` is taken back where the first new period is the one that it missed.
    """
    before = F.lit(None).cast("date") if last is None else last

    def row(start: Column, label: Column, change: int) -> Column:
        return F.struct(start.alias("period_start"), label.alias("cohort_type"), F.lit(change).cast("long").alias("change"))

    def own(p: Column, i: Column) -> Column:
        prior = F.when(i == 0, before).otherwise(F.get(periods, i - 1))
        label = F.when(prior.isNull(), "new").when(prior == grain.shift(p, -1), "retained").otherwise("resurrected")
        following = F.get(periods, i + 1)
        churns = following.isNull() | (following != grain.shift(p, 1))
        return F.array(row(p, label, sign), F.when(churns, row(grain.shift(p, 1), F.lit("churned"), sign)))

    rows = F.flatten(F.transform(periods, own))
    if last is not None:
        missed = grain.shift(last, 1)
        rows = F.concat(rows, F.array(F.when(F.get(periods, F.lit(0)) == missed, row(missed, F.lit("churned"), -sign))))
    return F.array_compact(rows)


def _periods(grain: Grain, dates: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(dates, grain.start)))


def _dims(first: str) -> list[Column]:
    return [F.col(f"{first}.country").alias("country"), F.col(f"{first}.utm_source").alias("acquisition_source"),
            F.col(f"{first}.platform").alias("first_platform")]


def _all_grains(per_grain) -> Column:
    """One array of labelled rows of all grains."""
    def of(name: str) -> Column:
        return F.transform(per_grain(GRAINS[name]), lambda x: F.struct(
            F.lit(name).alias("period_grain"), x["period_start"].alias("period_start"), x["cohort_type"].alias("cohort_type"),
            x["change"].alias("change")))

    return F.concat(*[of(name) for name in DEFAULT_GRAINS])


class LoadFollower:
    """What reports kept up to date load by load have in common: a log of loads
    and compactions, and the folders that count."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        """buckets: folders that a load's users are dealt to by a hash; a later
        load opens those of its own users.  Fixed for the life of a table."""
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.path}/_log")

    def _live(self, entries: list[dict]) -> list[dict]:
        """Entries whose folders count: the last compaction and the loads after it."""
        start = max((i for i, e in enumerate(entries) if e["compacts"]), default=0)
        return entries[start:]

    def _read(self, kind: str, schema: T.StructType, entries: list[dict]) -> DataFrame:
        """The rows of one kind of all folders that count; an entry may name a kind's folder apart."""
        folders = [f"{self.path}/{kind}/{e.get(kind, e['folder'])}" for e in self._live(entries)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        one = [self.spark.read.schema(schema).option("basePath", f).parquet(f) for f in folders]
        df = one[0]
        for more in one[1:]:
            df = df.unionByName(more)
        return df

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("user_id"), F.lit(self.buckets)).cast("int")

    def applied(self) -> list[int]:
        """Ids of the loads in the report."""
        return [e["load_id"] for e in self.log.entries() if e["load_id"] is not None]

    def follow(self, staging: IncrementalTable) -> int:
        """Apply every committed load of a staging table that is not in the report yet."""
        done = set(self.applied())
        todo = [x.load_id for x in staging.loads() if x.load_id not in done and x.rows > 0]
        return sum(self.apply(staging.read_load(i), i) for i in todo)

    def apply(self, load: DataFrame, load_id: int) -> bool:
        raise NotImplementedError


class GrowthTable(LoadFollower):
    """The user dimension and the growth report, maintained by loads of staged events."""

    # ------------------------------------------------------------------ reads
    def dim_users(self) -> DataFrame:
        users = self._read("users", USERS_SCHEMA, self.log.entries()).select("user_id", "first", "last_seen_at")
        return dim_from_state(merge_first_and_last(users))

    def growth_accounting(self) -> DataFrame:
        changes = self._read("changes", CHANGES_SCHEMA, self.log.entries())
        return (changes.groupBy(*GA_KEYS).agg(F.sum("change").alias("user_count")).where("user_count <> 0"))

    def net_growth(self) -> DataFrame:
        return net_growth(self.growth_accounting())

    # ------------------------------------------------------------------ loads
    def apply(self, load: DataFrame, load_id: int) -> bool:
        """Add one load of staged events; False when it was added before.
        Safe to repeat, and to run from several writers: a writer that finds
        another's entry in its place works out its changes anew."""
        folder = f"load={load_id:05d}-{uuid.uuid4().hex[:8]}"
        users, spread = f"{self.path}/users/{folder}", None
        tries = 0
        while True:
            entries = self.log.entries()
            if load_id in (e["load_id"] for e in entries):
                self._forget(folder, tries)
                return False
            if spread is None:
                spread = self._write_users(load, users)
            attempt = f"{folder}.{tries}"
            self._changes(users, spread, entries).write.partitionBy("period_grain").parquet(f"{self.path}/changes/{attempt}")
            tries += 1
            entry = {"load_id": load_id, "compacts": False, "folder": folder, "changes": attempt,
                     "max_micros": spread["max_micros"], "max_date": str(spread["max_date"]) if spread["max_date"] else None}
            if self.log.put(len(entries), entry):
                return True

    def _forget(self, folder: str, tries: int) -> None:
        self.log.files.delete(f"{self.path}/users/{folder}")
        for i in range(tries):
            self.log.files.delete(f"{self.path}/changes/{folder}.{i}")

    def _write_users(self, load: DataFrame, path: str) -> dict:
        days = load.groupBy("user_id").agg(
            F.min(F.struct(*FIRST_EVENT_ORDER)).alias("first"), F.max("event_time").alias("last_seen_at"),
            F.max("event_date").alias("last_date"), F.collect_set("event_date").alias("dates"))
        days.withColumn("bucket", self._bucket()).repartition("bucket").write.partitionBy("bucket").parquet(path)
        written = self.spark.read.schema(USERS_SCHEMA).parquet(path)
        return written.agg(
            F.min(F.unix_micros("first.event_time")).alias("min_micros"), F.max(F.unix_micros("last_seen_at")).alias("max_micros"),
            F.min(F.array_min("dates")).alias("min_date"), F.max("last_date").alias("max_date"),
            F.sort_array(F.collect_set("bucket")).alias("buckets")).first().asDict()

    def _changes(self, users: str, spread: dict, entries: list[dict]) -> DataFrame:
        """Signed counts that a load's users bring, given the loads before."""
        new = self.spark.read.schema(USERS_SCHEMA).parquet(users)
        old = self._read("users", USERS_SCHEMA, entries).where(F.col("bucket").isin(spread["buckets"]))
        marks = [(e["max_micros"], e["max_date"]) for e in entries if e["max_micros"] is not None]
        in_order = spread["min_micros"] is None or not marks or (
            spread["min_micros"] > max(m for m, _ in marks) and str(spread["min_date"]) >= max(d for _, d in marks))
        # in order, merged by user as the rest is: a load's users would else go to the driver
        # load by load.  Late rows read the earlier ones several times; there Spark chooses.
        users_of = new.select("user_id").hint("merge") if in_order else new.select("user_id")
        known = (old.join(users_of, "user_id", "left_semi").groupBy("user_id")
                 .agg(F.min("first").alias("old_first"), F.max("last_date").alias("old_last")))
        both = new.join(known, "user_id", "left")
        moves = (F.col("first") < F.col("old_first")) | (F.array_min("dates") < F.col("old_last"))
        goes_on = both if in_order else both.where(F.col("old_first").isNull() | ~moves)

        def after(grain: Grain) -> Column:
            last = grain.start(F.col("old_last"))
            return labels(grain, F.filter(_periods(grain, F.col("dates")), lambda p: last.isNull() | (p > last)), last)

        rows = goes_on.select(F.coalesce("old_first", "first").alias("f"), F.inline(_all_grains(after)))
        if not in_order:
            days = (old.join(both.where(moves).select("user_id"), "user_id", "left_semi")
                    .groupBy("user_id").agg(F.array_distinct(F.flatten(F.collect_list("dates"))).alias("old_dates")))
            again = both.where(moves).join(days, "user_id")
            had = again.select(F.col("old_first").alias("f"), F.inline(
                _all_grains(lambda g: labels(g, _periods(g, F.col("old_dates")), None, -1))))
            has = again.select(F.least("old_first", "first").alias("f"), F.inline(
                _all_grains(lambda g: labels(g, _periods(g, F.array_union("old_dates", "dates")), None))))
            rows = rows.unionByName(had).unionByName(has)
        return (rows.select("period_grain", "period_start", "cohort_type", *_dims("f"), "change")
                .groupBy(*GA_KEYS).agg(F.sum("change").alias("change")).where("change <> 0"))

    def compact(self) -> bool:
        """Put all folders so far into one; False when another writer came between or there is nothing to gain."""
        entries = self.log.entries()
        live = self._live(entries)
        if len(live) < 2:
            return False
        folder = f"upto={len(entries) - 1:05d}-{uuid.uuid4().hex[:8]}"
        users = self._read("users", USERS_SCHEMA, entries).groupBy("bucket", "user_id").agg(
            F.min("first").alias("first"), F.max("last_seen_at").alias("last_seen_at"), F.max("last_date").alias("last_date"),
            F.array_distinct(F.flatten(F.collect_list("dates"))).alias("dates"))
        users.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/users/{folder}")
        changes = self._read("changes", CHANGES_SCHEMA, entries).groupBy(*GA_KEYS).agg(F.sum("change").alias("change"))
        changes.where("change <> 0").write.partitionBy("period_grain").parquet(f"{self.path}/changes/{folder}")
        entry = {"load_id": None, "compacts": True, "folder": folder, "changes": folder,
                 "max_micros": max((e["max_micros"] for e in live if e["max_micros"] is not None), default=None),
                 "max_date": max((e["max_date"] for e in live if e["max_date"] is not None), default=None)}
        if self.log.put(len(entries), entry):
            return True
        self.log.files.delete(f"{self.path}/users/{folder}")
        self.log.files.delete(f"{self.path}/changes/{folder}")
        return False
