"""Mixing sources to target weights by the cube method.

Every source gets a target number of words.  Its documents are all taken the
whole number of times that the ratio of target to size allows; which documents
are taken once more is a balanced sample with inclusion probability equal to
the ratio's fraction.  The flight phase moves the probabilities of three
undecided documents at a time along the null space of two constraints, their
number and their words, until one of them is 0 or 1; both totals stay what
they were.  It needs three documents in memory, so it streams through blocks
of a source of any size.  Each block leaves at most two undecided documents;
those meet in ever fewer blocks until one per source is left, where the last
two are landed by the choice nearest to their expected words.

A block is walked from long to short documents, so those left over are short.
Blocks and order follow from hashes of the documents' own values, so a rerun
takes the same documents whatever the partitions.

Defined results: a null text has size 0; a document of size 0 is carried along
with taken 0.  Repeated rows are separate documents.  A null source is a
source of its own, last in order.  Extra columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import flat
from tidemark.llm.store import stored

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_ROWS = 4096
FAN_IN = 64
_TINY = 1e-9

_ROW = "block long, doc_id long, source string, size long, source_size long, target double, whole int, phi double"
_NAMES = [x.split()[0] for x in _ROW.split(", ")]
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, n_docs, source_size, target) by water filling: targets are in
    proportion to the weights until they meet MOST_REPEATS times the size."""
    per = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    per = (per.withColumn("weight", F.element_at(weights, (F.row_number().over(order) - 1) % len(WEIGHTS) + 1))
           .withColumn("cap", F.col("source_size").cast("double") * MOST_REPEATS)
           .withColumn("total", F.sum("source_size").over(Window.partitionBy()).cast("double"))
           .withColumn("weights", F.sum("weight").over(Window.partitionBy())))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    full = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.col("total") - F.coalesce(F.sum("cap").over(full), F.lit(0.0)))
             / (F.col("weights") - F.coalesce(F.sum("weight").over(full), F.lit(0.0))))
    per = per.withColumn("level", level).withColumn("at", F.row_number().over(by_ratio))
    open_at = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("at"))
    per = per.withColumn("chosen", F.min_by("level", open_at).over(Window.partitionBy()))
    target = F.least(F.col("cap"), F.coalesce(F.col("chosen") * F.col("weight"), F.lit(0.0)))
    return per.select("source", "n_docs", "source_size", target.alias("target"))


def _direction(units: list[list]) -> list[float]:
    """A vector along which neither the number nor the words change."""
    a, b, c = (u[1] for u in units)
    u = [c - b, a - c, b - a]
    most = max(map(abs, u))
    return [x / most for x in u] if most else [1.0, -1.0, 0.0]


def _step(units: list[list], rng: random.Random) -> None:
    """Move three units' probabilities until one is 0 or 1; totals are kept in mean and exactly."""
    u = _direction(units)
    ahead = min((1 - p) / x if x > 0 else p / -x for (p, *_), x in zip(units, u) if x)
    back = min(p / x if x > 0 else (1 - p) / -x for (p, *_), x in zip(units, u) if x)
    move = ahead if rng.random() * (ahead + back) < back else -back
    for unit, x in zip(units, u):
        p = unit[0] + move * x
        unit[0] = 0.0 if p < _TINY else 1.0 if p > 1 - _TINY else p


def _land(units: list[list]) -> None:
    """Decide what is left (two at most) as near to the expected words as can be."""
    want = sum(p * size for p, size, _ in units)
    chance = sum(p for p, *_ in units)
    choices = [[(m >> i) & 1 for i in range(len(units))] for m in range(1 << len(units))]
    best = min(choices, key=lambda c: (abs(sum(x * u[1] for x, u in zip(c, units)) - want), abs(sum(c) - chance)))
    for unit, x in zip(units, best):
        unit[0] = float(x)


def _flight(last: bool):
    """Stream rows sorted by source and block; phi becomes 0 or 1 for all but
    two rows of a block, and for these too when it is the source's last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, rng, out = None, [], random.Random(0), []

        def settle() -> None:
            nonlocal held
            out.extend((u[2], u[0]) for u in held if u[0] in (0.0, 1.0))
            held = [u for u in held if u[0] not in (0.0, 1.0)]

        def close() -> None:
            if last:
                _land(held)
            out.extend((u[2], u[0]) for u in held)
            held.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                key = row[2], row[0]
                if key != at:
                    close()
                    at, rng = key, random.Random(f"{row[2]}|{row[0]}|{row[3]}|{row[1]}")
                if row[7] in (0.0, 1.0):
                    out.append((row, row[7]))
                    continue
                held.append([row[7], float(row[3]), row])
                while len(held) == 3:
                    _step(held, rng)
                    settle()
            if out:
                yield _rows(out)
                out.clear()
        close()
        if out:
            yield _rows(out)

    return run


def _rows(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*(row[:7] + (phi,) for row, phi in out)))
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=_NAMES)


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row of docs."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sizes = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                               F.col("source").cast("string").alias("source"),
                               size.alias("size")), "sizes")
    targets = stored(source_targets(sizes), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / BLOCK_ROWS)).cast("long")
    own = F.xxhash64("doc_id", "size", "source")
    named = targets.withColumnRenamed("source", "of")
    rows = (sizes.join(F.broadcast(named) if targets.count() <= 10_000 else named, sizes["source"].eqNullSafe(named["of"]))
            .withColumn("whole", F.floor(ratio).cast("int")).withColumn("phi", ratio - F.floor(ratio))
            .withColumn("phi", F.when(F.col("phi") < _TINY, 0.0).when(F.col("phi") > 1 - _TINY, 1.0).otherwise(F.col("phi")))
            .withColumn("block", F.pmod(own, blocks)).select(*_NAMES))
    done: list[DataFrame] = []
    left = (targets.agg(F.max(blocks).alias("n")).first()["n"]) or 1
    while True:
        flown = stored(rows.repartition("source", "block").sortWithinPartitions("source", "block", F.desc("size"), own, "doc_id")
                       .mapInArrow(_flight(left <= 1), _ROW), "flight")
        done.append(flown.where("phi in (0.0, 1.0)"))
        if left <= 1:
            break
        left = -(-left // FAN_IN)
        rows = flown.where("phi not in (0.0, 1.0)").withColumn("block", F.expr(f"block div {FAN_IN}"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    copies = (F.col("whole") + F.col("phi")).cast("int")
    return out.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                      (copies * F.col("size")).cast("long").alias("taken"))


def repeated(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of docs as often as it was taken (a row of
    size 0, which no mix can take, goes)."""
    taken = mix(docs).where("taken > 0").select("doc_id", "source", "size", "copies")
    same = Window.partitionBy("doc_id", "source", "size")
    taken = taken.withColumn("nth", F.row_number().over(same.orderBy("copies"))).select(
        *[F.col(c).alias(f"mix_{c}") for c in ("doc_id", "source", "size", "nth", "copies")])
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    one = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"),
                      F.col("source").cast("string").alias("source"), size.alias("size"),
                      F.xxhash64("text").alias("hash"))
    total = one.withColumn("nth", F.row_number().over(same.orderBy("hash")))
    on = [total[c].eqNullSafe(taken[f"mix_{c}"]) for c in ("doc_id", "source", "size", "nth")]
    cond = on[0] & on[1] & on[2] & on[3]
    return (total.join(taken, cond).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))))
            .select("doc.*"))
