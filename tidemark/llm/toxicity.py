"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes
log-count ratios.

A feature is the presence of a 3-, 4- or 5-gram of the lower-cased text's
bytes, hashed to one of 2**19 slots.  From labelled texts each slot gets its
log-count ratio r (smoothed share of toxic texts that have it over the share
of the others); slots whose class counts differ by no more than chance (a
chi-square below ``LEAST_CHI2``) carry no evidence and are left out.  A
logistic regression is fitted on the presences scaled by r.  Every text is
scored whole, in one pass, with one table lookup per gram.

The fit uses a bounded sample of labelled rows: about ``FIT_ROWS`` of each
label, chosen by a hash of the doc_id; rows are weighted back to the label
counts of all training rows.

Defined results: null and empty texts have no feature and score the
intercept's chance.  Repeated rows are scored alike.  A doc_id labelled both
ways counts as toxic.  Without both labels among the training rows every
score is the training rows' share of label 1, at least 1e-6 and at most 1 - 1e-6.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import flat
from tidemark.llm.store import stored, text_batches, text_input

SIZES = (3, 4, 5)
SLOT_BITS = 19
FIT_ROWS = 8_000
LEAST_CHI2 = 20.0
MOST_FEATURES = 3_000
RIDGE = 1e-3
STEPS = 300

_SPACE = flat.LOWER.copy()
_SPACE[[9, 10, 11, 12, 13]] = 32


@dataclass(frozen=True)
class Model:
    slots: np.ndarray  # chosen slots, ascending
    weights: np.ndarray  # coefficient times log-count ratio of each
    intercept: float


def gram_slots(data: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slot, position) arrays of each gram size; grams never cross texts."""
    x = _SPACE[data].astype(np.uint64)
    for n in SIZES:
        m = len(x) - n + 1
        if m <= 0:
            continue
        packed = np.full(m, n, np.uint64)
        for j in range(n):
            packed += x[j:j + m] << np.uint64(8 * j + 8)
        inside = np.ones(len(x), bool)
        cut = (offs[1:, None] - np.arange(1, n)).ravel()
        inside[cut[(cut >= 0) & (cut < len(x))]] = False
        at = np.flatnonzero(inside[:m])
        yield (flat.mix(packed) >> np.uint64(64 - SLOT_BITS))[at].astype(np.int64), at


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slot the texts of either label that have it."""
    counts = np.zeros((2, 1 << SLOT_BITS), np.int32)
    seen = np.zeros(1 << SLOT_BITS, bool)
    for batch in batches:
        label = batch.column(1).to_numpy()
        for lo, hi, data, offs in flat.text_slices(batch.column(0)):
            for r in range(hi - lo):
                for slots, _ in gram_slots(data[offs[r]:offs[r + 1]], np.array([0, offs[r + 1] - offs[r]])):
                    seen[slots] = True
                hit = np.flatnonzero(seen)
                counts[label[lo + r], hit] += 1
                seen[hit] = False
    at = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[0, at].astype(np.int64)),
                                      pa.array(counts[1, at].astype(np.int64))], names=["slot", "n0", "n1"])


def presences(column: pa.Array, lookup: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, text, feature) of each distinct feature of each text."""
    for lo, hi, data, offs in flat.text_slices(column):
        found = [np.zeros(0, np.int64)]
        for slots, at in gram_slots(data, offs):
            feature = lookup[slots]
            hit = np.flatnonzero(feature)
            owner = np.searchsorted(offs, at[hit], "right") - 1
            found.append(np.unique(owner * len(lookup) + feature[hit] - 1))
        pairs = np.unique(np.concatenate(found))
        yield lo, hi, pairs // len(lookup), pairs % len(lookup)


def _lookup(slots: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << SLOT_BITS, np.int32)
    out[slots] = np.arange(1, len(slots) + 1)
    return out


def _featurised(slots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _lookup(slots)
        for batch in batches:
            rows: list[np.ndarray] = []
            for lo, hi, text, feature in presences(batch.column(0), lookup):
                rows += np.split(feature, np.searchsorted(text, np.arange(1, hi - lo)))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.list_(pa.int32()))], names=["label", "features"])

    return run


def _fit(ratio: np.ndarray, cols: np.ndarray, sizes: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Weighted ridge logistic regression by accelerated gradient steps; cols
    are the features of all rows, sizes[i] of them of row i."""
    full = np.flatnonzero(sizes)
    at = (np.cumsum(sizes) - sizes)[full]
    x = ratio[cols]

    def by_row(values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(sizes))
        if len(full):
            out[full] = np.add.reduceat(values, at)
        return out

    weight = weight / weight.sum()
    share = float((weight * label).sum())
    w, b = np.zeros(len(ratio)), np.log(share / (1 - share))
    step = 4.0 / max(1e-9, float((weight * (by_row(x * x) + 1)).sum()) + 4 * RIDGE)
    vw, vb, t = w.copy(), b, 1.0
    for _ in range(STEPS):
        z = by_row(x * vw[cols]) + vb
        g = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - label)
        nw = vw - step * (np.bincount(cols, x * np.repeat(g, sizes), len(ratio)) + RIDGE * vw)
        nb = vb - step * g.sum()
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, float(b)


def held_out(doc_id: str = "doc_id") -> Column:
    """The contract's split: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def _constant(n0: int, n1: int) -> Model:
    """The model of a training set without both labels: their share, for every text."""
    share = min(max(n1 / max(1, n0 + n1), 1e-6), 1 - 1e-6)
    return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share))))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on labelled documents (labels: doc_id, toxic) outside the held-out fifth."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
              .where("doc_id is not null and label in (0, 1)").where(~held_out())
              .groupBy("doc_id").agg(F.max("label").alias("label")))
    totals = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return _constant(totals.get(0, 0), totals.get(1, 0))
    rate = F.when(F.col("label") == 1, min(1.0, FIT_ROWS / totals[1])).otherwise(min(1.0, FIT_ROWS / totals[0]))
    chosen = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < rate * (1 << 30))
    # at most about 2 * FIT_ROWS ids of 12 bytes
    sample = stored(text_input(docs).join(F.broadcast(chosen), "doc_id").select("text", "label"), "fit-sample")
    counts = (sample.repartition(6).mapInArrow(_count, "slot long, n0 long, n1 long")
              .groupBy("slot").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    sizes = sample.agg(F.count_if(F.col("label") == 0).alias("t0"), F.count_if(F.col("label") == 1).alias("t1")).first()
    t0, t1 = sizes["t0"], sizes["t1"]
    if not (t0 and t1):
        return _constant(t0, t1)
    expected = (F.col("n0") + F.col("n1")) * t1 / (t0 + t1)
    chi2 = F.pow(F.col("n1") - expected, 2) / (expected * (1 - (F.col("n0") + F.col("n1")) / (t0 + t1) + 1e-9) * t0 / (t0 + t1))
    best = (counts.withColumn("chi2", chi2).where(F.col("chi2") >= LEAST_CHI2)
            .orderBy(F.desc("chi2"), "slot").limit(MOST_FEATURES).toPandas().sort_values("slot"))
    slots = best["slot"].to_numpy(np.int64)
    n0, n1 = best["n0"].to_numpy(float), best["n1"].to_numpy(float)
    ratio = np.log((n1 + 1) / (t1 + 2)) - np.log((n0 + 1) / (t0 + 2))
    fit = sample.mapInArrow(_featurised(slots), "label int, features array<int>").toArrow().combine_chunks()
    label = fit.column("label").to_numpy().astype(float)
    lists = fit.column("features").combine_chunks()
    cols = lists.flatten().to_numpy().astype(np.int64)
    sizes = lists.value_lengths().to_numpy().astype(np.int64)
    weight = np.where(label == 1, totals[1] / t1, totals[0] / t0)
    w, b = _fit(ratio, cols, sizes, label, weight)
    return Model(slots, w * ratio, b)


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with held_out, score and predicted, fitted on its own labelled rows.

    Every column of docs stays; a column of one of those names is replaced."""
    model = train(docs, labels)

    @F.pandas_udf("double")
    def chance(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lookup = _lookup(model.slots)
        for text in texts:
            z = np.full(len(text), model.intercept)
            for lo, hi, row, feature in presences(pa.array(text, pa.string(), from_pandas=True), lookup):
                z[lo:hi] += np.bincount(row, model.weights[feature], hi - lo) if len(row) else 0.0
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -500, 500))))

    text_batches(docs.sparkSession)
    return (docs.withColumn("held_out", held_out()).withColumn("score", chance(F.col("text").cast("string")))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
