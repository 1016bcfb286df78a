"""Benchmark decontamination by winnowing.

A text's fingerprints are the minimum 5-gram hash of every run of 6 successive
5-grams, so any 10 words shared by a document and an item hold a 5-gram that
both sides select.  Document fingerprints are joined with item fingerprints
and each hit is extended by up to 5 words either way; an equal run of 10 words
or more is a found span, and every word of it is hit.  An item of fewer than
10 words is one window of its own length; its single gram is looked up at
every document position (winnowing with a window of one).

The items' fingerprints also set bits in a table of bounded size.  The scan of
the documents looks its grams up there first, so only possible hits leave the
scan; how full the table is changes the cost, never the result.

Defined results: a null or empty text has no words, is hit by nothing and is
returned with zeros.  Repeated rows and rows with a null doc_id each get their
own row.  Items with a null or empty text have no window; a null item_id is
never reported, its windows still hit.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import flat
from tidemark.llm.store import stored, text_input

WINDOW = 10
GRAM = 5
REACH = WINDOW - GRAM  # words looked at on either side of a gram
CONTEXT = GRAM + 2 * REACH
#: Bits per item fingerprint in the lookup table, and its bounds.
SLOTS_PER_PRINT, LEAST_SLOTS, MOST_SLOTS = 256, 1 << 20, 1 << 26

CANDIDATES = "array<struct<fp:bigint,len:int,pos:int,context:binary>>"


def winnowed(grams: np.ndarray, width: int = REACH + 1) -> np.ndarray:
    """Positions of the leftmost minimum of each run of width grams."""
    if len(grams) < width:
        return np.zeros(0, np.int64)
    runs = np.lib.stride_tricks.sliding_window_view(grams, width)
    return np.unique(runs.argmin(axis=1) + np.arange(len(runs)))


def contexts(words: np.ndarray, at: np.ndarray, outside: int) -> np.ndarray:
    """The word hashes around each gram; `outside` stands beyond the text."""
    padded = np.concatenate([np.full(REACH, outside, np.uint64), words, np.full(REACH, outside, np.uint64)])
    return padded[at[:, None] + np.arange(CONTEXT)]


def _item_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        ids = batch.column(0)
        for lo, hi, data, offs in flat.text_slices(batch.column(1)):
            words, _, _, bounds = flat.word_hashes(data, offs, flat.ALNUM_WORD)
            for r in range(lo, hi):
                own = words[bounds[r - lo]:bounds[r - lo + 1]]
                if 0 < len(own) < WINDOW:
                    out.append((ids[r].as_py(), int(flat.gram_hashes(own, len(own)).view(np.int64)[0]), len(own), b""))
                elif len(own):
                    grams = flat.gram_hashes(own, GRAM)
                    at = winnowed(grams)
                    for fp, near in zip(grams.view(np.int64)[at].tolist(), contexts(own, at, 1)):
                        out.append((ids[r].as_py(), fp, 0, near.tobytes()))
        cols = list(zip(*out)) if out else [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
             pa.array(cols[3], pa.binary())], names=["item_id", "fp", "len", "context"])


def _scan(slots: np.ndarray, shift: int, short: list[int], long_items: bool):
    """Per document its number of words and its possible hits."""
    table = np.unpackbits(slots).view(bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, data, offs in flat.text_slices(batch.column(1)):
                words, _, _, bounds = flat.word_hashes(data, offs, flat.ALNUM_WORD)
                found: dict[int, list[dict]] = {}
                for k in ([GRAM] if long_items else []) + short:
                    # the same length may be a short item's and the long items' gram
                    _look(k, bool(long_items and k == GRAM), words, bounds, found)
                counts = np.diff(bounds)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(counts.astype(np.int64)),
                     pa.array([found.get(r, []) for r in range(hi - lo)], pa.list_(pa.struct(
                         [("fp", pa.int64()), ("len", pa.int32()), ("pos", pa.int32()), ("context", pa.binary())])))],
                    names=["doc_id", "n_words", "candidates"])

    def _look(k: int, spans: bool, words, bounds, found) -> None:
        grams = flat.gram_hashes(words, k)
        hits = np.flatnonzero(table[grams >> np.uint64(shift)])
        owner = np.searchsorted(bounds, hits, "right") - 1
        inside = hits + k <= bounds[owner + 1]
        for r in np.unique(owner[inside]):
            at = hits[inside & (owner == r)] - bounds[r]
            own, gr = words[bounds[r]:bounds[r + 1]], grams[bounds[r]:bounds[r + 1] - k + 1]
            out = found.setdefault(int(r), [])
            if k in short:
                out += [{"fp": f, "len": k, "pos": p, "context": b""} for f, p in zip(gr.view(np.int64)[at].tolist(), at.tolist())]
            if spans:
                at = np.intersect1d(at, winnowed(gr), assume_unique=True)
                out += [{"fp": f, "len": 0, "pos": p, "context": c.tobytes()}
                        for f, p, c in zip(gr.view(np.int64)[at].tolist(), at.tolist(), contexts(own, at, 0))]

    return run


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Extend joined hits; keep those whose equal run holds a whole window."""
    for batch in batches:
        c = flat.columns_of(batch)
        size, pos = c["len"].to_numpy().astype(np.int64), c["pos"].to_numpy().astype(np.int64)
        start, end = pos.copy(), pos + size
        long = np.flatnonzero(size == 0)
        keep = size > 0
        if len(long):
            rows = pa.array(long)
            same = (flat.matrix_of(c["context"].take(rows), np.uint64, CONTEXT)
                    == flat.matrix_of(c["item_context"].take(rows), np.uint64, CONTEXT))
            left = np.logical_and.accumulate(same[:, REACH - 1::-1], axis=1).sum(axis=1)
            right = np.logical_and.accumulate(same[:, REACH + GRAM:], axis=1).sum(axis=1)
            start[long], end[long] = pos[long] - left, pos[long] + GRAM + right
            keep[long] = same[:, REACH:REACH + GRAM].all(axis=1) & (left + right >= REACH)
        k = pa.array(keep)
        yield pa.RecordBatch.from_arrays(
            [c["uid"].filter(k), c["item_id"].filter(k), pa.array(start[keep]), pa.array(end[keep])],
            names=["uid", "item_id", "start", "end"])


def contaminated_words(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, items, contaminated) for every row of docs.

    docs: doc_id, text; items: item_id, text.  items is the sorted array of
    the item_ids, as strings, that have a window in the document."""
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    prints = stored(items.mapInArrow(_item_prints, "item_id long, fp long, len int, context binary"), "item-prints")
    sizes = {r["len"]: r["n"] for r in prints.groupBy("len").agg(F.count("*").alias("n")).collect()}  # at most 10 rows
    n_slots = min(MOST_SLOTS, max(LEAST_SLOTS, 1 << (SLOTS_PER_PRINT * sum(sizes.values())).bit_length()))
    shift = 64 - (n_slots.bit_length() - 1)
    taken = prints.select(F.shiftrightunsigned("fp", shift).alias("s")).distinct()  # at most MOST_SLOTS
    flags = np.zeros(n_slots, bool)
    flags[np.asarray(taken.toArrow().column(0).to_numpy(), np.int64)] = True
    scan = _scan(np.packbits(flags), shift, sorted(k for k in sizes if k), 0 in sizes)

    rows = stored(text_input(docs).mapInArrow(scan, f"doc_id long, n_words long, candidates {CANDIDATES}")
                  .withColumn("uid", F.monotonically_increasing_id()), "doc-prints")
    maybe = rows.where("size(candidates) > 0").select("uid", F.explode("candidates").alias("c")).select("uid", "c.*")
    joined = maybe.join(prints.withColumnRenamed("context", "item_context"), ["fp", "len"])
    spans = joined.select("uid", "item_id", "len", "pos", "context", "item_context").mapInArrow(
        _extend, "uid long, item_id long, start long, end long")
    spans = stored(spans.distinct(), "hit-spans")
    words = (spans.select("uid", "start", "end").distinct()
             .select("uid", F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("p")).distinct()
             .groupBy("uid").agg(F.count("*").alias("n_hit")))
    named = (spans.select("uid", "item_id").distinct()
             .groupBy("uid").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    none = F.expr("cast(array() as array<string>)")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (rows.select("uid", "doc_id", "n_words").join(words, "uid", "left").join(named, "uid", "left")
            .select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", none).alias("items"),
                    (n_hit > 0).alias("contaminated")))
