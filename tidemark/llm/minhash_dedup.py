"""Near duplicates by MinHash: many universal hash minima, banding, signature
verification, exact confirmation, and components by alternating stars.

1. One pass over the texts gives each document its set size, a 128-bit key of
   its whole shingle set, and the minima of ``HASHES`` universal functions.
2. Documents with equal sets collapse to the smallest doc_id, so a group of
   thousands of copies is one row from here on.
3. Signatures are cut into bands; in each bucket the smallest member is the
   pivot and is paired with the others (a bucket of n gives n - 1 pairs).
4. A pair whose signatures agree far too rarely is dropped; every other pair
   is confirmed on the full shingle sets, made anew from both whole texts.
5. Links go through large-star / small-star.
6. Buckets that still hold several components may hide a link between two
   members that are both far from the pivot.  Those members alone are compared
   block by block, signatures first, then full sets; only links leave a task.
   So a bucket of any size is searched whole.

Defined results: a null or empty text, or one without words, has an empty set
and is linked with nothing.  Rows that share a doc_id are one node.  A row
with a null doc_id keeps its set size, has a null component and is kept.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import flat
from tidemark.llm.components import components
from tidemark.llm.store import stored, text_input

SHINGLE = 5
ROWS, BANDS = 4, 32
HASHES = ROWS * BANDS
#: 75 in 100 must be shared; signatures agreeing in fewer than this share of
#: places (5.5 standard deviations below) are not confirmed.
PERCENT = 75
AGREE = 0.54
#: Members of a block when buckets of several components are searched whole.
BLOCK = 512

_A = flat.fixed_random(1, HASHES) | np.uint64(1)
_B = flat.fixed_random(2, HASHES)
_BAND = flat.fixed_random(3, ROWS * BANDS).reshape(BANDS, ROWS) | np.uint64(1)


def signatures(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """HASHES 32-bit minima for each text's run of shingles (none: all ones)."""
    out = np.full((len(bounds) - 1, HASHES), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(bounds[:-1] < bounds[1:])
    if len(full):
        at = bounds[:-1][full]
        for k in range(HASHES):
            values = ((shingles * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32)
            out[full, k] = np.minimum.reduceat(values, at)
    return out


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, _, _, bounds = flat.word_hashes(data, offs, flat.SPACED_WORD)
    return [np.unique(flat.shingle_hashes(words[a:b], k)) for a, b in zip(bounds[:-1], bounds[1:])]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for lo, hi, data, offs in flat.text_slices(batch.column(1)):
            sets = shingle_sets(data, offs)
            sizes = np.array([len(s) for s in sets], np.int64)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            keys = np.zeros((2, len(sets)), np.uint64)
            full = np.flatnonzero(sizes)
            if len(full):
                at = bounds[:-1][full]
                keys[0, full] = np.add.reduceat(flat.mix(every ^ _A[0]), at)
                keys[1, full] = np.add.reduceat(flat.mix(every ^ _A[1]), at)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), pa.array(sizes), pa.array(keys[0].view(np.int64)),
                 pa.array(keys[1].view(np.int64)), flat.binary_rows(signatures(every, bounds))],
                names=["doc_id", "n_shingles", "k1", "k2", "sig"])


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sig = flat.matrix_of(batch.column(1), np.uint32, HASHES).astype(np.uint64).reshape(-1, BANDS, ROWS)
        keys = flat.mix((sig * _BAND).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
        rep = np.repeat(batch.column(0).to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(rep)], names=["key", "rep"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose full sets share enough; a run of pairs with one
    pivot makes its set once."""
    held: tuple[int, np.ndarray] | None = None
    for batch in flat.sliced(batches, "text_b", 2 << 20):
        c = flat.columns_of(batch)
        a, b = c["a"].to_numpy(), c["b"].to_numpy()
        near = (flat.matrix_of(c["sig_a"], np.uint32, HASHES) == flat.matrix_of(c["sig_b"], np.uint32, HASHES)).mean(axis=1) >= AGREE
        todo = np.flatnonzero(near)
        keep = np.zeros(len(a), bool)
        if len(todo):
            texts = c["text_b"].take(pa.array(todo))
            for lo, hi, data, offs in flat.text_slices(texts):
                for i, other in zip(todo[lo:hi], shingle_sets(data, offs)):
                    if held is None or held[0] != a[i]:
                        raw = np.frombuffer((c["text_a"][int(i)].as_py() or "").encode(), np.uint8)
                        held = int(a[i]), shingle_sets(raw, np.array([0, len(raw)]))[0]
                    shared = len(np.intersect1d(held[1], other, assume_unique=True))
                    keep[i] = 100 * shared >= PERCENT * (len(held[1]) + len(other) - shared)
        yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between different components inside one pair of blocks.

    The members nearest to the blocks' most common minima go first; what they
    join is not compared again."""
    for group in flat.key_groups(batches, ["cluster", "i", "j"]):
        c = flat.columns_of(group)
        rep, size, block = (c[x].to_numpy() for x in ("rep", "n_shingles", "block"))
        part = np.unique(c["component"].to_numpy(), return_inverse=True)[1]
        both = block[:, None] != block[None, :] if c["i"][0].as_py() < c["j"][0].as_py() else None
        sig = flat.matrix_of(c["sig"], np.uint32, HASHES)
        sets: list[np.ndarray] = []
        for _, _, data, offs in flat.text_slices(c["text"]):
            sets += shingle_sets(data, offs)
        middle = np.array([v[n.argmax()] for v, n in (np.unique(col, return_counts=True) for col in sig.T)])
        found: list[tuple[int, int]] = []
        done = np.zeros(len(rep), bool)
        for x in np.argsort(-(sig == middle).sum(axis=1), kind="stable"):
            done[x] = True
            y = ~done & (part != part[x]) & (100 * np.minimum(size, size[x]) >= PERCENT * np.maximum(size, size[x]))
            y = np.flatnonzero(y if both is None else y & both[x])
            for z in y[(sig[y] == sig[x]).mean(axis=1) >= AGREE] if len(y) else y:
                if part[z] != part[x]:
                    shared = len(np.intersect1d(sets[x], sets[z], assume_unique=True))
                    if 100 * shared >= PERCENT * (len(sets[x]) + len(sets[z]) - shared):
                        found.append((int(rep[x]), int(rep[z])))
                        part[part == part[z]] = part[x]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["a", "b"])


def _confirmed(pairs: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """Links among candidate pairs (a < b), each checked on both whole texts."""
    texts = docs.join(reps, docs["doc_id"] == reps["rep"]).select("rep", "sig", "text")
    as_b = texts.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b"), F.col("text").alias("text_b"))
    as_a = texts.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a"), F.col("text").alias("text_a"))
    wide = pairs.join(as_b, "b").join(as_a, "a")
    return wide.select("a", "b", "sig_a", "sig_b", "text_a", "text_b").mapInArrow(_confirm, "a long, b long")


def _searched(rest: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between members of buckets that hold several components.

    Buckets with a common member make one cluster, so that each member's text
    is sent once per pair of blocks of its cluster and not once per bucket."""
    cluster = stored(components(rest.select(F.col("pivot").alias("a"), F.col("rep").alias("b"))), "clusters")
    members = (rest.select("rep", "component").distinct().join(cluster, rest["rep"] == cluster["node"])
               .select("rep", cluster["component"].alias("cluster"), rest["component"]))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    sizes = members.groupBy("cluster").agg(F.count("*").alias("n")).select(F.col("cluster").alias("c"), blocks.alias("n"))
    texts = docs.select(F.col("doc_id").alias("rep"), "text")
    dealt = (members.join(sizes, members["cluster"] == sizes["c"]).join(reps, "rep").join(texts, "rep")
             .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("n")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
             .select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "rep", "component", "n_shingles", "sig", "text"))
    return (dealt.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "rep")
            .mapInArrow(_blocks, "a long, b long").distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs."""
    docs = text_input(docs)
    scan = stored(docs.mapInArrow(_scan, "doc_id long, n_shingles long, k1 long, k2 long, sig binary"), "minhash")
    with_set = scan.where("doc_id is not null and n_shingles > 0")
    classes = with_set.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep"))
    # a repeated doc_id joins the classes of all its texts
    member = stored(with_set.select("doc_id", "k1", "k2", "n_shingles").join(classes, ["k1", "k2", "n_shingles"])
                    .select("doc_id", "rep").distinct(), "members")
    first = member.groupBy("doc_id").agg(F.min("rep").alias("rep"), F.max("rep").alias("other"))
    several = first.where("rep <> other").select(F.col("doc_id").alias("id"), F.col("rep").alias("a"))
    same = member.join(several, member["doc_id"] == several["id"]).select("a", F.col("rep").alias("b"))
    reps = stored(scan.join(classes, ["k1", "k2", "n_shingles"]).where("doc_id = rep")
                  .dropDuplicates(["rep", "k1", "k2"]).select("rep", "n_shingles", "sig"), "signatures")

    bands = stored(reps.select("rep", "sig").mapInArrow(_band_keys, "key long, rep long"), "bands")
    pivots = bands.groupBy("key").agg(F.min("rep").alias("pivot"), F.max("rep").alias("top")).where("pivot < top")
    live = stored(bands.join(pivots.select("key", "pivot"), "key"), "buckets")
    pairs = live.where("pivot < rep").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    links = stored(_confirmed(stored(pairs, "pairs"), reps, docs).union(same), "confirmed")
    found = stored(components(links), "components")

    labelled = live.join(found, live["rep"] == found["node"], "left").select(
        "key", "pivot", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = (labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
             .where("x < y").select("key"))
    rest = stored(labelled.join(mixed, "key"), "mixed-buckets")
    if not rest.isEmpty():
        late = stored(_searched(rest, reps, docs), "late-links")
        if not late.isEmpty():
            found = stored(components(links.union(late)), "components")

    label = (first.join(found, first["rep"] == found["node"], "left")
             .select(F.col("doc_id").alias("id"), F.coalesce("component", "rep").alias("component")))
    out = scan.select("doc_id", "n_shingles").join(label, scan["doc_id"] == label["id"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
