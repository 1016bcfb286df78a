"""Long repeated substrings by a run-length index.

Every string of ``LENGTH`` bytes that starts at two places or more is found,
within a document and between documents, and the bytes it covers are removed.

1. Each window of LENGTH bytes picks the smallest hash of its ``GRAM``-byte
   strings as its anchor.  Equal windows pick equal anchors, so equal windows
   meet at their anchor's hash.  The windows of one anchor are a run; the
   bytes they cover are its context (at most 2 * LENGTH bytes).
2. A context that occurs twice or more repeats as a whole.
3. Different contexts of one anchor are dealt to shards of bounded size, one
   copy each.  A shard's contexts become one text: its Burrows-Wheeler
   transform is run-length coded, the suffix positions at the ends of runs are
   kept, and the longest match is computed at those alone.  Matching
   statistics are then streamed along the text: within a run a match is one
   byte shorter than that of the position before.  Windows whose statistic
   reaches LENGTH repeat.
4. An anchor with more than ``HOT`` different contexts does not go to a shard.
   Its windows hold the anchor at different places: those with it in the
   later half share the bytes before it, the others those after it.  So each
   context is cut in two, the shared bytes are the new anchor, and steps 2 and 3
   follow again.  What is still hot is cut again by half the places; a part of
   one place has one window and no different contexts.
5. Each document's repeated windows are merged and its other bytes are kept.

Everything is exact up to collisions of 128-bit hashes (1, 2); matches in 3
are compared by 64-bit hashes of both spans.

Defined results: null and empty texts have no bytes.  Repeated rows are
different places, so a repeated row of LENGTH bytes or more goes whole.  Rows
with a null doc_id take part.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import flat
from tidemark.llm.store import stored, text_input

LENGTH = 400
GRAM = 32
#: Bytes of contexts in a shard, and different contexts of an anchor in one.
SHARD_BYTES = 1 << 20
HOT = 2048
_PLACE = np.uint64((1 << 24) - 1)
_RANGE = flat.fixed_random(8, 1)[0]
_PIECE = 1 << 23  # a longer text is scanned in overlapping pieces of this many windows


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of width values, by running minima from both ends of blocks."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    full = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    full[:len(values)] = values
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def contexts(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, first window, last window, anchor hash, context hash) of every
    anchor; windows count from the text's start."""
    found: list[tuple[np.ndarray, ...]] = []
    long = np.flatnonzero(np.diff(offs) >= LENGTH)
    if len(data) <= _PIECE + LENGTH:
        if len(long):
            found.append(_contexts(data, offs, long, 0))
    else:
        for t in long:
            own = data[offs[t]:offs[t + 1]]
            for at in range(0, len(own) - LENGTH + 1, _PIECE):
                part = own[at:at + _PIECE + LENGTH - 1]
                text, first, last, anchor, context = _contexts(part, np.array([0, len(part)]), np.array([0]), at)
                found.append((text + t, first, last, anchor, context))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _contexts(data: np.ndarray, offs: np.ndarray, long: np.ndarray, shift: int) -> tuple[np.ndarray, ...]:
    sums = flat.prefix_hash(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = flat.span_hash(sums, at, at + GRAM)
    least = window_minima((grams & ~_PLACE) | at.astype(np.uint64), LENGTH - GRAM + 1)
    counts = offs[long + 1] - offs[long] - LENGTH + 1
    ends = np.cumsum(counts)
    window = np.arange(ends[-1]) - np.repeat(ends - counts, counts) + np.repeat(offs[long], counts)
    place = (least[window] & _PLACE).astype(np.int64)
    turn = np.flatnonzero(np.diff(place, prepend=-1))
    first, last = window[turn], window[np.append(turn[1:], len(window)) - 1]
    place = place[turn]
    text = np.searchsorted(offs, first, "right") - 1
    whole = flat.span_hash(sums, first, last + LENGTH)
    context = flat.mix(whole + (place - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return text, first - offs[text] + shift, last - offs[text] + shift, grams[place], context


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offs in flat.text_slices(batch.column(2)):
            text, first, last, anchor, context = contexts(data, offs)
            row = pa.array(text + lo)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)),
                 pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
                names=["doc_id", "h", "anchor", "context", "first", "last"])


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts asked for, from each document's list."""
    for batch in flat.sliced(batches, "text", 1 << 20):
        c = flat.columns_of(batch)
        out: list[tuple] = []
        for doc_id, h, text, wanted in zip(*(c[x].to_pylist() for x in ("doc_id", "h", "text", "wanted"))):
            raw = text.encode()
            for w in wanted:
                out.append((w["anchor"], doc_id, h, w["first"], w["single"], raw[w["first"]:w["last"] + LENGTH], w["hot"]))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.bool_())
        cols = list(zip(*out)) if out else [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, kinds)],
                                         names=["anchor", "doc_id", "h", "first", "single", "bytes", "hot"])


def suffix_order(text: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Suffixes of all strings in order, by doubling; a string's end comes
    before every byte, and equal suffixes stay in the order of their strings.
    A round sorts only those that are not told apart yet."""
    n, longest = len(text), int(np.diff(offs).max())
    end = np.repeat(offs[1:], np.diff(offs))
    key = np.zeros(n, np.uint64)
    at = np.arange(n)
    for j in range(7):  # seven bytes and their number fit a word
        here = at + j
        key = (key << np.uint64(8)) | np.where(here < end, text[np.minimum(here, n - 1)], 0).astype(np.uint64)
    key = (key << np.uint64(8)) | np.minimum(end - at, 7).astype(np.uint64)
    order = np.argsort(key)
    ranked = key[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    rank = np.empty(n, np.int64)  # the place where a suffix's group of equals begins
    rank[order] = np.maximum.accumulate(np.where(new, at, 0))
    shared = at[~(new & np.append(new[1:], True))]  # places in groups of several
    depth = 7
    while len(shared) and depth < longest:
        here = order[shared]
        there = here + depth
        key = rank[here] * np.int64(n + 1) + np.where(there < end[here], rank[np.minimum(there, n - 1)] + 1, 0)
        turn = np.argsort(key)
        here, ranked = here[turn], key[turn]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        order[shared] = here
        rank[here] = shared[np.maximum.accumulate(np.where(new, np.arange(len(shared)), 0))]
        shared = shared[~(new & np.append(new[1:], True))]
        depth *= 2
    here = order[shared]
    order[shared] = here[np.lexsort((here, rank[here]))]
    return order


def matching_statistics(text: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """For each position the length of its longest match with any other
    position, ends of strings not crossed, from the run-length coded transform
    and the suffix positions at its run ends."""
    n = len(text)
    order = suffix_order(text, offs)
    starts = np.zeros(n, bool)
    starts[offs[:-1][offs[:-1] < n]] = True
    before = text[order - 1].astype(np.int64)  # the transform
    before[starts[order]] = -1 - np.flatnonzero(starts[order])  # every string's end is its own symbol
    head = np.flatnonzero(before[1:] != before[:-1]) + 1
    sums = flat.prefix_hash(text)
    end = np.repeat(offs[1:], np.diff(offs))
    best = np.zeros(n, np.int64)
    shared = _common(sums, order[head], order[head - 1], end)
    for at in (order[head], order[head - 1]):
        sampled = np.zeros(n, np.int64)
        known = starts.copy()  # a string's first position is sampled or has no neighbour
        known[at] = True
        sampled[at] = shared
        last = np.maximum.accumulate(np.where(known, np.arange(n), 0))
        best = np.maximum(best, sampled[last] - (np.arange(n) - last))
    return best


def _common(sums: np.ndarray, a: np.ndarray, b: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes at pairs of places."""
    most = np.minimum(end[a] - a, end[b] - b)
    low, high = np.zeros_like(most), most.copy()
    while (low < high).any():
        mid = (low + high + 1) >> 1
        same = flat.span_hash(sums, a, a + mid) == flat.span_hash(sums, b, b + mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def _runs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of successive numbers."""
    cut = np.flatnonzero(np.diff(at) > 1)
    return at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])]


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated spans of the contexts of a shard, in document offsets."""
    for group in flat.key_groups(batches, ["shard"]):
        c = flat.columns_of(group)
        parts = [x.as_py() for x in c["bytes"]]
        text = np.frombuffer(b"".join(parts), np.uint8)
        offs = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        window = np.flatnonzero(matching_statistics(text, offs) >= LENGTH)
        if not len(window):
            continue
        owner = np.searchsorted(offs, window, "right") - 1
        # a gap of one keeps runs of different contexts apart
        lo, hi = _runs(window + owner)
        own = np.searchsorted(offs + np.arange(len(offs)), lo, "right") - 1
        lo, hi = lo - own, hi - own
        first = c["first"].to_numpy()[own] - offs[own]
        row = pa.array(own)
        yield pa.RecordBatch.from_arrays([c["doc_id"].take(row), c["h"].take(row), pa.array((lo + first).astype(np.int32)),
                                          pa.array((hi + first + LENGTH).astype(np.int32))], names=["doc_id", "h", "start", "end"])


def _halves(level: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts cut in two by the place of the anchor in their windows.  A part
    at a level is one of 2 ** level ranges of places; its new anchor is the
    bytes that all windows of the range share."""
    places = LENGTH - GRAM + 1
    for batch in flat.sliced(batches, "bytes", 1 << 18):
        c = flat.columns_of(batch)
        for lo, hi, data, offs in flat.text_slices(c["bytes"], 1 << 18):
            sums = flat.prefix_hash(data)
            at = np.arange(len(data) - GRAM + 1)
            grams = flat.span_hash(sums, at, at + GRAM)
            least = window_minima((grams & ~_PLACE) | at.astype(np.uint64), LENGTH - GRAM + 1)
            begin, last = offs[:-1], offs[1:] - LENGTH
            place = (least[begin] & _PLACE).astype(np.int64)  # one anchor for all windows of a context
            old, of = c["anchor"].to_numpy()[lo:hi].view(np.uint64), c["part"].to_numpy()[lo:hi].astype(np.int64)
            for half in (0, 1):
                part = 2 * of + half
                low, high = part * places >> level, (part + 1) * places >> level
                first, end = np.maximum(begin, place - high + 1), np.minimum(last, place - low)
                row = np.flatnonzero((first <= end) & (low < high))
                part, low, high, first, end, of_place = (x[row] for x in (part, low, high, first, end, place))
                shared = flat.span_hash(sums, of_place - low, of_place + GRAM + places - high)
                anchor = flat.mix(shared + part.astype(np.uint64) * _RANGE + flat.mix(old[row]))
                whole = flat.span_hash(sums, first, end + LENGTH)
                context = flat.mix(whole + (of_place - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                raw = data.tobytes()
                start = c["first"].to_numpy()[lo:hi][row] + first - begin[row]
                rows = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)), c["doc_id"].take(rows), c["h"].take(rows),
                     pa.array(start.astype(np.int32)), pa.array((start + end - first).astype(np.int32)), pa.array(part.astype(np.int32)),
                     pa.array([raw[x:y + LENGTH] for x, y in zip(first, end)], pa.binary())],
                    names=["anchor", "context", "doc_id", "h", "first", "last", "part", "bytes"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in flat.sliced(batches, "text", 1 << 20):
        c = flat.columns_of(batch)
        size, removed, count, kept = [], [], [], []
        for text, start, end in zip(c["text"].to_pylist(), c["starts"].to_pylist(), c["ends"].to_pylist()):
            raw = (text or "").encode()
            spans = merged(list(zip(start or (), end or ())))
            size.append(len(raw))
            removed.append(sum(b - a for a, b in spans))
            count.append(len(spans))
            at, parts = 0, []
            for a, b in spans:
                parts.append(raw[at:a])
                at = b
            kept.append(b"".join([*parts, raw[at:]]))
        yield pa.RecordBatch.from_arrays([c["doc_id"], pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
                                          pa.array(count, pa.int64()), pa.array(kept, pa.binary())],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, h, start, end): byte spans covered by repeated windows, perhaps
    overlapping; h is xxhash64 of the text.  docs: doc_id, h, text."""
    seen = stored(docs.where(F.octet_length("text") >= LENGTH).mapInArrow(
        _scan, "doc_id long, h long, anchor long, context long, first int, last int"), "contexts")
    kinds = seen.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "h", "first", "last")).alias("one"))
    kinds = stored(kinds, "context-kinds")
    whole = (seen.join(kinds.where("n > 1").select("anchor", "context"), ["anchor", "context"], "left_semi")
             .select("doc_id", "h", F.col("first").alias("start"), (F.col("last") + LENGTH).alias("end")))
    many = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    wanted = (kinds.join(many, "anchor").select(
        "anchor", (F.col("n") == 1).alias("single"), (F.col("kinds") > HOT).alias("hot"), "one.*"))
    lists = wanted.groupBy("doc_id", "h").agg(F.collect_list(F.struct("anchor", "first", "last", "single", "hot")).alias("wanted"))
    lists = lists.withColumnsRenamed({"doc_id": "id", "h": "of"})
    texts = docs.join(lists, docs["doc_id"].eqNullSafe(lists["id"]) & (docs["h"] == lists["of"])).select("doc_id", "h", "text", "wanted")
    cut = stored(texts.mapInArrow(_cut_out, "anchor long, doc_id long, h long, first int, single boolean, bytes binary, hot boolean")
                 .dropDuplicates(["anchor", "doc_id", "h", "first"]), "context-bytes")
    columns = ("anchor", "doc_id", "h", "first", "bytes")
    cold, hot = cut.where("not hot").select(*columns), cut.where("hot").select(*columns, F.lit(0).alias("part"))
    level = 0
    while not hot.isEmpty():  # at most until a part holds one place
        level += 1
        halves = stored(hot.mapInArrow(partial(_halves, level), "anchor long, context long, doc_id long, h long, first int, last int, part int, bytes binary"),
                        "context-halves")
        kinds = stored(halves.groupBy("anchor", "context").agg(
            F.count("*").alias("n"), F.min(F.struct("doc_id", "h", "first", "part", "bytes")).alias("one")), "half-kinds")
        whole = whole.unionByName(halves.join(kinds.where("n > 1").select("anchor", "context"), ["anchor", "context"], "left_semi")
                                  .select("doc_id", "h", F.col("first").alias("start"), (F.col("last") + LENGTH).alias("end")))
        many = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
        cut = stored(kinds.join(many, "anchor").select("anchor", (F.col("kinds") > HOT).alias("hot"), "one.*"), "half-bytes")
        cold = cold.unionByName(cut.where("not hot").select(*columns))
        hot = cut.where("hot").select(*columns, "part")
    total = cold.agg(F.sum(F.octet_length("bytes")).alias("n")).first()["n"] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    cold = (cold.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int"))
            .select("shard", "doc_id", "h", "first", "bytes")
            .repartition("shard").sortWithinPartitions("shard").mapInArrow(_index, "doc_id long, h long, start int, end int"))
    return whole.unionByName(cold)


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for every row of docs; kept
    holds the bytes that no repeated window covers."""
    docs = text_input(docs).select("doc_id", F.xxhash64("text").alias("h"), "text")
    spans = stored(repeated_spans(docs), "repeated-spans")
    lists = (spans.groupBy(F.col("doc_id").alias("id"), F.col("h").alias("of"))
             .agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")))
    joined = docs.join(lists, docs["doc_id"].eqNullSafe(lists["id"]) & (docs["h"] == lists["of"]), "left")
    return joined.select("doc_id", "text", "starts", "ends").mapInArrow(
        _keep, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
