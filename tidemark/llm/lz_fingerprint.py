"""Document fingerprints from Lempel-Ziv phrases.

A text's bytes are parsed into dictionary phrases (each phrase is the longest
one seen before, plus a byte).  The set of phrases is what a dictionary coder
learns of the text; two texts that share most phrases would compress well
together.  The fingerprint holds the minimum of ``HASHES`` universal hash
functions over the phrase set, 16 bits each; the share of equal minima
estimates the sets' resemblance.

``compared_with_next`` walks documents in descending doc_id.  Documents are
dealt to buckets of doc_id ranges; the first document of every bucket is sent
to the bucket before it as well, so each bucket knows the neighbour of its
last document.  A text and its edited form share their parse up to the edit.

Defined results: null and empty texts have no phrase, all-ones minima, and
likeness 1 with each other.  Repeated rows are neighbours of each other,
ordered by their text's hash; null doc_ids come last.  A single row is its own
next document.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import flat
from tidemark.llm.store import text_input

HASHES = 64
_A = flat.fixed_random(11, HASHES) | np.uint64(1)
_B = flat.fixed_random(12, HASHES)
_CHUNK = 1 << 20


def parse(data: bytes, at: int, seen: set[bytes], ends: list[int], added: list[bytes]) -> None:
    """Parse data[at:] into phrases; the dictionary is closed under prefixes,
    so the longest known phrase is looked for from a guess both ways."""
    n = len(data)
    while at < n:
        j = at + 3
        if j <= n and data[at:j] in seen:
            j += 1
            while j <= n and data[at:j] in seen:
                j += 1
        else:
            j = at + 1
            while j <= n and data[at:j] in seen:
                j += 1
        phrase = data[at:j]
        if phrase not in seen:
            seen.add(phrase)
            added.append(phrase)
        at = min(j, n)
        ends.append(at)


def _hashes(data: bytes, ends: list[int]) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    stop = np.array(ends, np.int64)
    return flat.span_hash(flat.prefix_hash(raw), np.concatenate([[0], stop[:-1]]), stop) if ends else np.zeros(0, np.uint64)


def phrase_hashes(data: bytes) -> np.ndarray:
    ends: list[int] = []
    parse(data, 0, set(), ends, [])
    return _hashes(data, ends)


def both_phrase_hashes(data: bytes, cut: int, edited: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Phrase hashes of two texts equal up to cut: one parse to there, then two."""
    seen: set[bytes] = set()
    ends: list[int] = []
    parse(data[:cut], 0, seen, ends, [])
    if ends:  # the phrase at the cut may go on beyond it
        last = ends.pop()
        begin = ends[-1] if ends else 0
        seen.discard(data[begin:last])
        if any(data[a:b] == data[begin:last] for a, b in zip([0, *ends], ends)):
            seen.add(data[begin:last])
    begin = ends[-1] if ends else 0
    own, other, added = ends.copy(), ends.copy(), []
    parse(data, begin, seen, own, added)
    seen.difference_update(added)
    parse(edited, begin, seen, other, [])
    return _hashes(data, own), _hashes(edited, other)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES 16-bit minima of each set of phrase hashes."""
    out = np.full((len(sets), HASHES), 0xFFFF, np.uint16)
    sizes = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(sizes)
    if len(full):
        every = np.concatenate(sets)
        at = (np.cumsum(sizes) - sizes)[full]
        for k in range(HASHES):
            values = ((every * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32)
            out[full, k] = (np.minimum.reduceat(values, at) & np.uint32(0xFFFF)).astype(np.uint16)
    return out


def _edited(text: str, after: str) -> tuple[str, int]:
    """The text whose last third is the next one's beginning, and the characters kept."""
    third = len(text) // 3
    return text[:len(text) - third] + after[:third], len(text) - third


def _emit(ids: list, texts: list[str], after: str) -> pa.RecordBatch:
    """Rows of texts in order; after follows the last one."""
    own, edited, digests = [], [], []
    for text, follows in zip(texts, [*texts[1:], after]):
        new, kept = _edited(text, follows)
        data, changed = text.encode(), new.encode()
        a, b = both_phrase_hashes(data, len(text[:kept].encode()), changed)
        own.append(a)
        edited.append(b)
        digests.append(hashlib.sha256(changed).hexdigest())
    m = minima([*own, phrase_hashes(after.encode()), *edited])
    n = len(texts)
    mine, following, theirs = m[:n], m[1:n + 1], m[n + 1:]
    strings = [r.astype(">u2").tobytes().hex() for r in mine], [r.astype(">u2").tobytes().hex() for r in theirs]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(digests, pa.string()),
         pa.array(strings[0], pa.string()), pa.array(strings[1], pa.string()),
         pa.array((mine == theirs).mean(axis=1)), pa.array((mine == following).mean(axis=1))],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, neighbours of the bucket last."""
    ids: list = []
    texts: list[str] = []
    size, bucket, over = 0, None, True
    for batch in batches:
        for b, extra, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            text = text or ""
            if b != bucket:
                bucket, over = b, False
            if over:
                continue
            if extra or size > _CHUNK:
                if texts:
                    yield _emit(ids, texts, text)
                ids, texts, size = [], [], 0
            if extra:
                over = True
            else:
                ids.append(doc_id)
                texts.append(text)
                size += len(text)


def compared_with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) for every row of docs."""
    docs = text_input(docs)
    spark = docs.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = docs.stat.approxQuantile("doc_id", [i / n for i in range(1, n)], min(0.001, 0.1 / n)) if n > 1 else []
    cuts = sorted({int(c) for c in cuts})
    above = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c >= F.col("doc_id"))) if cuts else F.lit(0)
    placed = docs.withColumn("bucket", F.when(F.col("doc_id").isNull(), F.lit(len(cuts))).otherwise(above))
    order = [F.desc_nulls_last("doc_id"), F.xxhash64("text")]
    heads = sorted((r["bucket"], r["head"]) for r in
                   placed.groupBy("bucket").agg(F.max("doc_id").alias("head")).collect())  # a row per bucket
    if not heads:
        before = {}
    else:
        before = {(b, head): heads[i - 1][0] for i, (b, head) in enumerate(heads)}
    known = spark.createDataFrame([(b, h, to) for (b, h), to in before.items()], "b int, h long, to int")
    lead = (placed.join(F.broadcast(known), (F.col("bucket") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("h")))
            .select(F.col("to").alias("bucket"), F.lit(1).alias("extra"), "doc_id", "text"))
    rows = placed.select("bucket", F.lit(0).alias("extra"), "doc_id", "text").unionByName(lead)
    return (rows.repartitionById(len(cuts) + 1, F.col("bucket")).sortWithinPartitions("bucket", "extra", *order)
            .mapInArrow(_walk, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                               "edited_fingerprint string, near_edited double, near_next double"))
