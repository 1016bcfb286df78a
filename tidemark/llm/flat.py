"""Byte kernels on flat Arrow text columns.

A text column of an Arrow batch is one byte buffer plus offsets.  The kernels
here work on that buffer directly, a bounded slice of documents at a time, so
a task's memory does not follow the batch size and no Python object is made
per word.  Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_MASK64 = (1 << 64) - 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def fixed_random(seed: int, n: int) -> np.ndarray:
    """n reproducible 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _ODD + np.uint64(seed * 0x51ED27 & _MASK64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the rolling base and of its inverse modulo 2**64."""
    if len(_powers["up"]) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


BYTE_VALUE = fixed_random(7, 256)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_VALUE_LOWER = BYTE_VALUE[LOWER]


def table_of(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for lo, hi in ranges:
        out[lo:hi + 1] = True
    return out


# word classes of the query contracts, on UTF-8 bytes (A-Z already lower)
ALNUM_WORD = table_of((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
SPACED_WORD = ~table_of((0x20, 0x20), (0x09, 0x0D))


def text_slices(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) for runs of whole texts of
    about max_bytes; a longer text comes alone.  Offsets start at 0."""
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    bufs = column.buffers()
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + max_bytes, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def prefix_hash(data: np.ndarray, values: np.ndarray = BYTE_VALUE) -> np.ndarray:
    """Running polynomial sums; span_hash() takes any span's hash from them."""
    up, _ = powers(len(data))
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(values[data] * up[:len(data)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def word_spans(data: np.ndarray, offs: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each text's word range (len(offs) bounds)."""
    n = len(data)
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = word[data]
    starts_at = inside[1:-1] > inside[:-2]
    ends_at = inside[1:-1] > inside[2:]
    full = offs[:-1] < offs[1:]
    first, last = offs[:-1][full], offs[1:][full] - 1
    starts_at[first] = inside[first + 1] > 0  # words never cross texts
    ends_at[last] = inside[last + 1] > 0
    starts = np.flatnonzero(starts_at)
    return starts, np.flatnonzero(ends_at) + 1, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, offs: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased word hashes with byte starts, ends and each text's word range."""
    starts, ends, bounds = word_spans(data, offs, word)
    return span_hash(prefix_hash(data, BYTE_VALUE_LOWER), starts, ends), starts, ends, bounds


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words (len(words) - k + 1 of them, at least 0)."""
    n = max(0, len(words) - k + 1)
    out = np.full(n, k * int(_ODD) & _MASK64, np.uint64)
    for j, c in enumerate(fixed_random(100 + k, k) | np.uint64(1)):
        out += words[j:j + n] * c
    return mix(out)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """k-word shingles of one text; a text of fewer words is one shingle, none gives none."""
    return gram_hashes(words, min(k, len(words))) if len(words) else words[:0]


def binary_rows(matrix: np.ndarray) -> pa.Array:
    """One binary value per row of a C-contiguous matrix."""
    m = np.ascontiguousarray(matrix)
    width = m.dtype.itemsize * (m.shape[1] if m.ndim > 1 else 1)
    offs = np.arange(len(m) + 1, dtype=np.int64) * width
    if offs[-1] >= 1 << 31:
        raise ValueError("batch too large for 32-bit offsets")
    return pa.Array.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(offs.astype(np.int32)), pa.py_buffer(m.tobytes())])


def matrix_of(column: pa.Array, dtype, width: int) -> np.ndarray:
    """The fixed-width binary values of a column as a matrix."""
    n = len(column)
    offs = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[offs[0]:offs[-1]] if n else np.zeros(0, np.uint8)
    return raw.view(dtype).reshape(n, width) if n else np.zeros((0, width), dtype)


def columns_of(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    return dict(zip(batch.schema.names, batch.columns))


def sliced(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that one holds about max_bytes of a text column."""
    for batch in batches:
        for lo, hi, _, _ in text_slices(batch.column(batch.schema.get_field_index(column)), max_bytes):
            yield batch.slice(lo, hi - lo)


def key_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Runs of equal keys in a stream sorted by them, each as one batch.  The
    caller bounds the size of a run."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        new = np.zeros(n, bool)
        for k in keys:
            c = batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False)
            new[1:] |= c[1:] != c[:-1]
            if held:
                last = held[-1].column(held[-1].schema.get_field_index(k))
                new[0] |= last[len(last) - 1].as_py() != c[0]
        cuts = np.flatnonzero(new)
        if len(cuts) == 0:
            held.append(batch)
            continue
        if cuts[0] > 0:
            held.append(batch.slice(0, int(cuts[0])))
        if held:
            yield _joined(held)
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(int(a), int(b - a))
        held = [batch.slice(int(cuts[-1]))]
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
