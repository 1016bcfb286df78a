"""Whitening of embeddings by a bit-sliced scatter matrix.

Entries become integers x = floor(scale * c).  Each different x vector is in the
fit once.  Blocks of these vectors are shifted to their smallest entry of each
dimension and cut into bit planes: plane p of dimension j holds bit p of every
row's entry, packed into 64-bit words.  The popcount of the AND of two planes,
weighted by 2**(p + q), is that pair's share of a cross-product, so the sums
and cross-products are exact integers.  They are centred as integers
(n * G - S * S') before eigh sees them.

Size: a task holds one block of planes and one d x d matrix; what the driver
gets is d * (d + 1) / 2 exact sums, so d, not the number of rows, bounds it.

Defined results.  Rows whose vector is null, or holds null or non-finite
entries, are left out; so are rows whose vector is not of the table's main
length (the most frequent among the others, the longer of equally frequent
ones).  A scaled entry beyond the range of long is its nearest long.
Components without variance (eigenvalue within rounding of 0) cannot be
whitened and give no rows, so a fit list of one vector, or an empty table,
gives none.  Repeated rows and null ids give rows each.  ``deviation`` is null
where the exact value does not fit into long (from some 10 million different
unit vectors on); ``deviation_exact`` has it as text always.  Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import flat
from tidemark.llm.store import stored

SCALE = 256
COMPONENTS = 4
#: Rows of a block of bit planes.
BLOCK = 16_384
#: Limbs of 32 bits that carry an exact sum between tasks.
LIMBS = 6

_WIDTHS = (np.int8, np.int16, np.int32, np.int64)


def quantised(c: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * c) as int64; values beyond its range are its ends."""
    y = np.floor(scale * c.astype(np.float64))
    out = np.clip(y, -2.0 ** 63, np.nextafter(2.0 ** 63, 0)).astype(np.int64)
    out[y >= 2.0 ** 63] = np.iinfo(np.int64).max
    return out


def _rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of doubles) for each length of vector; rows with null or non-finite entries are left out."""
    if pa.types.is_fixed_size_list(column.type):
        column = column.cast(pa.list_(column.type.value_type))
    n = len(column)
    offs = column.offsets.to_numpy().astype(np.int64)
    values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls are NaN
    sizes = np.diff(offs)
    present = ~np.asarray(column.is_null())
    for d in np.unique(sizes[present]) if n else ():
        at = np.flatnonzero(present & (sizes == d))
        m = values[offs[at][:, None] + np.arange(d)]
        good = np.isfinite(m).all(axis=1)
        if good.any():
            yield at[good], m[good]


def _packed(x: np.ndarray) -> pa.Array:
    """Each vector in the narrowest integers that hold it, so that equal ones are equal bytes."""
    most = np.maximum(x, ~x).max(axis=1, initial=0)
    width = sum((most > np.iinfo(t).max).astype(np.int8) for t in _WIDTHS[:-1])
    cells: list[bytes] = [b""] * len(x)
    for w, kind in enumerate(_WIDTHS):
        rows = np.flatnonzero(width == w)
        raw, size = np.ascontiguousarray(x[rows].astype(kind)).tobytes(), x.shape[1] * np.dtype(kind).itemsize
        for i, r in enumerate(rows.tolist()):
            cells[r] = bytes([w]) + raw[i * size:(i + 1) * size]
    return pa.array(cells, pa.binary())


def _unpacked(column: pa.Array, d: int) -> np.ndarray:
    out = np.empty((len(column), d), np.int64)
    offs = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(column.buffers()[2], np.uint8)
    width = raw[offs[:-1]]
    for w, kind in enumerate(_WIDTHS):
        rows = np.flatnonzero(width == w)
        if len(rows):
            size = d * np.dtype(kind).itemsize
            out[rows] = np.ascontiguousarray(raw[offs[rows][:, None] + 1 + np.arange(size)]).view(kind)
    return out


def _quantise(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, m in _rows(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(m), m.shape[1], np.int32)), _packed(quantised(m, scale))],
                                                 names=["d", "x"])

    return run


def planes(u: np.ndarray) -> tuple[np.ndarray, int]:
    """Bit planes of unsigned rows: plane dimension * bits + p, packed across
    rows into words; and the number of bits."""
    bits = max(1, int(u.max(initial=0)).bit_length())
    n, d = u.shape
    words = -(-n // 64)
    padded = np.zeros((d, bits, words * 64), np.uint8)
    for p in range(bits):
        padded[:, p, :n] = ((u >> np.uint64(p)) & np.uint64(1)).T
    return np.packbits(padded.reshape(d * bits, -1), axis=1, bitorder="little").view(np.uint64), bits


def shared_bits(p: np.ndarray) -> np.ndarray:
    """Popcounts of the ANDs of all pairs of planes."""
    out = np.empty((len(p), len(p)), np.int64)
    for a in range(len(p)):
        out[a, a:] = np.bitwise_count(p[a] & p[a:]).sum(axis=1, dtype=np.int64)
        out[a:, a] = out[a, a:]
    return out


def block_sums(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact (S, G) of a block as Python integers: sums, and cross-products X'X."""
    n, d = x.shape
    low = x.min(axis=0)
    p, bits = planes(x.astype(np.uint64) - low.astype(np.uint64))
    pairs = shared_bits(p)
    # weights that keep every partial sum within 64 bits; else Python's integers
    kind = np.int64 if 2 * bits + max(1, n).bit_length() < 62 else object
    weight = np.array([1 << i for i in range(bits)], object).astype(kind)
    whole = pairs.astype(kind).reshape(d, bits, d, bits)
    g = np.tensordot(np.tensordot(whole, weight, axes=([1], [0])), weight, axes=([2], [0])).astype(object)
    s = np.diagonal(pairs).reshape(d, bits).astype(kind).dot(weight).astype(object)
    shift = low.astype(object)
    return s + n * shift, g + np.outer(shift, s) + np.outer(s, shift) + n * np.outer(shift, shift)


def _limbs(values: list[int]) -> list[pa.Array]:
    """Integers as two's complement limbs of 32 bits, the last one signed; sums of limbs stay exact."""
    out = []
    for i in range(LIMBS):
        out.append(pa.array([v >> 32 * i if i == LIMBS - 1 else v >> 32 * i & 0xFFFFFFFF for v in values], pa.int64()))
    return out


def _scatter(d: int):
    names = ["i", "j", *(f"limb{k}" for k in range(LIMBS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, g = 0, np.zeros(d, object), np.zeros((d, d), object)
        held: list[np.ndarray] = []

        def take() -> None:
            nonlocal n, s, g
            x = np.concatenate(held)
            for lo in range(0, len(x), BLOCK):
                bs, bg = block_sums(x[lo:lo + BLOCK])
                n, s, g = n + len(x[lo:lo + BLOCK]), s + bs, g + bg
            held.clear()

        for batch in batches:
            if batch.num_rows:
                held.append(_unpacked(batch.column(0), d))
                if sum(map(len, held)) >= BLOCK:
                    take()
        if held:
            take()
        if n:
            upper = np.triu_indices(d)
            i = np.concatenate([[-1], np.full(d, -1), upper[0]])  # i = -1: n, then the sums
            j = np.concatenate([[-1], np.arange(d), upper[1]])
            values = [n, *s.tolist(), *g[upper].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *_limbs(values)], names=names)

    return run


class Fit:
    """n, the sums S, the leading components as columns, their eigenvalues and
    shares of the trace, all from exact integers."""

    def __init__(self, d: int, n: int, s: list[int], g: list[list[int]], components: int):
        self.d, self.n, self.s = d, n, s
        # Python divides integers with one rounding, so V is n * G - S * S' over n * n to the last bit
        v = np.array([[(n * g[i][j] - s[i] * s[j]) / (n * n) for j in range(d)] for i in range(d)], np.float64).reshape(d, d)
        if not d:
            self.e, self.w, self.explained = np.zeros(0), np.zeros((0, 0)), np.zeros(0)
            return
        e, w = np.linalg.eigh(v)
        e, w = e[::-1][:components], w[:, ::-1][:, :components]
        real = e > max(e[0], 0.0) * d * np.finfo(float).eps
        self.e, w = e[real], w[:, real]
        top = np.abs(w).argmax(axis=0)
        self.w = w * np.sign(w[top, np.arange(w.shape[1])])  # the largest entry is positive
        self.explained = self.e / np.trace(v)

    def _small(self, x: np.ndarray) -> bool:
        most = int(np.maximum(x, ~x).max(initial=0)) + 1
        top = max([abs(v) for v in self.s], default=0)
        return self.d * (self.n * most + top) ** 2 < 1 << 62

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n as doubles, with one rounding after the exact n * x - S."""
        if self._small(x):
            return (self.n * x - np.array(self.s, np.int64)) / self.n
        return np.array([[(self.n * v - s) / self.n for v, s in zip(r, self.s)] for r in x.tolist()]).reshape(x.shape)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.w / np.sqrt(self.e)

    def deviation(self, x: np.ndarray) -> list[int]:
        if self._small(x):
            return ((self.n * x - np.array(self.s, np.int64)) ** 2).sum(axis=1).tolist()
        return [sum((self.n * v - s) ** 2 for v, s in zip(r, self.s)) for r in x.tolist()]


def _moments(fit: Fit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fit.e)
        first, second, n = np.zeros(k), np.zeros((k, k)), 0
        for batch in batches:
            if batch.num_rows:
                z = fit.whitened(_unpacked(batch.column(0), fit.d))
                first, second, n = first + z.sum(axis=0), second + z.T @ z, n + len(z)
        if n:
            i, j = np.divmod(np.arange(k * k), k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(np.full(k, -1), i), pa.int32()), pa.array(np.append(np.arange(k), j), pa.int32()),
                 pa.array(np.append(first, second.ravel()))], names=["i", "j", "v"])

    return run


def identity_error(distinct: DataFrame, fit: Fit) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the
    identity, from the whitened vectors themselves (k * k sums reach the driver)."""
    k = len(fit.e)
    if not k:
        return 0.0
    rows = distinct.select("x").mapInArrow(_moments(fit), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    got = {(r["i"], r["j"]): r["v"] / fit.n for r in rows}
    return max(abs(got[i, j] - got[-1, i] * got[-1, j] - (i == j)) for i in range(k) for j in range(k))


def fitted(vectors: DataFrame, scale: int = SCALE, components: int = COMPONENTS) -> tuple[Fit, float]:
    """The fit over the different quantised vectors of (id, vector) rows, and its identity error."""
    vec = vectors.columns[1]
    distinct = stored(vectors.select(vec).mapInArrow(_quantise(scale), "d int, x binary").groupBy("d", "x")
                      .agg(F.count("*").alias("rows")), "whitening-vectors")
    main = distinct.groupBy("d").agg(F.sum("rows").alias("rows")).orderBy(F.desc("rows"), F.desc("d")).first()
    if main is None:
        return Fit(0, 0, [], [], components), 0.0
    d = main["d"]
    distinct = distinct.where(F.col("d") == d)
    limbs = [f"limb{k}" for k in range(LIMBS)]
    schema = "i int, j int, " + ", ".join(f"{c} long" for c in limbs)
    sums = (distinct.select("x").mapInArrow(_scatter(d), schema).groupBy("i", "j")
            .agg(*(F.sum(c).alias(c) for c in limbs)).collect())
    value = {(r["i"], r["j"]): sum(r[c] << 32 * k for k, c in enumerate(limbs)) for r in sums}
    g = [[value[min(i, j), max(i, j)] for j in range(d)] for i in range(d)]
    fit = Fit(d, value[-1, -1], [value[-1, j] for j in range(d)], g, components)
    return fit, identity_error(distinct, fit)


def whitened(vectors: DataFrame, scale: int = SCALE, components: int = COMPONENTS) -> DataFrame:
    """One row per remaining row and component of (id, vector) rows: the id,
    component, n, deviation, whitened, explained, identity_error,
    deviation_exact, eigenvalue."""
    key, vec = vectors.columns[:2]
    vectors = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vec).cast("array<double>").alias("vector"))
    fit, error = fitted(vectors, scale, components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fit.e)
        for batch in batches:
            for at, m in _rows(batch.column(1)):
                if m.shape[1] != fit.d or not k:
                    continue
                x = quantised(m, scale)
                exact = fit.deviation(x)
                rows = len(x) * k
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(np.repeat(at, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(rows, fit.n, np.int64)),
                    pa.array([v if v < 1 << 63 else None for v in exact for _ in range(k)], pa.int64()),
                    pa.array(fit.whitened(x).ravel()),
                    pa.array(np.tile(fit.explained, len(x))),
                    pa.array(np.full(rows, error)),
                    pa.array([str(v) for v in exact for _ in range(k)], pa.string()),
                    pa.array(np.tile(fit.e, len(x)))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error",
                           "deviation_exact", "eigenvalue"])

    return vectors.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, explained double, "
                                   "identity_error double, deviation_exact string, eigenvalue double")
