"""Whitening against plain numpy and Python integers."""

import math

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.cases import SMALL
from tidemark.llm import whitening as w


def _frame(spark, vectors):
    return spark.createDataFrame([(i, v, "x", 1, 2.0) for i, v in vectors], "vec_id long, embedding array<double>, x string, n long, component double")


def _plain(vectors, k=4):
    """n, deviations by row, whitened up to sign, explained."""
    x = [[math.floor(256 * c) for c in v] for v in vectors]
    u = sorted(set(map(tuple, x)))
    n, s = len(u), [sum(c) for c in zip(*u)]
    cov = np.cov(np.array(u, float).T, bias=True).reshape(len(s), len(s))
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    centred = np.array(x, float) - np.array(s, float) / n
    return n, [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x], centred @ q / np.sqrt(e), e / np.trace(cov)


@pytest.mark.parametrize("n,d,most", [(1, 1, 3), (65, 3, 1000), (200, 5, 1 << 20), (10, 2, 1 << 61)])
def test_block_sums_are_exact(n, d, most):
    x = np.random.default_rng(n).integers(-most, most, (n, d))
    s, g = w.block_sums(x)
    rows = x.astype(object)
    assert s.tolist() == rows.sum(axis=0).tolist() and (g == rows.T.dot(rows)).all()


def test_popcounts_of_planes():
    u = np.random.default_rng(3).integers(0, 64, (130, 4)).astype(np.uint64)
    p, bits = w.planes(u)
    plain = np.array([[(int(v) >> b & 1) for v in u[:, j]] for j in range(4) for b in range(bits)])
    assert bits == 6 and (w.shared_bits(p) == plain @ plain.T).all()


def test_packing_is_one_to_one():
    x = np.array([[0, -1, 127], [-128, 0, 0], [128, 0, 0], [-32769, 5, 1], [1 << 40, -(1 << 62), 0], [np.iinfo(np.int64).min, 0, np.iinfo(np.int64).max]])
    packed = w._packed(x)
    assert (w._unpacked(packed, 3) == x).all()
    assert (w._unpacked(pa.concat_arrays([packed, packed])[4:9], 3) == np.concatenate([x, x])[4:9]).all()


def test_sums_between_tasks_are_exact():
    values = [0, -1, 1 << 150, -(1 << 150), 12345678901234567890]
    parts = w._limbs(values)
    assert [sum(p[i].as_py() << 32 * k for k, p in enumerate(parts)) for i in range(len(values))] == values


@pytest.mark.parametrize("block", [w.BLOCK, 7])
def test_small_table_against_numpy(spark, monkeypatch, block):
    monkeypatch.setattr(w, "BLOCK", block)
    rng = np.random.default_rng(5)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(120, 6)) * [5, 4, 3, 2, 1, 0.5])]
    vectors += [(1000 + i, v) for i, v in vectors[:40]] + [(i, v) for i, v in vectors[:3]]  # copies and repeated rows
    got = w.whitened(_frame(spark, vectors).repartition(5)).toPandas()
    n, dev, z, explained = _plain([v for _, v in vectors])
    assert n == 120 and (got["n"] == n).all() and len(got) == 4 * len(vectors)
    assert got["identity_error"].max() < 1e-10
    for c in range(4):
        part = got[got["component"] == c + 1].set_index("vec_id")
        assert abs(part["explained"].iloc[0] - explained[c]) < 1e-12
        plain = {i: v for (i, _), v in zip(vectors, z[:, c])}
        sign = np.sign(part["whitened"].loc[1000] * plain[1000])
        assert all(abs(r - sign * plain[i]) < 1e-9 for i, r in part["whitened"].items())
        exact = {i: v for (i, _), v in zip(vectors, dev)}
        assert all(r == exact[i] for i, r in part["deviation"].items())


def test_rows_that_are_left_out(spark):
    good = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(1).normal(size=(20, 3)))]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (103, [1.0, float("inf"), 2.0]), (104, [1.0]), (105, [])]
    got = w.whitened(_frame(spark, good + bad + [(None, good[0][1])])).toPandas()
    assert set(got["vec_id"].dropna()) == set(range(20)) and got["vec_id"].isna().sum() == 3
    assert (got["n"] == 20).all() and sorted(set(got["component"])) == [1, 2, 3]


def test_no_variance_and_empty(spark):
    assert w.whitened(_frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert w.whitened(_frame(spark, [])).count() == 0
    line = w.whitened(_frame(spark, [(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [3.0, 6.0])])).toPandas()
    assert set(line["component"]) == {1} and abs(line["explained"] - 1).max() < 1e-12


def test_huge_entries(spark):
    vectors = [(i, [float(a), float(b)]) for i, (a, b) in enumerate([(2.0 ** 70, 1), (1e300, -3), (-1e300, 2), (0, 0), (2.0 ** 40, 7)])]
    got = w.whitened(_frame(spark, vectors)).toPandas()
    assert len(got) == 5 and (got["n"] == 5).all()  # the second component is within rounding of 0 beside the first
    assert got["deviation"].isna().any() and got["deviation_exact"].str.isdigit().all()


def test_given_table(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    got = w.whitened(table.select("vec_id", "embedding")).toPandas()
    vectors = dict(table.select("vec_id", "embedding").collect())
    n, dev, z, explained = _plain(list(vectors.values()))
    first = got[got["component"] == 1].set_index("vec_id").loc[list(vectors)]
    assert (first["n"] == n).all() and first["deviation"].tolist() == dev
    assert np.abs(np.abs(first["whitened"].to_numpy()) - np.abs(z[:, 0])).max() < 1e-8
    assert got["identity_error"].max() < 1e-8
