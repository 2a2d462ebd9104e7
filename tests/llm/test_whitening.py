"""Whitening against numpy's eigenvectors, exact counts of roots, and odd vectors."""

from __future__ import annotations

from fractions import Fraction

import duckdb
import numpy as np
import pytest

from tests.conftest import SF
from tests.llm.conftest import rows_of
from tripmill.llm import whitening
from tripmill.llm.queries import QUERIES


def brute(vectors: np.ndarray, most: int):
    """Distinct integer vectors, their mean, and eigenvalues and axes of their covariance by numpy."""
    x = np.floor(64 * vectors) + 1_000_000
    distinct = np.unique(x, axis=0)
    values, axes = np.linalg.eigh(np.cov(distinct.T, bias=True))
    return x, distinct, values[::-1][:most], axes[:, ::-1][:, :most]


def test_query_equals_numpy(spark):
    found = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY 1").fetchall()
    x, distinct, values, axes = brute(np.array([v for _, v in found], dtype=np.float64), 16)
    want = (x - distinct.mean(0)) @ axes / np.sqrt(values)
    n = len(distinct)
    deviation = ((n * x - distinct.sum(0)) ** 2).sum(1)
    got = sorted(rows_of(QUERIES["op11_whitening"](spark, SF)), key=lambda r: (r["vec_id"], r["component"]))
    assert [(r["vec_id"], r["component"]) for r in got] == [(i, k) for i, _ in found for k in range(1, 17)]
    mine = np.array([r["whitened"] for r in got]).reshape(want.shape)
    assert np.abs(np.abs(mine) - np.abs(want)).max() < 1e-9
    assert np.abs((mine * want).sum(0)).min() > 0.9 * n  # one sign for all rows
    assert [r["deviation"] for r in got[::16]] == deviation.astype(int).tolist() == [int(r["deviation_exact"]) for r in got[::16]]
    assert {r["n"] for r in got} == {n} and {r["identity_error"] for r in got} < {r["identity_error"] for r in got} | {1e-4}
    assert got[0]["identity_error"] < 1e-9
    of = np.cov(distinct.T, bias=True).trace()
    assert np.allclose([r["explained"] for r in got[:16]], values / of, rtol=1e-9)


@pytest.mark.parametrize("seed", range(4))
def test_polynomial_and_roots_are_exact(spark, seed):
    rng = np.random.default_rng(seed)
    d = 7
    basis = rng.integers(-5, 6, (d, d if seed else 4)).astype(object)
    matrix = basis @ basis.T  # of rank 4 for the first seed
    got = whitening.characteristic_polynomial(spark, matrix)
    # Faddeev and Le Verrier, in fractions.
    want, m = [Fraction(1)], np.zeros((d, d), dtype=object)
    for k in range(1, d + 1):
        m = matrix @ m + want[-1] * np.eye(d, dtype=int).astype(object)
        want.append(Fraction(-1, k) * (matrix @ m).trace())
    assert got == want
    values = np.linalg.eigvalsh(matrix.astype(float))[::-1]
    for at in (0, 1, 10, 100):
        assert whitening.roots_above(got, at) == (values > at + 1e-9).sum()
    roots, scale = whitening.largest_roots(got, 16)
    assert sum(n for _, n, _ in roots) == (d if seed else 4)
    assert np.allclose([v / 2**scale for _, n, v in roots for _ in range(n)], values[values > 1e-6])


def test_equal_and_close_eigenvalues(spark):
    # Signed unit vectors: the covariance is a multiple of the identity in 3 dimensions and twice that in a fourth.
    points = [[s * a * (i == j) for j in range(4)] for i in range(4) for s in (1, -1) for a in ([1.0] if i < 3 else [2.0**0.5])]
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(points)], "vec_id long, embedding array<double>")
    got = rows_of(whitening.whiten(rows))
    assert len(got) == 8 * 4 and got[0]["identity_error"] < 1e-12
    shares = sorted({r["component"]: r["explained"] for r in got}.items())
    assert shares[0][1] > shares[1][1] == shares[2][1] == shares[3][1]
    # Two eigenvalues a relative 10^-12 apart, far below what doubles tell of their axes.
    big = 10**12
    matrix = np.array([[big, 1], [1, big]], dtype=object)
    roots, scale = whitening.largest_roots([1, -2 * big, big * big - 1], 2)
    assert [n for _, n, _ in roots] == [1, 1]
    axes = np.vstack([whitening.null_vectors(matrix, Fraction(v, 2**scale), 1) for _, _, v in roots])
    assert np.allclose(np.abs(axes), 0.5**0.5, atol=1e-15) and abs(axes[0] @ axes[1]) < 1e-15


def test_limbs_are_exact():
    rng = np.random.default_rng(1)
    rows = rng.integers(-(1 << 62), 1 << 62, (50, 3))
    assert (whitening.scatter(rows) == rows.T.astype(object) @ rows.astype(object)).all()
    packed = whitening.to_bytes(np.array([[1, 0], [300, 2], [0, 0], [1, 0], [-128, 1], [1 << 40, 5]]))
    assert packed[0] == packed[3] == b"\x01\x01" and packed[2] == b"\x01" and len(set(packed)) == 5
    found = [tuple(r) for m in whitening.from_bytes(packed) for r in m.tolist()]
    assert sorted(found) == sorted([(1,), (300, 2), (), (1,), (-128, 1), (1 << 40, 5)])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0]), (2, [0.5, -2.0, 1.0]), (None, [2.0, 0.25, -1.0]), (3, None), (4, [1.0, None, 2.0]),
        (5, [nan, 1.0, 1.0]), (6, [1.0, -inf, 1.0]), (7, [1.0]), (8, []), (9, [0.0, 0.0, 0.0]), (10, [1.0, 1e3, 0.0]), (11, [1.0, 0.0, 0.0, 0.0]),
    ]
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").selectExpr("*", "'extra' AS id", "'extra' AS n", "'extra' AS component")
    got = rows_of(whitening.whiten(rows))
    assert sorted({(r["id"] is None, r["id"]) for r in got if r["id"]}) == [(False, i) for i in (1, 2, 7, 8, 9, 10, 11)]
    assert len(got) == 9 * 3 and {r["n"] for r in got} == {6}  # 1 = 2, 7 = 11 and 8 = 9 in the fit
    by = {(r["id"], r["component"]): r["whitened"] for r in got}
    assert by[7, 1] == by[11, 1] and by[8, 2] == by[9, 2] and max(r["identity_error"] for r in got) < 1e-9
    # Beyond a long: the exact value stays.
    far = spark.createDataFrame([(1, [1e15, 0.0]), (2, [-1e15, 1.0]), (3, [5.0, 1e300])], "vec_id long, embedding array<double>")
    got = rows_of(whitening.whiten(far))
    assert len(got) == 6 and {r["deviation"] for r in got} == {None} and {r["deviation_exact"] for r in got if r["id"] == 1} != {None}
    for none in (rows.limit(0), rows.where("vec_id = 1"), rows.where("vec_id IN (3, 4)")):
        assert rows_of(whitening.whiten(none)) == []
    with pytest.raises(ValueError):
        whitening.whiten(spark.range(1))
