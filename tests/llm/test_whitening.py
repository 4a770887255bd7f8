"""Whitening by Jacobi-Davidson against numpy's dense eigensolver."""

import math

import numpy as np
import pytest

from ferrytally.llm import whitening as wh

SCHEMA = "vec_id bigint, embedding array<float>, x string, n int, component string, i int"


def grid_of(vector):
    return tuple(math.floor(64 * c) + 1_000_000 for c in vector)


def usable(vector):
    return vector is not None and len(vector) > 0 and all(c is not None and math.isfinite(c) for c in vector)


def check(spark, rows, components=16):
    """Every output column from the dense covariance of the distinct grid vectors."""
    frame = spark.createDataFrame([(i, v, "x", 1, "c", 2) for i, v in rows], SCHEMA).repartition(5)
    solver = wh.Solver(components=components)
    got = wh.whitened(frame, solver=solver).collect()
    assert got[0].asDict().keys() == {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    rows = [(i, grid_of(np.float32(v).astype(float))) for i, v in rows if usable(v)]
    fit = sorted({x for _, x in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array(fit, float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    trace, count = values.sum(), min(components, len(sums))
    values = values[::-1][:count]
    assert sorted({r["component"] for r in got}) == list(range(1, int((values > 1e-12 * trace).sum()) + 1))
    by_row = {}
    for r in got:
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert abs(r["explained"] - values[r["component"] - 1] / trace) < 1e-10
        by_row.setdefault(r["component"], []).append((r["vec_id"], r["deviation"], r["whitened"]))
    whole = {}
    for i, x in rows:
        away = np.array(x) - np.array(sums) / n
        whole.setdefault((i, sum((n * c - s) ** 2 for c, s in zip(x, sums))), []).append(away)
    for component, found in by_row.items():
        assert len(found) == len(rows)
        # Whatever the sign: squares of the projections on dense eigenvectors, where the eigenvalue stands alone.
        gap = np.abs(np.delete(values, component - 1) - values[component - 1]).min(initial=np.inf)
        if count == len(sums) and gap > 1e-3 * trace:
            v = vectors[:, ::-1][:, component - 1] / math.sqrt(values[component - 1])
            want = sorted((abs(float(a @ v)) for _, w in whole.items() for a in w))
            assert np.allclose(sorted(abs(w) for *_, w in found), want, atol=1e-7)
        assert sorted((str(i), d) for i, d, _ in found) == sorted((str(i), d) for (i, d), w in whole.items() for _ in w)
    return got


def test_against_dense_with_repeats_and_unusable_rows(spark):
    rng = np.random.default_rng(4)
    scale = np.array([5, 3, 2, 1, 0.5, 0.2])
    vectors = [[float(c) for c in v] for v in rng.standard_normal((300, 6)) * scale]
    rows = [(i, v) for i, v in enumerate(vectors)]
    rows += [(i, vectors[0]) for i in range(1000, 1200)]  # one vector of many rows counts once
    rows += [(None, vectors[1]), (7, vectors[2]), (7, vectors[2])]
    rows += [(2000, None), (2001, []), (2002, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2003, [math.nan] * 6), (2004, [math.inf] * 6), (2005, [1.0] * 6)]
    check(spark, rows)


def test_more_dimensions_than_components(spark):
    rng = np.random.default_rng(5)
    got = check(spark, [(i, [float(c) for c in v]) for i, v in enumerate(rng.standard_normal((200, 40)))])
    assert len(got) == 200 * 16


def test_components_without_variance_are_left_out(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(a), float(b), float(a), 1.0]) for i, (a, b) in enumerate(rng.integers(-9, 9, (50, 2)))]
    assert {r["component"] for r in check(spark, rows)} == {1, 2}


def test_tables_without_variance_are_empty(spark):
    for rows in ([], [(1, None)], [(1, []), (2, [])], [(1, [1.0, 2.0])] * 3):
        frame = spark.createDataFrame([(i, v, "x", 1, "c", 2) for i, v in rows], SCHEMA)
        found = wh.whitened(frame)
        assert found.count() == 0 and "whitened" in found.columns


def test_other_lengths_are_dropped(spark):
    rows = [(i, [float(i % 7), float(i % 5)]) for i in range(20)] + [(99, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame([(i, v, "x", 1, "c", 2) for i, v in rows], SCHEMA)
    assert {r["vec_id"] for r in wh.whitened(frame).collect()} == set(range(20))


def test_huge_values_have_exact_deviations():
    x = np.array([[1 << 40, 3], [5, -(1 << 40)]])
    sums = [int(c) for c in x.sum(axis=0)]
    want = [sum((2 * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    assert wh.deviations(x, 2, sums).to_pylist() == [w if w < 1 << 63 else None for w in want]
    small = np.array([[3, 4], [5, 9]])
    assert wh.deviations(small, 2, [8, 13]).to_pylist() == [4 + 25, 4 + 25]


@pytest.mark.parametrize("size", [1, 5, 30, 150])
def test_eigenpairs(size):
    """Close, repeated and tiny eigenvalues."""
    rng = np.random.default_rng(size)
    q = np.linalg.qr(rng.standard_normal((size, size)))[0]
    values = np.sort(np.round(rng.random(size), 1) + 1e-6 * rng.random(size))[::-1]
    matrix = (q * values) @ q.T
    found, vectors = wh.eigenpairs(lambda block: matrix @ block, size)
    assert np.allclose(found, values[: len(found)], atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12
    assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-10)


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(9)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    rhs = rng.standard_normal((30, 4))
    assert np.allclose(a @ wh.minres(lambda v: a @ v, rhs, 60), rhs, atol=1e-6)
