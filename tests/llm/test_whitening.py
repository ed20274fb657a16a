import math

import numpy as np
import pytest
from conftest import SF

from credence.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<double>, v string, d string, n string, component string"
EXTRA = ("x", None, "n", "1")


def brute(vectors, k=8):
    """(n, deviations, whitened up to sign, explained) by plain integer sums and a dense solver."""
    x = [[math.floor(1024 * c) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return n, deviation, centred @ vectors / np.sqrt(values), values / (centred ** 2).sum() * n


def agree(rows, vectors, k=8):
    n, deviation, w, explained = brute(list(vectors.values()), k)
    ids = list(vectors)
    assert len(rows) == len(ids) * len(explained)
    signs = {}
    for r in rows:
        i, c = ids.index(r.vec_id), r.component - 1
        assert (r.n, r.deviation, int(r.deviation_decimal)) == (n, deviation[i], deviation[i])
        assert r.explained == pytest.approx(explained[c], rel=1e-9)
        assert r.identity_error < 1e-9
        if abs(w[i, c]) > 1e-3:
            signs.setdefault(c, set()).add(np.sign(w[i, c]) == np.sign(r.whitened))
        assert abs(r.whitened) == pytest.approx(abs(w[i, c]), rel=1e-8, abs=1e-8)
    assert all(len(s) == 1 for s in signs.values())


def test_given_table_against_a_dense_solver(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = queries.op12_whitening(spark, SF).collect()
    assert len({r.identity_error for r in rows}) == 1
    agree(rows, {r.vec_id: r.embedding for r in table})


def test_bad_vectors_go_and_the_rest_is_fitted(spark):
    rng = np.random.default_rng(3)
    good = {i: (rng.standard_normal(5) * [4, 3, 2, 1, 1e-3] + [0, 9, -700, 0, 5e4]).tolist()
            for i in range(40)}
    good[40] = good[39]  # a repeated vector counts again
    bad = [None, [], [1.0] * 4, [1.0, None, 1.0, 1.0, 1.0], [math.nan] * 5,
           [1.0, 2.0, math.inf, 1.0, 1.0], [1e30, 0.0, 0.0, 0.0, 0.0]]
    rows = [(i, v, *EXTRA) for i, v in [*good.items(), *((100 + i, b) for i, b in enumerate(bad))]]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    agree(found, good)


def test_null_and_repeated_ids_are_rows(spark):
    rows = [(None, [0.0, 1.0], *EXTRA), (None, [5.0, 2.0], *EXTRA), (7, [1.0, 9.0], *EXTRA)]
    found = whitening.whiten(spark.createDataFrame(rows * 2, SCHEMA)).collect()
    assert sorted(str(r.vec_id) for r in found) == sorted(["None"] * 8 + ["7"] * 4)


@pytest.mark.parametrize("vectors", [[], [None], [[]], [[1.0, 2.0]], [[1.0, 2.0]] * 3])
def test_nothing_to_whiten(spark, vectors):
    rows = [(i, v, *EXTRA) for i, v in enumerate(vectors)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    assert found.collect() == [] and "deviation" in found.columns


def test_flat_directions_are_left_out(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0], *EXTRA) for i in range(9)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component for r in found} == {1}
    assert found[0].explained == pytest.approx(1)


def test_deviation_beyond_a_long(spark):
    rows = [(i, [(-1) ** i * 4e12, float(i)], *EXTRA) for i in range(4)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r.deviation is None and int(r.deviation_decimal) > 1 << 63 for r in found)


@pytest.mark.parametrize("matrix", [
    np.diag([3.0, 3, 3, 2, 1, 0, 0]), np.ones((5, 5)), np.array([[2.0]]), np.array([[2.0, 1], [1, 2]]),
    np.eye(12), np.diag([1.0, 1 + 1e-13, 1 - 1e-13, 0.5]),
    np.kron(np.eye(3), [[2.0, 1, 0], [1, 2, 1], [0, 1, 2]])])
def test_solver_on_clusters(matrix):
    values, vectors = whitening.leading(matrix, 8)
    expected = np.linalg.eigvalsh(matrix)[::-1][:len(values)]
    assert np.allclose(values, expected, rtol=0, atol=1e-14 * expected[0] * len(matrix))
    assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-13)
    assert np.allclose(matrix @ vectors.T, vectors.T * values, atol=1e-13 * expected[0])
    assert (np.linalg.eigvalsh(matrix)[::-1][len(values):8] < 1e-9).all()
