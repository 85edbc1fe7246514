"""Whitening against numpy's eigenvectors, the solver alone, and odd inputs."""

import duckdb
import numpy as np
import pytest

from arenalake.llm import bidiagonal, whitening
from arenalake.llm.queries import op13_whitening


def plain(x, components=8):
    """By the covariance matrix and numpy's solver."""
    n = len(x)
    y = x - x.mean(0)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)[:components]
    return y @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def test_query_against_numpy(spark):
    for sf in ("sf0.001", "sf0.1"):
        folder = f"/root/testdata/{sf}"
        rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{folder}/embeddings.parquet' ORDER BY vec_id").fetchall()
        x = np.floor(1024 * np.array([r[1] for r in rows], np.float32).astype(float)).astype(np.int64) + 100_000
        n, sums = len(x), x.sum(0)
        white, explained = plain(x.astype(float))
        deviations = ((n * x - sums) ** 2).sum(1).tolist()
        got = op13_whitening(spark, folder).orderBy("vec_id", "component").collect()
        assert len(got) == 8 * n
        table = np.array([r["whitened"] for r in got]).reshape(n, 8)
        signs = np.sign((table * white).sum(0))
        assert np.abs(table * signs - white).max() < 1e-8
        assert [r["deviation"] for r in got[::8]] == deviations and {r["n"] for r in got} == {n}
        assert np.allclose([r["explained"] for r in got[:8]], explained, rtol=1e-9)
        assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def check_solver(x, count, rank=None):
    r = np.linalg.qr(x, mode="r")
    values, vectors, trace = bidiagonal.directions(r, count)
    gram = x.T @ x
    expected = np.linalg.eigvalsh(gram)[::-1]
    assert len(values) == (count if rank is None else min(count, rank))
    assert np.abs(values - expected[: len(values)]).max() <= 1e-12 * expected[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(gram @ vectors - vectors * values).max() <= 1e-12 * expected[0]
    assert trace == pytest.approx(np.trace(gram), rel=1e-12)


def test_solver_on_hard_spectra():
    random = np.random.default_rng(3)
    centres = random.normal(size=(10, 64))
    turn, _ = np.linalg.qr(random.normal(size=(64, 64)))
    check_solver(random.normal(size=(500, 64)), 64)
    check_solver(centres[random.integers(0, 10, 900)] + 0.3 * random.normal(size=(900, 64)), 12)
    check_solver(centres[random.integers(0, 10, 900)], 64, rank=10)
    check_solver(random.normal(size=(3, 64)), 8, rank=3)
    check_solver(np.vstack([np.eye(64)] * 5), 8)
    check_solver(np.diag(np.repeat([5.0, 3, 1, 0.1], 16)) @ turn, 30)  # equal values
    check_solver(random.normal(size=(50, 1)), 8, rank=1)
    check_solver(1e-140 * random.normal(size=(50, 7)), 3)
    wilkinson = np.diag(np.abs(np.arange(21) - 10.0)) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    check_solver(np.linalg.cholesky(wilkinson + 15 * np.eye(21)).T, 21)


def test_dqds_keeps_small_values_accurate():
    diagonal, above = np.array([1.0, 1e-3, 1e-7, 1e-12]), np.array([0.5, 1e-4, 1e-8])
    found = bidiagonal.dqds(diagonal, above)
    assert np.prod(found) == pytest.approx(float(np.prod(diagonal**2)), rel=1e-12)  # the determinant
    assert found[0] == pytest.approx(float(np.linalg.eigvalsh(np.diag(diagonal).T @ np.diag(diagonal) + 0)[-1]), rel=1)


def whitened(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, x array<long>, n string, component string")
    return whitening.whiten(frame, "x", "vec_id", components=2).collect()


def test_odd_rows(spark):
    base = [(k, [k, 7 * k % 5, 3], "clash", "clash") for k in range(40)]
    odd = [(None, [3, 1, 3], "", ""), (100, None, "", ""), (101, [1, None, 3], "", ""), (102, [], "", ""), (103, [4], "", ""), (5, [5, 0, 3], "", "")]
    got = whitened(spark, base + odd)
    assert {r["vec_id"] for r in got} == {*range(40), None} and {r["n"] for r in got} == {42}
    assert len(got) == 84  # the third dimension is constant, and repeated rows all count
    assert got[0]["identity_error"] < 1e-12


def test_nothing_to_whiten(spark):
    assert whitened(spark, []) == []
    assert whitened(spark, [(1, None, "", ""), (2, [], "", "")]) == []
    assert whitened(spark, [(k, [4, 4], "", "") for k in range(5)]) == []  # no variance
    assert len(whitened(spark, [(1, [0, 0], "", ""), (2, [3, 4], "", "")])) == 2  # one direction


def test_deviations_are_exact_or_raise():
    big = np.array([[3_000_000_001, 1], [1, 1]], np.int64)
    model = whitening.Whitening(1, np.array([1, 1]), np.ones(1), np.ones((2, 1)), 1.0)
    assert model.deviations(big)[0] == 3_000_000_000**2
    with pytest.raises(OverflowError):
        whitening.Whitening(2, np.array([1, 1]), np.ones(1), np.ones((2, 1)), 1.0).deviations(big)
    x = np.array([[100_003], [99_999]], np.int64)
    assert whitening.centred(x, 3, np.array([300_001]))[0, 0] == pytest.approx(8 / 3, abs=1e-15)


def test_blocks_and_merges_give_one_factor(spark):
    random = np.random.default_rng(5)
    x = random.integers(-50, 50, (3000, 5))
    frame = spark.createDataFrame([(v.tolist(),) for v in x], "x array<long>").repartition(23)
    r = whitening.triangular_factor(frame, "x", 5, 3000, x.sum(0), fan_in=3)
    y = x - x.mean(0)
    assert np.allclose(r.T @ r, y.T @ y, rtol=1e-12)
