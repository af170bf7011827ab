"""Whitening against a dense eigensolver."""

import numpy as np
import pytest

from gladwire.llm import whitening
from gladwire.llm.queries import QUERIES

SCHEMA = "vec_id long, vector array<long>, deviation string"


def whitened(spark, rows, components=32):
    blocks, size = whitening.packed(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA))
    model, covariance = whitening.fit(blocks, size, components)
    return model, whitening.identity_error(covariance, model), whitening.apply(blocks, model).collect()


def drawn(seed, n, size, offset=10**6):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, size)) @ np.diag(np.linspace(40, 3, size)) @ np.linalg.qr(rng.normal(size=(size, size)))[0]
    return np.floor(x).astype(np.int64) + offset


@pytest.mark.parametrize("size,components", [(12, 4), (20, 32)])
def test_against_a_dense_solver(spark, size, components):
    x = drawn(size, 500, size)
    model, error, rows = whitened(spark, [(i, v.tolist()) for i, v in enumerate(x)], components)
    k = min(size, components)
    centred = x - x.sum(0) / len(x)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    assert np.allclose(model.values, values, rtol=1e-12) and model.residuals.max() < 1e-13 * values[0]
    assert np.allclose(model.explained, values / (centred**2).sum() * len(x), rtol=1e-12) and error < 1e-10
    got = np.array([r.whitened for r in sorted(rows, key=lambda r: r.vec_id)])
    want = centred @ vectors / np.sqrt(values)
    want *= np.sign((got * want).sum(0))
    assert np.allclose(got, want, atol=1e-9)
    exact = ((x * len(x) - x.sum(0)) ** 2).sum(1)
    assert [r.deviation for r in sorted(rows, key=lambda r: r.vec_id)] == exact.tolist()


@pytest.mark.parametrize("size,wanted,decay", [(150, 20, 1.0), (150, 20, 0.1), (60, 60, 1.0), (90, 32, 0.0)])
def test_solver_on_wide_operators(size, wanted, decay):
    """Search spaces smaller than the whole: inner steps, locking and restarts are needed."""
    rng = np.random.default_rng(size + wanted)
    q = np.linalg.qr(rng.normal(size=(size, size)))[0]
    spectrum = np.sort(rng.uniform(1, 2, size) * np.exp(-decay * np.arange(size) / 10))[::-1] if decay else np.ones(size)
    matrix = q * spectrum @ q.T
    values, vectors, residuals = whitening.largest_pairs(lambda t: matrix @ t, size, wanted)
    assert np.allclose(values, spectrum[:wanted], rtol=0, atol=1e-13 * spectrum[0])
    assert residuals.max() < 1e-13 * spectrum[0]
    assert np.allclose(vectors.T @ vectors, np.eye(vectors.shape[1]), atol=1e-13)


def test_corrections_solve_their_equations():
    rng = np.random.default_rng(5)
    matrix = rng.normal(size=(15, 15))
    matrix = matrix + matrix.T
    locked = np.linalg.qr(rng.normal(size=(15, 2)))[0]
    ritz = rng.normal(size=(15, 3))
    ritz -= locked @ (locked.T @ ritz)
    ritz /= np.linalg.norm(ritz, axis=0)
    residuals, shifts = rng.normal(size=(15, 3)), np.array([0.3, -2.0, 5.0])
    found = whitening.corrections(lambda t: matrix @ t, shifts, ritz, residuals, locked, 40)
    for j in range(3):
        both = np.linalg.qr(np.column_stack([locked, ritz[:, j]]))[0]
        off = np.eye(15) - both @ both.T
        assert np.allclose(off @ (matrix - shifts[j] * np.eye(15)) @ found[:, j], -off @ residuals[:, j], atol=1e-8)


def test_odd_rows(spark):
    x = drawn(3, 60, 4)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    plain_model, _, plain = whitened(spark, rows)
    odd = [(None, None), (61, []), (62, [1, None, 3, 4]), (63, [1, 2, 3])]
    model, _, found = whitened(spark, rows + odd)
    assert model.n == 60 and len(found) == 60 and np.allclose(model.values, plain_model.values)
    again = whitened(spark, rows + [(None, rows[0][1]), rows[0]])
    assert again[0].n == 62 and sorted(r.vec_id is None for r in again[2]) == [False] * 61 + [True]
    assert whitened(spark, [])[2] == []
    for same in ([(1, [5, 5])], [(1, [7, 7]), (2, [7, 7])]):
        model, error, found = whitened(spark, same)
        assert len(model.values) == 0 and error == 0 and [(r.deviation, r.whitened) for r in found] == [(0, [])] * len(same)


def test_few_directions_and_large_entries(spark):
    rng = np.random.default_rng(9)
    line = np.outer(rng.integers(-50, 50, 40), [1, 2, 0, -1]) + 10**6
    model, error, found = whitened(spark, [(i, v.tolist()) for i, v in enumerate(line)])
    assert len(model.values) == 1 and error < 1e-12 and np.isclose(model.explained[0], 1)
    big = [(0, [1 << 60, 0]), (1, [0, 5]), (2, [-(1 << 60), 9])]
    model, _, found = whitened(spark, big)
    assert {r.deviation for r in found} >= {None} and len(model.values) >= 1


def test_query_against_a_dense_solver(spark):
    import duckdb

    sf_dir = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf_dir}/embeddings.parquet' ORDER BY vec_id").fetchall()
    x = np.floor(64 * np.array([r[1] for r in rows])).astype(np.int64) + 10**6
    centred = x - x.sum(0) / len(x)
    values = np.linalg.eigvalsh(centred.T @ centred / len(x))[::-1][:32]
    got = QUERIES["op11_whitening"](spark, sf_dir)
    assert got.dtypes == [
        ("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
        ("explained", "double"), ("identity_error", "double"),
    ]
    table = got.orderBy("vec_id", "component").toPandas()
    assert len(table) == 32 * len(rows) and table.identity_error.nunique() == 1 and table.identity_error[0] < 1e-10
    assert np.allclose(table.explained[:32], values / (centred**2).sum() * len(x), rtol=1e-12)
    z = table.whitened.to_numpy().reshape(-1, 32)
    assert np.allclose(z.T @ z / len(z), np.eye(32), atol=1e-10)
    assert table.deviation.to_numpy()[::32].tolist() == ((x * len(x) - x.sum(0)) ** 2).sum(1).tolist()
