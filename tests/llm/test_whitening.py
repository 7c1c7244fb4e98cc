"""Whitening against exact integers and a plain eigendecomposition."""

from collections import Counter

import numpy as np
import pytest

from catalogloom.llm import bidiagonal, queries, whitening


def _spread(kind, rng):
    n = 24
    one, two = (np.linalg.qr(rng.standard_normal((n, n)))[0] for _ in range(2))
    values = {"random": rng.random(n), "equal": np.repeat([5.0, 2.0, 1.0], 8), "near": 1 + 1e-9 * np.arange(n),
              "near the limit": 1 + 1e-5 * np.arange(n), "graded": 10.0 ** -np.arange(n), "rank": np.repeat([3.0, 1.0, 0.0], 8)}[kind]
    return one * values @ two


@pytest.mark.parametrize("kind", ["random", "equal", "near", "near the limit", "graded", "rank"])
def test_singular_values_and_vectors(kind):
    for seed in range(5):
        r = _spread(kind, np.random.default_rng(seed))
        values, v = bidiagonal.decompose(r)
        true = np.linalg.svd(r, compute_uv=False) ** 2
        assert np.abs(values - true).max() <= 1e-13 * true[0]
        v, values = v[:, values > 0], values[values > 0]
        assert np.abs(v.T @ v - np.eye(len(values))).max() < 1e-11
        assert np.linalg.norm(r.T @ (r @ v) - v * values, axis=0).max() < 1e-13 * true[0]


def test_small_and_plain_matrices():
    assert bidiagonal.decompose(np.zeros((3, 3)))[0].tolist() == [0, 0, 0]
    assert np.allclose(bidiagonal.decompose(np.eye(4))[0], 1)
    values, v = bidiagonal.decompose(np.diag([3.0, 3.0, 1.0, 0.0]))
    assert values.tolist() == [9, 9, 1, 0] and np.allclose(v[:, :3].T @ v[:, :3], np.eye(3))
    diagonal, above, v = bidiagonal.bidiagonal(np.arange(16.0).reshape(4, 4))
    assert np.allclose(v.T @ v, np.eye(4))


def _expected(vectors, components):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = (n * fit - total) / n
    values, v = np.linalg.eigh(centred.T @ centred / n)
    values, v = values[::-1], v[:, ::-1]
    size = min(components, int((values > 1e-9 * values[0]).sum()))
    deviation = [sum(int(n * a - b) ** 2 for a, b in zip(row, total)) for row in x]
    return n, deviation, (n * x - total) / n @ (v[:, :size] / np.sqrt(values[:size])), values[:size] / values.sum()


def _agrees(rows, ids, vectors, components=16):
    n, deviation, whitened, explained = _expected(vectors, components)
    size = len(explained)
    found = {(r.vec_id, r.component): r for r in rows}
    assert len(rows) == len(found) == len(ids) * size
    z = np.array([[found[i, c + 1].whitened for c in range(size)] for i in ids])
    for c in range(size):
        assert min(np.abs(z[:, c] - whitened[:, c]).max(), np.abs(z[:, c] + whitened[:, c]).max()) < 1e-8
    for i, d in zip(ids, deviation):
        for c in range(size):
            r = found[i, c + 1]
            assert r.n == n and r.deviation == d and abs(r.explained / explained[c] - 1) < 1e-9 and r.identity_error < 1e-9


def test_query_equals_a_plain_version(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    _agrees(queries.op12_whitening(spark, sf).collect(), [r.vec_id for r in table], [r.embedding for r in table])


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, v) for i, v in enumerate(rng.standard_normal((40, 5)).tolist())]
    again = [(100 + i, good[0][1]) for i in range(60)]
    odd = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0, 4.0]), (903, [float("nan")] * 5), (904, [float("inf")] + [0.0] * 4),
           (905, [1.0, 2.0]), (906, [1e300] * 5)]
    schema = "vec_id long, embedding array<double>, n string, _x string, component string"
    df = spark.createDataFrame([(i, v, "clash", "clash", "clash") for i, v in good + again + odd], schema).repartition(7)
    made = whitening.whiten(df, components=3)
    assert made.columns == ["vec_id", "_x", *[f.split()[0] for f in whitening._NEW.split(", ")]]
    _agrees(made.collect(), [i for i, _ in good + again], [v for _, v in good + again], 3)


def test_tables_without_variance_give_no_rows(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.001, 2.001])]):
        made = whitening.whiten(frame(rows))
        assert made.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert made.count() == 0


def test_fewer_vectors_than_dimensions_and_repeats(spark):
    rows = [(1, [0.0, 1.0, 5.0, 2.0]), (2, [3.0, 1.0, 5.0, 2.5]), (2, [3.0, 1.0, 5.0, 2.5]), (None, [1.0, 0.5, 5.0, 2.0])]
    made = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert Counter((r.vec_id, r.component) for r in made) == Counter({(1, 1): 1, (1, 2): 1, (2, 1): 2, (2, 2): 2, (None, 1): 1, (None, 2): 1})
    assert all(r.n == 3 and r.identity_error < 1e-12 for r in made)


def test_factors_of_many_tasks_are_merged(spark):
    x = np.random.default_rng(5).integers(0, 50, (400, 6))
    fit = spark.createDataFrame([(row,) for row in x.tolist()], "_x array<long>").repartition(37)
    n, total = whitening._sums(fit, 6)
    assert n == 400 and total.tolist() == x.sum(axis=0).tolist()
    r = whitening._factor(fit, 6, n, total)
    centred = x - x.mean(axis=0)
    assert np.allclose(r.T @ r, centred.T @ centred)


def test_a_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [float(i) * 2.0 ** 30, 1.0]) for i in range(8)]
    made = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.deviation for r in made} == {None} and len(made) == 8
