"""Whitening against LAPACK's eigenvectors of the covariance worked out by hand."""

import math

import numpy as np
import pytest

from lingmill.llm import queries, whitening
from lingmill.llm.whitening import WhiteningOptions

SF = "/root/testdata/sf0.001"


def by_hand(vectors, k=16):
    """{vector: (deviation, whitened)} and explained, components up to sign."""
    x = np.array(sorted({tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for v in vectors}), dtype=object)
    n, sums = len(x), x.sum(axis=0)
    centred = np.array([[int(n * a - s) for a, s in zip(row, sums)] for row in x], dtype=float) / n
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:k]
    deviations = [sum(int(n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, x, deviations, centred @ vecs[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def test_against_lapack(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    vectors = {r["vec_id"]: r["embedding"] for r in table.collect()}
    n, x, deviations, want, explained = by_hand(vectors.values())
    at = {tuple(row): i for i, row in enumerate(x)}
    rows = queries.op13_feast_whitening(spark, SF).collect()
    assert len(rows) == 16 * len(vectors)
    got = np.zeros((len(x), 16))
    for r in rows:
        i = at[tuple(math.floor(64 * float(c)) + 1_000_000 for c in vectors[r["vec_id"]])]
        got[i, r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == deviations[i] and r["identity_error"] < 1e-9
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-10
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * signs).max() < 1e-7


@pytest.mark.parametrize("seed", range(5))
def test_inertia_counts_eigenvalues(seed):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    if seed == 0:
        np.fill_diagonal(a, 0)  # no single pivot will do at first
    values = np.linalg.eigvalsh(a)
    for shift in rng.uniform(values[0] - 1, values[-1] + 1, 20):
        assert whitening.positive_pivots(a - shift * np.eye(30)) == (values > shift).sum()
    assert whitening.positive_pivots(np.zeros((3, 3))) == 0


def test_quadrature_projects_onto_the_interval():
    values = np.array([1.0, 2.0, 3.0, 9.0, 20.0])
    base, _ = np.linalg.qr(np.random.default_rng(1).standard_normal((5, 5)))
    matrix = base @ np.diag(values) @ base.T
    kept = base.T @ whitening.contour_projection(matrix, 0.5, 3.5, np.eye(5), 16) @ base
    assert np.abs(kept - np.diag([1, 1, 1, 0, 0])).max() < 0.01


def sound_rows(spark, matrix):
    return spark.createDataFrame([([int(c) for c in row],) for row in matrix], "x array<bigint>")


@pytest.mark.parametrize("case", ["clustered", "equal", "on a cut", "low rank", "far apart"])
def test_hard_spectra(spark, case):
    rng = np.random.default_rng(5)
    if case == "equal":  # the same variance in all directions
        x = np.vstack([np.eye(12, dtype=int) * 5, -np.eye(12, dtype=int) * 5])
    elif case == "low rank":
        x = rng.integers(-9, 9, (50, 3)) @ rng.integers(-3, 3, (3, 20))
    elif case == "far apart":
        x = np.rint(rng.standard_normal((400, 20)) * 2.0 ** np.arange(20) / 10 + rng.standard_normal((400, 20))).astype(int)
    elif case == "clustered":
        x = np.rint(rng.standard_normal((3000, 24)) * 100).astype(int)
    else:  # whole eigenvalues
        x = np.vstack([np.diag(np.arange(1, 25)), -np.diag(np.arange(1, 25))])
    x = np.unique(x, axis=0)
    found = whitening.principal_components(sound_rows(spark, x + 1000), WhiteningOptions(components=10))
    centred = x - x.mean(axis=0)
    v = centred.T @ centred / len(x)
    values = np.sort(np.linalg.eigvalsh(v))[::-1]
    rank = min(10, (values > 1e-9 * values[0]).sum())
    assert len(found.values) == rank and np.allclose(found.values, values[:rank], rtol=1e-9, atol=1e-11 * values[0])
    assert np.abs(v @ found.vectors - found.vectors * found.values).max() < 1e-11 * values[0]
    assert np.abs(found.vectors.T @ found.vectors - np.eye(rank)).max() < 1e-12


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.1, 0.2]), (1, [0.1, 0.2]), (None, [0.5, -0.9]), (2, None), (3, [0.1, None]), (4, [nan, 1.0]), (5, [1.0, inf]),
        (6, [3.0, 2.0]), (7, [0.1001, 0.2001]), (8, []),
    ]
    table = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, n int, x double")
    found = whitening.whiten(table).collect()
    # rows 1 and 7 are the same vector in whole numbers
    assert sorted(str(r["vec_id"]) for r in found) == sorted(["1", "1", "1", "1", "7", "7", "None", "None", "6", "6"])
    assert {r["n"] for r in found} == {3} and max(r["identity_error"] for r in found) < 1e-10
    assert not whitening.whiten(table.limit(0)).collect()
    assert not whitening.whiten(table.filter("vec_id in (1, 7)")).collect()
    uneven = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        whitening.whiten(uneven)
