"""Spectrum slicing against the library, whitening against exact fractions."""

from fractions import Fraction

import numpy as np
import pytest

from rowferry.llm import whitening
from rowferry.llm.common import prepare
from rowferry.llm.spectrum import above, certified, leading

RANDOM = np.random.default_rng(3)


def symmetric(values):
    axes = np.linalg.qr(RANDOM.standard_normal((len(values), len(values))))[0]
    return (axes * np.array(values, float)) @ axes.T


@pytest.mark.parametrize("matrix", [
    np.cov(RANDOM.standard_normal((200, 24)).T), symmetric([9, 9, 9, 4, 4, 2, 1, 0, 0, 0]), symmetric([5, -3, -3, 2, 1e-9]),
    np.diag([3.0] * 10), np.array([[0.0, 2.0], [2.0, 0.0]]), np.zeros((3, 3)), np.array([[7.0]]),
    np.cov(RANDOM.standard_normal((4, 30)).T) * 1e6, symmetric([1, 1 - 1e-9, 1 - 2e-9, 0.5, 0.1]),
])
def test_slices_find_the_leading_eigenvalues(matrix):
    values, axes = leading(matrix, 8)
    scale = max(np.abs(matrix).max(), 1e-300)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:8], atol=1e-12 * scale, rtol=0)
    assert np.allclose(axes.T @ axes, np.eye(axes.shape[1]), atol=1e-12)
    assert np.allclose(matrix @ axes, axes * values, atol=1e-11 * scale)


def test_inertia_counts_and_certificates():
    matrix = symmetric([6, 5, 3, -1, -2])
    assert [above(matrix, shift) for shift in (7, 5.5, 4, 0, -1.5, -3)] == [0, 1, 2, 3, 4, 5]
    assert certified(matrix, 3, 3) and not certified(matrix, 3, 2) and not certified(matrix, 4, 3)


def brute(vectors):
    """Count, deviation of each vector, and the exact covariance as doubles."""
    whole = [[int(np.floor(1024 * float(c))) + 100_000 for c in vector] for vector in vectors]
    count, width = len(whole), len(whole[0])
    sums = [sum(row[i] for row in whole) for i in range(width)]
    centred = [[Fraction(row[i]) - Fraction(sums[i], count) for i in range(width)] for row in whole]
    covariance = [[float(sum(row[i] * row[j] for row in centred) / count) for j in range(width)] for i in range(width)]
    deviation = [sum((count * row[i] - sums[i]) ** 2 for i in range(width)) for row in whole]
    return deviation, np.array(covariance), np.array([[float(c) for c in row] for row in centred])


def test_whitening_against_exact_fractions(spark, rows):
    prepare(spark)
    vectors = (RANDOM.standard_normal((60, 12)) * RANDOM.uniform(0.1, 3, 12)).astype(np.float32).tolist()
    bad = [None, [], [1.0] * 11, [None] + [1.0] * 11, [float("nan")] * 12, [float("inf")] + [0.0] * 11, [3e38] * 12]
    data = [(i, vector, 1, "x") for i, vector in enumerate(vectors + vectors[:3])] + [(900 + i, vector, None, "y") for i, vector in enumerate(bad)]
    table = rows("vec_id bigint, embedding array<float>, label int, n string", *data)
    found = whitening.whitened(table).collect()
    deviation, covariance, centred = brute(vectors + vectors[:3])
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    wanted = centred @ axes / np.sqrt(values)
    assert len(found) == 63 * 8 and {row.vec_id for row in found} == set(range(63))
    made = np.zeros((63, 8))
    for row in found:
        made[row.vec_id, row.component - 1] = row.whitened
        assert (row.n, row.deviation) == (63, deviation[row.vec_id])
        assert abs(row.explained - values[row.component - 1] / np.trace(covariance)) < 1e-12
        assert row.identity_error < 1e-9
    assert np.allclose(made * np.sign((made * wanted).sum(axis=0)), wanted, atol=1e-9)


@pytest.mark.parametrize("vectors, size", [([], 0), ([None, []], 0), ([[1.0, 2.0]] * 4, 0), ([[1.0], [2.0]], 2), ([[0.0, 1.0], [2.0, 3.0]], 2)])
def test_few_or_equal_vectors(spark, rows, vectors, size):
    prepare(spark)
    found = whitening.whitened(rows("vec_id int, embedding array<double>", *[(None, vector) for vector in vectors])).collect()
    assert len(found) == size and all(abs(abs(row.whitened) - 1) < 1e-9 for row in found)


def test_large_entries_stay_exact_or_null(spark, rows):
    prepare(spark)
    small = rows("vec_id int, embedding array<double>", (1, [1e6, 2.0]), (2, [-1e6, 2.5]))
    assert {row.deviation for row in whitening.whitened(small).collect()} == {(2 * 1024 * 10 ** 6) ** 2 + 512 ** 2}
    large = rows("vec_id int, embedding array<double>", (1, [1e14, 2.0]), (2, [-1e14, 2.5]))
    found = whitening.whitened(large).collect()
    assert [row.deviation for row in found] == [None, None] and all(abs(abs(row.whitened) - 1) < 1e-9 for row in found)


def test_given_table(spark, sf):
    found = whitening.op13_embedding_whitening(spark, sf).toPandas()
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x = np.floor(1024 * np.stack(vectors.embedding).astype(float)) + 100_000
    values = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    assert len(found) == 8 * len(vectors) and found.identity_error.max() < 1e-4
    first = found.groupby("component").explained.first().to_numpy()
    assert np.allclose(first, values[:8] / values.sum(), rtol=1e-9)
