"""Whitening against numpy's own eigenvectors."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from medallion.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n int"


def frame(spark, vectors, kind="float"):
    rows = [(i, None if v is None else [c if c is None else float(c) for c in v], 1, "clash", 2) for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA.replace("float", kind))


def brute(vectors):
    """n, exact deviations, eigenvalues and whitened rows of clean vectors of one length."""
    grid = {i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for i, v in vectors}
    fit = sorted(set(map(tuple, grid.values())))
    n, sums = len(fit), [sum(column) for column in zip(*fit, strict=True)]
    points = np.array([[float(Fraction(n * x - s, n)) for x, s in zip(v, sums, strict=True)] for v in fit])
    values, axes = np.linalg.eigh(points.T @ points / n)
    values, axes = values[::-1], axes[:, ::-1]
    deviations = {i: sum((n * x - s) ** 2 for x, s in zip(v, sums, strict=True)) for i, v in grid.items()}
    centred = {i: np.array([float(Fraction(n * x - s, n)) for x, s in zip(v, sums, strict=True)]) for i, v in grid.items()}
    return n, deviations, values, {i: v @ axes / np.sqrt(np.maximum(values, 1e-300)) for i, v in centred.items()}


def close_to_brute(spark, vectors, most=16):
    n, deviations, values, rows = brute(vectors)
    found = whitening.whitened(frame(spark, vectors), most).collect()
    width = min(most, len(values))
    assert len(found) == len(vectors) * width
    signs = {}
    for row in sorted(found, key=lambda row: -abs(row["whitened"])):
        k = row["component"] - 1
        sign = signs.setdefault(k, math.copysign(1, row["whitened"] * rows[row["vec_id"]][k]))
        assert row["n"] == n and row["deviation"] == deviations[row["vec_id"]]
        assert row["whitened"] == pytest.approx(sign * rows[row["vec_id"]][k], rel=1e-8, abs=1e-8)
        assert row["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9)
        assert row["identity_error"] < 1e-9
    assert set(signs) == set(range(width))


def test_against_numpy(spark):
    draw = np.random.default_rng(1)
    vectors = [(k, v) for k, v in enumerate(draw.standard_normal((700, 24)) * np.linspace(1, 3, 24))]
    vectors += [(1_000 + k, vectors[5][1]) for k in range(400)]  # a vector that holds a third of the rows
    close_to_brute(spark, vectors)


def test_few_dimensions(spark):
    draw = np.random.default_rng(2)
    close_to_brute(spark, list(enumerate(draw.standard_normal((50, 3)) * [1, 5, 9])))


@pytest.mark.parametrize("values", [
    np.linspace(1, 2, 64),
    np.r_[np.ones(30), 5, 6, np.full(8, 3.0)],
    np.r_[1e-9, 1e-3, 1, 1e6],
    np.r_[np.zeros(10), 1.0],
    np.full(7, 2.5),
    np.r_[1.0, 1.0 + 1e-9, 1.0 + 2e-9, 4.0],
    np.r_[1e-200, 1e-199],
])
def test_eigenpairs(values):
    draw = np.random.default_rng(3)
    basis, _ = np.linalg.qr(draw.standard_normal((len(values), len(values))))
    matrix = basis * values @ basis.T
    matrix = (matrix + matrix.T) / 2
    found, axes = whitening.eigenpairs(matrix, len(values))
    scale = values.max()
    assert np.allclose(found, np.sort(values)[::-1], rtol=0, atol=1e-13 * scale)
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-13
    assert np.abs(matrix @ axes - axes * found).max() < 1e-13 * scale


def test_leading_pairs_only():
    values = np.linspace(1, 2, 64)
    found, axes = whitening.eigenpairs(np.diag(values), 16)
    assert len(found) >= 16 and np.allclose(found[:16], values[::-1][:16], rtol=1e-14)


def test_edge_cases(spark):
    assert whitening.whitened(frame(spark, [])).count() == 0
    assert whitening.whitened(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no variance at all
    bad = [(90, None), (91, []), (92, [1.0, None]), (93, [float("nan"), 1.0]), (94, [float("inf"), 1.0]), (95, [1.0, 2.0, 3.0])]
    good = [(None, [0.0, 1.0]), (2, [1.0, 1.0]), (2, [3.0, 1.0]), (3, [3.0, 1.0])]
    rows = whitening.whitened(frame(spark, good + bad)).collect()
    # The second dimension is constant: one component. Repeated ids are rows of their own.
    assert sorted((row["vec_id"] is None, row["vec_id"], row["component"]) for row in rows) == [(False, 2, 1), (False, 2, 1), (False, 3, 1), (True, None, 1)]
    assert {row["n"] for row in rows} == {3} and all(row["explained"] == pytest.approx(1) for row in rows)


def test_entries_out_of_range(spark):
    far = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [5.0, 2.0]), (4, [6.0, 4.0])]
    rows = whitening.whitened(frame(spark, far, "double")).collect()
    assert {row["vec_id"] for row in rows} == {1, 2, 3, 4}
    assert {row["deviation"] for row in rows if row["vec_id"] < 3} == {None}
    assert all(math.isfinite(row["whitened"]) for row in rows)
