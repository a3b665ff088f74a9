from __future__ import annotations

import math
import random

import numpy as np
import pytest

from medallion.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, size string"


def brute(rows, cosine=embeddings.MIN_COSINE):
    def usable(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    close = [[False] * n for _ in range(n)]
    units = [np.array(v, np.float32).astype(float) if usable(v) else None for _, v, _ in rows]
    for i in range(n):
        for j in range(n):
            a, b = units[i], units[j]
            same = i != j and rows[i][2] is not None and rows[i][2] == rows[j][2] and a is not None and b is not None
            if same and len(a) == len(b):
                close[i][j] = a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= cosine
    result = []
    for i in range(n):
        seen, front = {i}, [i]
        while front:
            front = [j for k in front for j in range(n) if close[k][j] and j not in seen and not seen.add(j)]
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        result.append((rows[i][0], sum(close[i]), min(ids, default=None)))
    return result


def vectors(n, dims, seed):
    rng = np.random.default_rng(seed)
    centres, rows = rng.normal(size=(max(2, n // 12), dims)), []
    for k in range(n):
        v = centres[rng.integers(len(centres))] + rng.normal(size=dims) * rng.choice([0, 0.05, 0.12, 0.3])
        rows.append((k, [float(x) for x in v.astype(np.float32)], int(rng.integers(2))))
    return rows


def found(spark, rows, **settings):
    df = spark.createDataFrame([(*row, "clash") for row in rows], SCHEMA)
    key = lambda row: tuple(-1 if x is None else x for x in row)
    rows = embeddings.near_copies(df, **settings).collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in rows), key=key)


def test_edge_cases(spark):
    v = [0.5, 0.5, 0.1]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0, 0.0, 0.0], [None, 1.0, 1.0], [nan, 1.0, 1.0], [inf, 1.0, 1.0], [1e-30, 1e-30, 0.0], [1.0, 2.0], [2.0, 4.0], [-0.0, 1.0, 0.0], [0.0, 1.0, 0.0]]
    rows = [(k, x, 1) for k, x in enumerate(odd)] + [(20, v, 1), (21, v, 1), (22, v, 2), (23, v, None), (24, v, None), (None, v, 1), (20, v, 1)]
    rows += [(None, [3.0, -3.0, 1.0], 1), (30, None, None)]
    key = lambda row: tuple(-1 if x is None else x for x in row)
    expected = [(vec_id, links, component) for vec_id, links, component in brute(rows)]
    assert found(spark, rows) == sorted(expected, key=key)
    assert found(spark, []) == []


@pytest.mark.parametrize("block", [7, 1024])
def test_blocks_against_brute_force(spark, block):
    rows = vectors(150, 8, block)
    assert found(spark, rows + rows[:20], block=block) == sorted(brute(rows + rows[:20]))


def test_cells_find_nearly_all(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL_ROWS", 30)
    rows = vectors(300, 16, 3)
    links = {vec_id: n for vec_id, n, _ in brute(rows)}
    got = {vec_id: n for vec_id, n, _ in found(spark, rows, block=16)}
    assert all(got[k] <= links[k] for k in links) and sum(got.values()) >= 0.9 * sum(links.values()) > 0


def test_many_cells_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL_ROWS", 10)
    rng = np.random.default_rng(5)
    # In four dimensions links cross the borders of thirty cells everywhere.
    rows = [(k, [float(x) for x in rng.normal(size=4).astype(np.float32)], 0) for k in range(300)]
    assert found(spark, rows, block=16) == sorted(brute(rows))


def as_doubles(spark, rows, label="string"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {label}")


def test_any_magnitude_and_label(spark):
    rows = [
        (1, [1e-200, 2e-200], "a"),
        (2, [1.0, 0.1], "a"),  # cosine 0.53 with row 1
        (3, [1e200, 2e200], "a"),
        (4, [2e200, 4e200], "a"),
        (5, [5e-324, 1e-323], "a"),
        (6, [1.7e308, 1.7e307], "a"),  # beside row 2
        (7, [1.0, 2.0], "b"),
        (8, [2.0], "b,1.0"),
        (9, [2.0], "b:1.0"),
        (10, [1.0, 2.0], "3:b"),
    ]
    found = {row["vec_id"]: (row["n_links"], row["component_id"]) for row in embeddings.near_copies(as_doubles(spark, rows)).collect()}
    upright = {1, 3, 4, 5}
    assert all(found[k] == (3, 1) for k in upright) and found[2] == found[6] == (1, 2)
    assert all(found[k] == (0, k) for k in (7, 8, 9, 10))


def test_labels_with_separators_stay_apart(spark):
    rows = [(k, [1.0, float(k % 2)], label) for k, label in enumerate(["x", "x", "x,1.0", "1:x", "x:", "", " ", None])]
    found = {row["vec_id"]: row["n_links"] for row in embeddings.near_copies(as_doubles(spark, rows)).collect()}
    assert set(found.values()) == {0}


def test_many_magnitudes_in_many_cells_against_numpy(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL_ROWS", 200)
    draw = np.random.default_rng(7)
    centres = draw.standard_normal((150, 24))
    points = (centres[draw.integers(0, 150, 3_000)] + 0.12 * draw.standard_normal((3_000, 24))) * 10.0 ** draw.uniform(-150, 150, (3_000, 1))
    points[2_000:] = points[0]  # a vector that holds a third of the rows
    labels = draw.integers(0, 2, 3_000)
    labels[2_000:] = labels[0]
    units = points / np.abs(points).max(1, keepdims=True)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    close = (units @ units.T >= embeddings.MIN_COSINE) & (labels[:, None] == labels)
    np.fill_diagonal(close, False)
    assert close[:2_000, :2_000].sum() > 5_000
    rows = [(k, points[k].tolist(), str(labels[k])) for k in range(3_000)]
    found = {row["vec_id"]: row["n_links"] for row in embeddings.near_copies(as_doubles(spark, rows)).collect()}
    assert [found[k] for k in range(3_000)] == close.sum(1).tolist()
