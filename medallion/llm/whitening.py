"""Whitening of embeddings.

Entries become whole numbers on a fixed grid. Over the distinct grid vectors Spark adds up, exactly, the sums of each
dimension, and then, task by task, the products of the centred vectors. The eigenvectors of the covariance come from
spectral divide and conquer: the polar factor of the shifted covariance, by the QR-based dynamically weighted Halley
iteration, is one on the part of the space above the shift and minus one on the part below. Half of one plus it is the
projector of the upper part; bases of both parts split the matrix in two, until every part is one component wide.
Every vector is then whitened by the leading components, a small matrix that is sent to all tasks. A last pass
measures the covariance of the whitened fit list.

What the driver holds is the covariance and bases of it: dimension by dimension numbers, whatever the number of rows.

Defined results
* Vectors that are NULL, empty or hold NULL or non-finite entries are dropped, and those of another length than the
  commonest one (of equally common ones the shortest). Rows repeated in any number count once in the fit list.
* Grid numbers are held within 2**53 either way, so that they are exact as doubles.
* A direction without variance (an eigenvalue below the rounding of the largest) has no unit variance to be given: it
  is left out, so there may be fewer components than asked for, and none if all vectors are equal.
* A deviation beyond the range of a long is NULL. Eigenvalues that are equal to rounding share a space, of which any
  basis is one of eigenvectors.
* Other columns are never read; a NULL vec_id is a row like any other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import stored

SCALE, ORIGIN = 64.0, 1_000_000
COMPONENTS = 16
_GRID = 1 << 53
# Of the largest eigenvalue; below it an eigenvalue is rounding.
_NO_VARIANCE = 1e-12


def gridded(vectors: DataFrame) -> DataFrame:
    """vec_id and x, an array of longs, of every vector that can be whitened."""
    entries = F.transform("embedding", lambda c: c.cast("double"))
    sound = F.coalesce((F.size("embedding") > 0) & F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), F.lit(False))
    level = float(_GRID - ORIGIN)
    whole = lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-level)), F.lit(level))) + F.lit(ORIGIN)
    return vectors.where(sound).select("vec_id", F.transform(entries, whole).alias("x"))


def polar_factor(matrix):
    """The orthogonal polar factor of a symmetric matrix by QDWH; the sign of every eigenvalue."""
    import numpy as np

    size = len(matrix)
    now, one = matrix / np.linalg.norm(matrix), np.eye(size)
    least = 1e-15
    for _ in range(40):
        # The weights that lift the smallest singular value the most, while none exceeds one.
        root = (4 * max(1 - least**2, 0.0) / least**4) ** (1 / 3)
        a = math.sqrt(1 + root) + math.sqrt(max(8 - 4 * root + 8 * (2 - least**2) / (least**2 * math.sqrt(1 + root)), 0.0)) / 2
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        left, _ = np.linalg.qr(np.vstack([math.sqrt(c) * now, one]))
        after = (b / c) * now + ((a - b / c) / math.sqrt(c)) * (left[:size] @ left[size:].T)
        after = (after + after.T) / 2
        moved = np.linalg.norm(after - now)
        least = min(1.0, least * (a + b * least**2) / (1 + c * least**2))
        now = after
        if least > 1 - 1e-15 and moved < 1e-13 * math.sqrt(size):
            break
    return now


def _bases(projector, rank: int):
    """Orthonormal bases of what the projector keeps and of what it drops: the columns of QR of random mixtures of its
    columns, made orthogonal once more to be so to rounding."""
    import numpy as np

    size = len(projector)
    mixed = np.random.default_rng(rank).standard_normal((size, size))
    kept = projector @ np.linalg.qr(projector @ mixed[:, :rank])[0]
    dropped = mixed[:, rank:] - projector @ mixed[:, rank:]
    whole, _ = np.linalg.qr(np.hstack([np.linalg.qr(kept)[0], np.linalg.qr(dropped)[0]]))
    return whole[:, :rank], whole[:, rank:]


def eigenpairs(matrix, most: int):
    """At least the ``most`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    import numpy as np

    unit = np.abs(matrix).max() or 1.0
    matrix = matrix / unit
    scale = np.linalg.norm(matrix)
    waiting, found = [(matrix, np.eye(len(matrix)))], []
    while waiting and len(found) < most:
        part, basis = waiting.pop()
        size = len(part)
        mean = np.trace(part) / size
        if size == 1 or np.linalg.norm(part - mean * np.eye(size)) <= 4e-16 * scale * size:
            found += [(part[k, k], basis[:, k]) for k in range(size)]
            continue
        # Above the middle of the diagonal for halves of one size; the mean lies between any two different eigenvalues.
        diagonal = np.sort(np.diagonal(part))
        middle = (diagonal[(size - 1) // 2] + diagonal[size // 2]) / 2
        spread = diagonal[-1] - diagonal[0]
        for shift in (middle, mean, mean + 1e-3 * spread, mean - 1e-3 * spread):
            projector = (polar_factor(part - shift * np.eye(size)) + np.eye(size)) / 2
            rank = round(float(np.trace(projector)))
            if 0 < rank < size and np.linalg.norm(projector @ projector - projector) < 1e-9 * size:
                break
        else:  # all of one value, as far as doubles can tell
            found += [(part[k, k], basis[:, k]) for k in range(size)]
            continue
        upper, lower = _bases(projector, rank)
        # The upper part is split first: parts are finished in falling order.
        for side in (lower, upper):
            inner = side.T @ part @ side
            waiting.append(((inner + inner.T) / 2, basis @ side))
    found.sort(key=lambda pair: -pair[0])
    return unit * np.array([value for value, _ in found]), np.array([vector for _, vector in found]).T


def summed_products(fit: DataFrame, n: int, sums: list[int], matrix=None):
    """The covariance of the fit list, centred before multiplying; of what ``matrix`` makes of it, if given."""
    import numpy as np

    width = len(sums) if matrix is None else matrix.shape[1]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            points = centred(batch.column(0), n, sums)[1]
            points = points if matrix is None else points @ matrix
            total += points.T @ points
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(total.tolist())], names=["row", "values"])

    rows = fit.mapInArrow(products, "row int, values array<double>").select("row", F.posexplode("values").alias("column", "value"))
    found = np.zeros((width, width))
    for row, column, value in rows.groupBy("row", "column").agg(F.sum("value")).toLocalIterator():
        found[row, column] = value
    return found / n


def centred(column: pa.Array, n: int, sums: list[int]):
    """n * x - sums, exactly, and x - sums / n, of a batch of vectors."""
    import numpy as np

    grid = column.values.slice(column.offsets[0].as_py(), column.offsets[-1].as_py() - column.offsets[0].as_py())
    x = grid.to_numpy().reshape(len(column), len(sums))
    most = max(int(np.abs(x).max(initial=0)) * n, *map(abs, sums))
    exact = x * np.int64(n) - np.array(sums) if most < 1 << 62 else x.astype(object) * n - np.array(sums, dtype=object)
    return exact, (exact / n).astype(float)


OUTPUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """One row a vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    import numpy as np

    spark = vectors.sparkSession
    grid = gridded(vectors)
    distinct = stored(grid.select("x").distinct(), "grid-vectors")
    lengths = distinct.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), "length").first()
    if not common:
        return spark.createDataFrame([], OUTPUT)
    length, n = common
    fit = distinct.where(F.size("x") == length)
    by_dimension = fit.select(F.posexplode("x").alias("dimension", "value")).groupBy("dimension").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total"))
    totals = {row["dimension"]: int(row["total"]) for row in by_dimension.toLocalIterator()}
    sums = [totals[k] for k in range(length)]

    covariance = summed_products(fit, n, sums)
    values, axes = eigenpairs(covariance, most)
    kept = [k for k in range(min(most, len(values))) if values[k] > _NO_VARIANCE * max(values[0], 0)]
    if not kept:
        return spark.createDataFrame([], OUTPUT)
    matrix = axes[:, kept] / np.sqrt(values[kept])
    explained = (values[kept] / np.trace(covariance)).tolist()
    error = float(np.abs(summed_products(fit, n, sums, matrix) - np.eye(len(kept))).max())

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(kept)
        for batch in batches:
            if not batch.num_rows:
                continue
            exact, points = centred(batch.column(1), n, sums)
            if exact.dtype == object or float(np.abs(exact).max()) ** 2 * length >= 1 << 62:
                squares = [sum(int(v) ** 2 for v in row) for row in exact]
                squares = [v if v < 1 << 63 else None for v in squares]
            else:
                squares = (exact**2).sum(1).tolist()
            rows = batch.num_rows
            each = np.repeat(np.arange(rows), width)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * width, n)),
                    pa.array(squares, pa.int64()).take(pa.array(each)),
                    pa.array((points @ matrix).ravel()),
                    pa.array(explained * rows),
                    pa.array(np.full(rows * width, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    same = grid.where(F.size("x") == length).select(F.col("vec_id").cast("long").alias("vec_id"), "x")
    return same.mapInArrow(applied, OUTPUT)
