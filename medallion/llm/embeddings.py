"""Near-deduplication of embeddings by cosine.

Spherical k-means, fitted on a bounded sample, assigns every vector to its home, the cell of the nearest centre. A
vector visits every cell of whose border it is within half the angle that links: on the way from one vector of a
linked pair to the other the border of their homes is crossed, so the nearer one visits the other's home. No link is
lost, whatever the size of the table, the number of cells and the centres. Inside a cell, vectors of one label are
compared in blocks by products of matrices, in double precision, homes with homes and with visitors. A pair is
counted in one cell only.

Equal vectors of a label are one class that is compared once, with its number of rows. A cell is split into blocks
of bounded size, however many vectors it holds, and each pair of blocks is a task of its own. A task returns one
count a vector and a spanning forest of its links, never the pairs.

Defined results
* Vectors that are NULL, empty, zero or hold NULL or non-finite components link with nothing, nor do those without a
  label; vectors of different lengths are never compared. Others link by their direction, whatever their magnitude.
* ``n_links`` counts rows, so a row with an equal one links with it. ``component_id`` is the smallest id reachable,
  NULL ids left aside. A row with a NULL id that links with nothing has a NULL component and is kept.
* Rows that repeat an id with another vector are vectors of their own. Other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.common import stored
from medallion.llm.components import components
from medallion.operators.joins import salted_join

MIN_COSINE = 0.93
# The centres are fitted on at most so many vectors; every vector is indexed.
SAMPLE = 50_000
CELL_ROWS, MIN_CELLS, MAX_CELLS = 2_000, 8, 2_048
# Far above what rounding moves a border by: at worst a visit too many.
_SLACK = 1e-9
BLOCK = 1_024
_ROUNDS = 10


def named(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding and class: a 128-bit name of label and vector, NULL where the vector can't link."""
    valid = (
        F.col("label").isNotNull()
        & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    # 0.0 + x: both zeros get one name. The label's length tells where it ends, whatever it holds.
    parts = F.transform("embedding", lambda x: (x + F.lit(0.0)).cast("string"))
    label = F.col("label").cast("string")
    name = F.md5(F.concat_ws(":", F.octet_length(label), label, F.array_join(parts, ",")))
    return vectors.select("vec_id", "label", "embedding", F.when(valid, name).alias("class"))


def fit_centres(classes: DataFrame, n: int, sample: int = SAMPLE) -> list[list[float]]:
    """Centres of a spherical k-means over at most about ``sample`` of ``n`` vectors, chosen by their name."""
    cells = min(MAX_CELLS, max(MIN_CELLS, n // CELL_ROWS))
    if n <= cells:
        return []
    share = min(1.0, sample / n)
    chosen = classes.where(F.pmod(F.xxhash64("class"), F.lit(1_000_000)) < int(share * 1_000_000))
    # By the largest entry first: the squares of very large or small ones have no double.
    largest = F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double"))))
    points = chosen.select(array_to_vector(F.transform("embedding", lambda x: x.cast("double") / largest)).alias("features"))
    model = KMeans(k=cells, distanceMeasure="cosine", maxIter=_ROUNDS, seed=1).fit(points)
    return [[float(x) for x in centre] for centre in model.clusterCenters()]


def assigned(classes: DataFrame, centres: list[list[float]], min_cosine: float) -> DataFrame:
    """The rows of ``classes`` with their ``home`` and the cells they visit. Without centres there is one cell; vectors
    of another length than the centres have a cell of their own."""
    if not centres:
        return classes.withColumns({"home": F.lit(0), "visits": F.array().cast("array<int>")})
    added = [T.StructField("home", T.IntegerType()), T.StructField("visits", T.ArrayType(T.IntegerType()))]
    fields = [*classes.schema.fields, *added]
    at = classes.columns.index("embedding")
    other = len(centres)
    reach = math.sin(math.acos(min_cosine) / 2)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        units = np.array(centres)
        units /= np.linalg.norm(units, axis=1, keepdims=True)
        # From centre to centre; a difference of small ones is taken as it is, not by way of the cosine.
        apart = np.stack([np.linalg.norm(units - unit, axis=1) for unit in units])
        for batch in batches:
            homes, visits = [], []
            for vector in batch.column(at):
                point = vector.values.to_numpy().astype(float)
                if len(point) != units.shape[1]:
                    homes.append(other)
                    visits.append([])
                    continue
                point /= np.abs(point).max()
                near = units @ (point / np.linalg.norm(point))
                home = int(near.argmax())
                # The sine of the angle to the border, times the distance of the centres.
                visited = near[home] - near <= reach * apart[home] + _SLACK
                visited[home] = False
                homes.append(home)
                visits.append(np.flatnonzero(visited).tolist())
            columns = [pa.array(homes, pa.int32()), pa.array(visits, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[field.name for field in fields])

    return classes.mapInArrow(nearest, T.StructType(fields))


def block_pairs(placed: DataFrame, block: int) -> DataFrame:
    """The rows of every cell, dealt into blocks, once for each pair of blocks that they are compared in: two blocks
    of the cell's own rows, or one of these and one of its visitors. Visitors are not compared with each other."""
    cell = ["label", "size", "cell"]
    rest = ["label", "size", "class", "rows", "embedding", "home"]
    # Of its visits, a row's home needs those that may have counted a pair before.
    before = F.filter("visits", lambda visited: visited < F.col("home")).alias("before")
    none = F.array().cast("array<int>").alias("before")
    members = placed.select(*rest, before, F.col("home").alias("cell")).unionByName(
        placed.select(*rest, none, F.explode("visits").alias("cell"))
    )
    at_home = F.col("home") == F.col("cell")
    blocks = [F.ceil(F.count_if(which) / block).cast("int") for which in (at_home, ~at_home)]
    sizes = members.groupBy(*cell).agg(blocks[0].alias("own"), blocks[1].alias("foreign")).where("own > 0")
    number = F.xxhash64("class")
    dealt = members.join(sizes, cell).withColumn(
        "block",
        F.when(at_home, F.pmod(number, F.col("own"))).otherwise(F.col("own") + F.pmod(number, F.col("foreign"))).cast("int"),
    )
    last = F.when(at_home, F.col("own") + F.col("foreign")).otherwise(F.col("own")) - 1
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return dealt.select(
        *cell,
        F.least("block", "other").alias("first_block"),
        F.greatest("block", "other").alias("second_block"),
        "block",
        "class",
        "rows",
        "embedding",
        "home",
        "before",
    )


LINKED = "class string, links long, root string"


def linker(min_cosine: float):
    """Compares one pair of blocks: a row for every vector with a link, with the rows it links to and the vector
    that stands for what it is joined with here."""

    def linked(key: tuple, table: pa.Table) -> pa.Table:
        import numpy as np

        cell, first, second = (key[k].as_py() for k in (2, 3, 4))
        names = table.column("class").to_pylist()
        points = np.array(table.column("embedding").to_pylist(), dtype=float)
        points /= np.abs(points).max(axis=1, keepdims=True)
        points /= np.linalg.norm(points, axis=1, keepdims=True)
        rows = np.array(table.column("rows").to_pylist(), dtype=np.int64)
        before = table.column("before").to_pylist()
        home = table.column("home").to_numpy()
        side = np.array(table.column("block").to_pylist())

        if first == second:
            close = points @ points.T >= min_cosine
            np.fill_diagonal(close, False)
        else:
            close = np.zeros((len(names), len(names)), bool)
            one, two = np.flatnonzero(side == first), np.flatnonzero(side == second)
            met = points[one] @ points[two].T >= min_cosine
            close[np.ix_(one, two)], close[np.ix_(two, one)] = met, met.T
        # A pair that also meets in a home with a smaller number is counted there.
        for visitor in np.flatnonzero((home < cell) & close.any(1)):
            for host in np.flatnonzero(close[visitor]):
                if home[visitor] in before[host]:
                    close[visitor, host] = close[host, visitor] = False

        links, roots = close @ rows, np.full(len(names), -1)
        for start in np.flatnonzero(links):
            front = [start] if roots[start] < 0 else []
            while len(front):
                roots[front] = start
                front = np.flatnonzero(close[front].any(0) & (roots < 0))
        found = np.flatnonzero(links)
        return pa.table(
            [
                pa.array([names[k] for k in found], pa.string()),
                pa.array(links[found], pa.int64()),
                pa.array([names[roots[k]] for k in found], pa.string()),
            ],
            names=["class", "links", "root"],
        )

    return linked


def near_copies(
    vectors: DataFrame,
    min_cosine: float = MIN_COSINE,
    sample: int = SAMPLE,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    rows = named(vectors)
    valid = rows.where("class IS NOT NULL")
    classes = stored(
        valid.groupBy("class").agg(
            F.first("label").alias("label"),
            F.first("embedding").alias("embedding"),
            F.min("vec_id").alias("first"),
            F.count("*").alias("rows"),
        ).withColumn("size", F.size("embedding")),
        "vector-classes",
    )
    most = classes.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    same_size = classes.where(F.col("size") == most["size"]) if most else classes
    centres = fit_centres(same_size, most["count"] if most else 0, sample)
    placed = stored(assigned(classes.drop("first"), centres, min_cosine), "vector-cells")
    pairs = block_pairs(placed, block)
    linked = stored(
        pairs.groupBy("label", "size", "cell", "first_block", "second_block").applyInArrow(linker(min_cosine), LINKED),
        "vector-links",
    )
    counts = linked.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.col("class").alias("a"), F.col("root").alias("b")))
    rooted = stored(
        classes.select("class", "first", "rows")
        .join(counts, "class", "left")
        .join(roots.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class")),
        "vector-roots",
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    # One component may hold most of the rows.
    labels = salted_join(rooted, smallest, "root", "inner").select(
        "class", (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("links"), "component"
    )
    component = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return (
        rows.select("vec_id", "class")
        .join(labels, "class", "left")
        .select(
            "vec_id",
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.col("vec_id").eqNullSafe(component).alias("kept"),
        )
    )


EMBEDDINGS_SQL = f"""
WITH RECURSIVE valid AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x != 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= {MIN_COSINE}
), reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), smallest AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a
), counts AS (
  SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT s.vec_id, coalesce(c.n_links, 0) AS n_links, s.component_id, s.vec_id = s.component_id AS kept
FROM smallest s LEFT JOIN counts c ON s.vec_id = c.vec_id
"""
