"""Facts and a large dimension laid out alike, so that they join without a shuffle.

Both are catalog tables bucketed by the key and a salt. A key that holds many rows is spread over the salts, and its
dimension row is copied to each of them; the list of such keys is kept beside the tables, so that what is added later
goes by the same list. A key that becomes frequent later makes its bucket long until the tables are laid out anew, but
no join lose a row. Rows without a key are spread and meet nothing.

A bucket is read by one task: take as many as there are parts of some 200 MB in the facts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.operators.conform import require_columns
from medallion.operators.joins import HOT_SHARE, SALTS, hot_keys
from medallion.sources.tables import read_table, replace_table

SALT = "_salt"


@dataclass(frozen=True)
class Layout:
    """Two tables of the session's catalog, the key they share, and the folder that holds them."""

    name: str
    root: str
    key: str
    buckets: int
    salts: int = SALTS

    @property
    def facts(self) -> str:
        return f"{self.name}_facts"

    @property
    def dimension(self) -> str:
        return f"{self.name}_dimension"

    @property
    def hot(self) -> str:
        return f"{self.root.rstrip('/')}/hot"


def _add(df: DataFrame, layout: Layout, table: str) -> None:
    by = [layout.key, SALT]
    # Rows are shuffled as the buckets are hashed, so a bucket gets one file from each call.
    laid = df.repartition(layout.buckets, *by)
    path = f"{layout.root.rstrip('/')}/{table}"
    laid.write.mode("append").bucketBy(layout.buckets, *by).sortBy(*by).option("path", path).format("parquet").saveAsTable(table)


def _marked(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows with ``_hot`` where their key is on the list, which has at most some 1/share keys."""
    hot = read_table(df.sparkSession, layout.hot).withColumn("_hot", F.lit(True))
    return df.join(F.broadcast(hot), layout.key, "left")


def add_facts(df: DataFrame, layout: Layout) -> None:
    """The salt is a hash of the row and its task, as in ``salted_join``: a task that runs again gives the same."""
    columns = df.columns
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(f"`{name}`") for name in columns]), F.lit(layout.salts))
    salted = F.when(F.col("_hot") | F.col(layout.key).isNull(), spread.cast("int")).otherwise(F.lit(0))
    _add(_marked(df, layout).select(*columns, salted.alias(SALT)), layout, layout.facts)


def add_dimension(df: DataFrame, layout: Layout) -> None:
    """Dimension rows, one a key; a key must not be added twice."""
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(layout.salts - 1))).otherwise(F.array(F.lit(0)))
    marked = _marked(df.where(F.col(layout.key).isNotNull()), layout)
    _add(marked.select(*df.columns, F.explode(copies).alias(SALT)), layout, layout.dimension)


def lay_out(facts: DataFrame, dimension: DataFrame, layout: Layout, share: float = HOT_SHARE) -> Layout:
    """Both tables anew. The key column must have one type in both."""
    for df, what in ((facts, "facts"), (dimension, "dimension")):
        require_columns(df, [layout.key], what)
        if SALT in df.columns:
            raise ValueError(f"{what} already has a column {SALT}")
    kinds = [df.schema[layout.key].dataType for df in (facts, dimension)]
    if kinds[0] != kinds[1]:
        raise TypeError(f"{layout.key} is {kinds[0].simpleString()} in facts and {kinds[1].simpleString()} in the dimension")
    replace_table(hot_keys(facts, layout.key, share), layout.hot)
    add_facts(facts, layout)
    add_dimension(dimension, layout)
    return layout


def joined(spark: SparkSession, layout: Layout, how: str = "left") -> DataFrame:
    """Facts with their dimension's columns; neither side is shuffled."""
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"cannot do a {how} join")
    left, right = spark.table(layout.facts), spark.table(layout.dimension)
    return left.join(right.hint("merge"), [layout.key, SALT], how).drop(SALT)


def drop_layout(spark: SparkSession, layout: Layout) -> None:
    """Forget both tables; their files stay in the folder."""
    for table in (layout.facts, layout.dimension):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
