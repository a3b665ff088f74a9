"""Reading and writing managed tables (parquet folders with a fixed contract)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.sources import versions
from medallion.sources.versions import nullable

_MISSING = "PATH_NOT_FOUND"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table by path: its newest version if it has a log, or else the folder. With a schema no footer is opened to
    plan the scan, and text keys stay text."""
    version = versions.latest(spark, path)
    if version is not None:
        return versions.rows_of(spark, path, version, schema)
    reader = spark.read if schema is None else spark.read.schema(nullable(schema))
    df = reader.parquet(path)
    # Partition columns come last in a parquet folder; put them back in contract order.
    return df if schema is None else df.select(*schema.names)


def optional_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table, or None when its folder does not exist; any other error is raised."""
    try:
        return read_table(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != _MISSING:
            raise
    return None


def table_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    found = optional_table(spark, path, schema)
    return spark.createDataFrame([], nullable(schema)) if found is None else found


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Lay rows out by partition column before a partitioned write: few files per folder, and a folder
    that holds most of the rows is split over many tasks."""
    return df.hint("rebalance", *columns)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], balance: bool = True) -> None:
    """Replace only the partitions that occur in ``df``: writing the same batch again changes nothing."""
    rows = balanced(df, *partition_by) if balance else df
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh: the table's next version. Readers keep the version that they took, a failed run changes nothing,
    and ``df`` may read the table it replaces."""
    versions.replace_rows(df, path, partition_by)


def write_once(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Materialise a frame in the shared folder and read it back; pins random ids and cuts lineage."""
    rows = balanced(df, *partition_by) if partition_by else df
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return read_table(df.sparkSession, path, df.schema)


def register_views(
    spark: SparkSession, tables: Mapping[str, str], schemas: Mapping[str, T.StructType] | None = None
) -> None:
    """Open the layers to ``spark.sql``: view name -> table path."""
    for name, path in tables.items():
        read_table(spark, path, (schemas or {}).get(name)).createOrReplaceTempView(name)

