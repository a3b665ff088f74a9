"""The country reference table. Its rows come from the user: any CSV or table with the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medallion.operators.conform import conform, evolve
from medallion.schemas import COUNTRY_REFERENCE
from medallion.sources.tables import nullable, read_table, replace_table


def read_reference_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header; absent columns are NULL."""
    df = spark.read.option("header", "true").option("encoding", "UTF-8").csv(path)
    return conform(evolve(df, COUNTRY_REFERENCE), COUNTRY_REFERENCE, what="country reference")


def replace_reference(df: DataFrame, path: str) -> None:
    replace_table(conform(evolve(df, COUNTRY_REFERENCE), COUNTRY_REFERENCE, what="country reference"), path)


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, nullable(COUNTRY_REFERENCE))
