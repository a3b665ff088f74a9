"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.session import size_tasks_by_rows


def latest_by(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str | Column]) -> DataFrame:
    """The first row per key in the given order; ties are settled by a hash of the whole row.

    Spark turns ``row_number() = 1`` into a group limit on both sides of the shuffle, so each map task
    sends at most one row per key: a key with a third of all rows does not pile up in one task.
    """
    order = [F.col(item).desc() if isinstance(item, str) else item for item in newest_first]
    tie = F.xxhash64(*[F.col(f"`{name}`") for name in df.columns if name not in keys])
    ranked = Window.partitionBy(*keys).orderBy(*order, tie)
    return df.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") == 1).drop("_rank")


def fact_dedup(fact: DataFrame) -> DataFrame:
    """The newest version of every fact row. Facts are wide: a task that sorts them gets as many as fit well."""
    size_tasks_by_rows(fact.sparkSession)
    return latest_by(fact, ["fact_uid"], ["_loaded_at", "_file_hash", "_part_index"])
