"""A dense global row index without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.session import ensure_checkpoints

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def dense_index(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Add 0, 1, 2, … in ``order_by`` order, which must be unique.

    The rows are range-sorted over all tasks and numbered inside each; the checkpoint pins that layout, and
    only one row per task is needed to turn local numbers into global ones.
    """
    ensure_checkpoints(df.sparkSession)
    numbered = df.orderBy(*order_by).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    task = F.shiftright("_id", _ROW_BITS)
    local = F.col("_id") - F.shiftleft(task, _ROW_BITS)
    numbered = numbered.withColumns({"_task": task, "_local": local})
    sizes = numbered.groupBy("_task").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        numbered.join(F.broadcast(offsets), "_task")
        .withColumn(name, (F.col("_offset") + F.col("_local")).cast("long"))
        .select(*df.columns, name)
    )
