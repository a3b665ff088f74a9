"""What the operators of this subpackage share."""

from __future__ import annotations

import sys
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.session import configure, scratch_path
from medallion.sources.tables import read_table

# ASCII white space, as the contracts of all operators name it.
BLANKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Functions of this subpackage travel to the executors by value: no file has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules["medallion.llm"])


# Rows that go to Python at once: texts can be long, and a batch is held on both sides.
ARROW_ROWS = 1_000


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the library's settings and with small batches for Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return configure(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text; NULL counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(column, UPPER, LOWER)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the folder that all executors share and read back. Cuts the lineage, so that
    a lost executor costs no more than the tasks that read the table."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return read_table(df.sparkSession, path, df.schema)


def worker_cache(name: str, make: Callable[[], Any]) -> Any:
    """One object for all tasks of a Python worker. Code that travels by value has no lasting globals."""
    kept = sys.__dict__.setdefault("_medallion_llm_cache", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]
