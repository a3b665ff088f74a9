"""Where the tables of one lake live."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion import schemas
from medallion.operators.dims import CATEGORY_DIMS, dimension_table
from medallion.operators.marts import MARTS
from medallion.sources import versions
from medallion.sources.tables import balanced, optional_table, table_or_empty
from medallion.sources.versions import ATTEMPT

# Every attempt to write facts or silver rows has folders of its own, which the next version of the table names. They
# count when the attempt stands in a ledger: one that was cut short is never read, and none replaces another's rows.
DAY = "event_date"


def with_attempt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(ATTEMPT, T.StringType())])


BRONZE_LEDGER = with_attempt(schemas.FILE_LEDGER)
SILVER_LEDGER = with_attempt(schemas.table(string="etag batch_id loaded_at"))


def second_text(moment: dt.datetime) -> str:
    """The fixed-width text in which load and build times are stored."""
    return moment.strftime("%Y-%m-%d %H:%M:%S")


@dataclass(frozen=True)
class Lake:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def ledger(self) -> str:
        return self.path("state/file_ledger")

    @property
    def silver_ledger(self) -> str:
        return self.path("state/silver_ledger")

    @property
    def rejects(self) -> str:
        return self.path("bronze/rejects")

    @property
    def fact(self) -> str:
        return self.path("bronze/fact_telemetry")

    @property
    def dims(self) -> str:
        return self.path("bronze/dim_category")

    @property
    def devices(self) -> str:
        return self.path("bronze/dim_device")

    @property
    def reference(self) -> str:
        return self.path("ref/country")

    @property
    def silver(self) -> str:
        return self.path("silver/telemetry")

    @property
    def silver_keys(self) -> str:
        return self.path("state/silver_keys")

    def gold(self, mart: str) -> str:
        return self.path(f"gold/{mart}")

    def states(self, mart: str) -> str:
        return self.path(f"gold_states/{mart}")

    def audit(self, name: str) -> str:
        return self.path(f"audit/{name}")


def _finished(spark: SparkSession, ledger: str, attempts: Sequence[str]) -> set[str]:
    """Those of some attempts, no more than there were since rows were last merged, that stand in a ledger."""
    if not attempts:
        return set()
    done = table_or_empty(spark, ledger, T.StructType([T.StructField(ATTEMPT, T.StringType())]))
    return {row[0] for row in done.where(F.col(ATTEMPT).isin(*attempts)).distinct().collect()}


def committed_folders(spark: SparkSession, path: str, ledger: str) -> tuple[versions.Version, list[str]] | None:
    """A table's newest version and the folders that finished attempts wrote; None when there is no table."""
    version = versions.latest(spark, path)
    if version is None:
        return None
    done = _finished(spark, ledger, [entry.attempt for entry in version.entries if not entry.final])
    return version, [folder for entry in version.entries if entry.final or entry.attempt in done for folder in entry.folders]


def committed(spark: SparkSession, path: str, schema: T.StructType, ledger: str) -> DataFrame | None:
    """The rows of a table that finished attempts wrote; None when there is no table."""
    found = committed_folders(spark, path, ledger)
    return None if found is None else versions.rows_of(spark, path, found[0], schema, found[1])


def write_rows(df: DataFrame, path: str, attempt: str) -> None:
    """The rows of one attempt, by day. They count when the attempt is entered into the table's ledger."""
    entry = versions.write_attempt(balanced(df, DAY), path, [DAY], attempt, final=False)
    versions.add_entry(df.sparkSession, path, entry, df.schema)


def merge_days(spark: SparkSession, lake: Lake, at_once: int = 64) -> dict[str, int]:
    """Merge the folders that attempts left, so that facts and silver rows have one folder a day; returns how many
    days were merged in each. Files get the size that Spark's advisory partition size names. May run beside loaders
    and readers."""
    merged = {}
    for path, schema, ledger in ((lake.fact, schemas.FACT, lake.ledger), (lake.silver, schemas.SILVER, lake.silver_ledger)):
        merged[path] = versions.merge_folders(
            spark, path, schema, [DAY], lambda rows: balanced(rows, DAY), lambda attempts, ledger=ledger: _finished(spark, ledger, attempts), at_once
        )
    return merged


def read_facts(spark: SparkSession, lake: Lake) -> DataFrame | None:
    return committed(spark, lake.fact, schemas.FACT, lake.ledger)


def read_silver_rows(spark: SparkSession, lake: Lake) -> DataFrame | None:
    return committed(spark, lake.silver, schemas.SILVER, lake.silver_ledger)


def new_attempt() -> str:
    return uuid.uuid4().hex


def register_lake(spark: SparkSession, lake: Lake) -> list[str]:
    """Every table that exists, as a temporary view for ``spark.sql``; returns the view names."""
    tables = {
        "dim_category": (lake.dims, schemas.CATEGORY_DIM),
        "dim_device": (lake.devices, schemas.DEVICE_DIM),
        "country_reference": (lake.reference, schemas.COUNTRY_REFERENCE),
        "file_loads": (lake.audit("file_loads"), schemas.FILE_LOADS),
        "layer_runs": (lake.audit("layer_runs"), schemas.LAYER_RUNS),
        "mart_runs": (lake.audit("mart_runs"), schemas.MART_RUNS),
        "dag_runs": (lake.audit("dag_runs"), schemas.DAG_RUNS),
        **{f"gold_{name}": (lake.gold(name), spec.schema) for name, spec in MARTS.items()},
    }
    names = []
    frames = {name: optional_table(spark, path, schema) for name, (path, schema) in tables.items()}
    frames |= {"fact_telemetry": read_facts(spark, lake), "silver_telemetry": read_silver_rows(spark, lake)}
    for name, found in frames.items():
        if found is None:
            continue
        found.createOrReplaceTempView(name)
        names.append(name)
        if name == "dim_category":
            for spec in CATEGORY_DIMS:
                dimension_table(found, spec).createOrReplaceTempView(f"dim_{spec.name}")
                names.append(f"dim_{spec.name}")
    return names
