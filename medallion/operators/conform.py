"""Schema and data-quality operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_columns(df: DataFrame, names: Iterable[str], what: str = "input") -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")
    return df


def conform(df: DataFrame, schema: T.StructType, enforce_required: bool = True, what: str = "table") -> DataFrame:
    """Select, order and cast to a table contract.

    A NULL in a required column fails the running write: the check is part of the projection and costs no
    extra pass over the data. The columns are SQL text, which reaches the JVM in one call, not in hundreds.
    """
    present = {field.name: field.dataType for field in df.schema.fields}
    require_columns(df, schema.names, what)
    columns = []
    for field in schema.fields:
        value = f"`{field.name}`"
        if present[field.name] != field.dataType:
            value = f"try_cast({value} AS {field.dataType.simpleString()})"
        if enforce_required and not field.nullable:
            value = f"coalesce({value}, raise_error('{what}.{field.name} is required but NULL'))"
        columns.append(f"{value} AS `{field.name}`")
    return df.selectExpr(*columns)


def evolve(df: DataFrame, new_fields: T.StructType, after: str | None = None) -> DataFrame:
    """Add the fields that are missing, as NULLs, right behind ``after`` (at the end when it is absent)."""
    missing = [field for field in new_fields.fields if field.name not in df.columns]
    if not missing:
        return df
    added = [F.lit(None).cast(field.dataType).alias(field.name) for field in missing]
    position = df.columns.index(after) + 1 if after in df.columns else len(df.columns)
    kept = [F.col(f"`{name}`") for name in df.columns]
    return df.select(*kept[:position], *added, *kept[position:])


def null_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows (column_name, n_null) for every checked column, from one pass over the data."""
    names = list(columns)
    require_columns(df, names)
    counted = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in names])
    return counted.unpivot([], names, "column_name", "n_null")
