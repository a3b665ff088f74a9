"""Lookup joins that stay cheap when the looked-up side is small and even when one key is hot."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 0.002
SALTS = 64

_ROW_OVERHEAD = 32
_SAFE = ("left", "left_semi", "left_anti", "inner")


def _row_bytes(df: DataFrame) -> Column:
    size = F.lit(_ROW_OVERHEAD + 8 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(f"`{field.name}`"), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            raise TypeError(f"cannot size the nested column {field.name}")
    return size


def measured_bytes(df: DataFrame) -> int:
    """Exact in-memory row bytes of a frame, from one Spark job."""
    return df.agg(F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()[0]


def measured_bytes_by(df: DataFrame, key: str) -> dict[str, int]:
    """Row bytes per value of a key with few values, such as the dimension's name, from one Spark job."""
    return dict(df.groupBy(key).agg(F.sum(_row_bytes(df))).collect())


def broadcastable(sizes: Mapping[str, int], budget: int = MAX_BROADCAST_BYTES) -> set[str]:
    """The lookups of one plan that may be broadcast together: the smallest ones, as long as they fit."""
    chosen, used = set(), 0
    for name in sorted(sizes, key=lambda name: (sizes[name], name)):
        used += sizes[name]
        if used > budget:
            break
        chosen.add(name)
    return chosen


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "left",
    right_bytes: int | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Broadcast the right side when its measured size allows, else shuffle with hot keys salted.

    ``keys_from`` is a cheaper frame with about the same keys as ``left``, in which to look for hot ones.
    """
    if how not in _SAFE:
        raise ValueError(f"lookup_join cannot do a {how} join")
    if right_bytes is None:
        right_bytes = measured_bytes(right)
    if right_bytes <= max_broadcast_bytes:
        return left.join(F.broadcast(right), on, how)
    return salted_join(left, right, on, how, keys_from=keys_from)


def hot_keys(df: DataFrame, on: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold at least ``share`` of the rows: never more than 1/share of them, however big the data."""
    df = df.select(on)
    floor = max(df.count() * share, 1.0)
    counts = df.where(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("_n"))
    return counts.where(F.col("_n") >= F.lit(floor)).select(on)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "left",
    salts: int = SALTS,
    share: float = HOT_SHARE,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Shuffle join in which every hot key (and NULL) is spread over ``salts`` tasks.

    Finding the hot keys reads the key column of ``left`` (or of ``keys_from``) twice before the join; which
    keys count as hot changes the plan, never the result.

    The salt is a hash of the row and its task, not a random number, so a task that is run again after
    an executor is lost gives the same salts; the task number spreads identical copies too.
    """
    if how not in _SAFE:
        raise ValueError(f"salted_join cannot do a {how} join")
    hot = hot_keys(left if keys_from is None else keys_from, on, share).withColumn("_hot", F.lit(True))
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(f"`{name}`") for name in left.columns]), F.lit(salts))
    salted_left = left.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.when(F.col("_hot") | F.col(on).isNull(), spread.cast("int")).otherwise(F.lit(0))
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_right = (
        right.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    )
    joined = salted_left.drop("_hot").join(salted_right.hint("shuffle_merge"), [on, "_salt"], how)
    kept = [name for name in right.columns if name != on] if how in ("left", "inner") else []
    return joined.select(*left.columns, *kept)
