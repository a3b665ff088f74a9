"""Bit filters of keys: which keys a group of rows may hold, in four bytes a key.

A group (a folder of a table) is cut into a power of two of blocks, by its number of keys. A block holds eight bit
fields of 32,768 bits; a key sets one bit in each field of its block. A key is missing for certain when one of its bits
is not set; of keys that are missing, about one in 100,000 has all its bits set by others.

Keys are shuffled as they are, narrow, before bits are collected: partial fields would be far wider than the keys.
Blocks are even, as they go by a hash of a key and a group's own size. A NULL key is in no filter and may be nowhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.operators.joins import MAX_BROADCAST_BYTES, lookup_join, measured_bytes

FIELDS = 8
KEYS_PER_BLOCK = 8192
_FIELD_BITS = 15  # Spark's bitmaps have 2^15 bits
_PER_HASH = 4
SIZE, BLOCK = "size", "block"
BITS = [f"bits{number}" for number in range(FIELDS)]


def _bit(key: str, field: int) -> Column:
    """The bit of a field that a key sets; four fields share a hash."""
    hashed = F.xxhash64(F.col(key), F.lit(1 + field // _PER_HASH))
    return F.shiftrightunsigned(hashed, _FIELD_BITS * (field % _PER_HASH)).bitwiseAND(F.lit((1 << _FIELD_BITS) - 1))


def _block(key: str) -> Column:
    """The block of a key among 2^size."""
    return F.xxhash64(F.col(key)).bitwiseAND(F.expr(f"shiftleft(1L, {SIZE}) - 1L"))


def build_filters(keys: DataFrame, groups: Sequence[str], key: str) -> DataFrame:
    """The blocks of every group: (groups, size, block, bits0..bits7). The groups are broadcast with their sizes, so
    there must be no more than a driver can list, such as a table's folders. An empty frame has no blocks."""
    keys = keys.where(F.col(key).isNotNull()).select(*groups, key)
    blocks = F.ceil(F.log2(F.ceil(F.col("_n") / F.lit(KEYS_PER_BLOCK)))).cast("int")
    sizes = keys.groupBy(*groups).agg(F.count("*").alias("_n")).select(*groups, blocks.alias(SIZE))
    placed = keys.join(F.broadcast(sizes), list(groups)).select(
        *groups, SIZE, _block(key).alias(BLOCK), *[_bit(key, field).alias(name) for field, name in enumerate(BITS)]
    )
    by = [*groups, SIZE, BLOCK]
    return placed.repartition(*by).groupBy(*by).agg(*[F.bitmap_construct_agg(name).alias(name) for name in BITS])


def _is_set(bits: str, position: Column) -> Column:
    byte = F.substring(F.col(bits), (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    found = F.conv(F.hex(byte), 16, 10).cast("int")
    return found.bitwiseAND(F.pow(F.lit(2), position % 8).cast("int")) != 0


def maybe_held(
    keys: DataFrame,
    filters: DataFrame,
    groups: Sequence[str],
    within: str,
    key: str,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """(groups, key) for every key that a group with the same value of ``within`` may hold: all that are held, and few
    others. Filters are broadcast if their measured size allows; else both sides are shuffled by block, with blocks
    that many keys ask for salted. A key is asked for once per size that occurs, not once per group."""
    sizes = filters.select(within, SIZE).distinct()
    at = F.concat_ws("/", within, SIZE, BLOCK)
    asked = keys.select(within, key).where(F.col(key).isNotNull()).join(F.broadcast(sizes), within)
    asked = asked.withColumn(BLOCK, _block(key)).select(at.alias("_at"), key)
    stored = filters.select(at.alias("_at"), *groups, *BITS)
    met = lookup_join(asked, stored, "_at", "inner", measured_bytes(stored), max_broadcast_bytes, keys_from=asked)
    for field, name in enumerate(BITS):
        met = met.where(_is_set(name, _bit(key, field)))
    return met.select(*groups, key).distinct()
