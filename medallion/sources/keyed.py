"""Keyed tables: one row per key, kept in ranges of the key, with the changes of every version.

A table is a version log whose folders are ranges: the high bits of one number of the key, beside whatever else parts
the rows. Keys that arrive in order, as message numbers do, fall into the newest ranges, so a merge reads and rewrites
those alone, however long the history is, and a reader takes all others as they are, without a shuffle. A range holds
at most ``2 ** bits`` numbers. Narrow ranges of a table that outgrows them are widened, up to ``2 ** WIDEST`` numbers,
so that a merge doesn't write thousands of small folders; from there on ranges grow in number and not in size.

Every row holds the version that brought its key and the version that last changed it. Folders are named after the
version that wrote them, so what changed since a version is found in the folders written since.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.dedup import latest_by
from medallion.sources import versions
from medallion.sources.versions import Version, nullable

RANGE, FIRST, SINCE, GONE = "_range", "_first", "_since", "_gone"
BITS = "range_bits"
# A table with more ranges than this has them widened, until it has so many times fewer that the next time is far off.
RANGES, FEWER, WIDEST = 256, 8, 20
_LABEL = re.compile(r"(.*?)-(-?\d+|none)", re.DOTALL)
NO_VERSION = Version(0, ())


@dataclass(frozen=True)
class Keyed:
    """The contract of a keyed table. Ranges are cut from ``number``, within each value of ``part``. Of rows with one
    key the greatest in ``newest`` wins, NULL being smallest; without such columns what comes later wins."""

    schema: T.StructType
    keys: tuple[str, ...]
    number: str
    part: str
    newest: tuple[str, ...] = ()

    @property
    def stored(self) -> T.StructType:
        marks = [T.StructField(FIRST, T.LongType()), T.StructField(SINCE, T.LongType())]
        return T.StructType([*nullable(self.schema).fields, *marks])

    def label(self, bits: int) -> Column:
        """The range of a row, as its folder is named."""
        parts = (F.col(self.part), F.shiftright(F.col(self.number), bits))
        return F.concat_ws("-", *[F.coalesce(part.cast("string"), F.lit("none")) for part in parts])


def range_of(folder: str) -> str:
    return folder.rsplit("=", 1)[1]


def part_of(folder: str) -> str:
    return range_of(folder).rsplit("-", 1)[0]


def _written(attempt: str) -> int:
    return int(attempt.split("-", 1)[0])


def range_bits(version: Version, default: int) -> int:
    """A table keeps the width of its ranges, unless a merge widens them."""
    return version.notes.get(BITS, default)


def _wider(label: str, more: int) -> tuple[str, str]:
    part, number = _LABEL.fullmatch(label).groups()
    return part, number if number == "none" else str(int(number) >> more)


def widened(ranges: set[str], bits: int) -> int:
    """The width at which a table has few enough ranges; ``bits`` as long as it has."""
    if len(ranges) <= RANGES:
        return bits
    more = 0
    while bits + more < WIDEST and len({_wider(label, more) for label in ranges}) > RANGES // FEWER:
        more += 1
    return bits + more


def touched_ranges(fresh: DataFrame, spec: Keyed, bits: int) -> set[str]:
    """The ranges with fresh rows: one name for up to ``2 ** bits`` numbers, as many as a manifest lists."""
    return {row[0] for row in fresh.select(spec.label(bits).alias(RANGE)).distinct().toLocalIterator()}


def newest_rows(rows: DataFrame, spec: Keyed) -> DataFrame:
    return latest_by(rows, spec.keys, spec.newest)


def _newer(spec: Keyed) -> Column:
    """Whether the new row of a key goes before the old one. Equal rows change nothing."""
    if not spec.newest:
        return F.lit(True)
    others = [name for name in spec.schema.names if name not in spec.keys]
    order = [F.struct(*[F.col(f"{side}.{name}") for name in spec.newest]) for side in ("_new", "_old")]
    tie = [F.xxhash64(*[F.col(f"{side}.{name}") for name in others]) for side in ("_new", "_old")]
    return (order[0] > order[1]) | ((order[0] == order[1]) & (tie[0] < tie[1]))


def _merged(old: DataFrame, fresh: DataFrame, spec: Keyed, number: int, bits: int) -> DataFrame:
    marked = [GONE] if GONE in fresh.columns else []
    new = newest_rows(fresh.select(*spec.schema.names, *marked), spec)
    gone = F.col(GONE) if marked else F.lit(False).alias(GONE)
    left = old.select(F.struct(*spec.stored.names).alias("_old"))
    right = new.select(F.struct(*spec.schema.names, gone).alias("_new"))
    same = [F.col(f"_old.{key}").eqNullSafe(F.col(f"_new.{key}")) for key in spec.keys]
    # Both sides have one row per key, so no key can be a hot one.
    both = left.join(right, same, "full_outer")
    wins = F.col("_old").isNull() | (F.col("_new").isNotNull() & _newer(spec))
    rows = both.withColumn("_wins", wins).where(~(F.col("_wins") & F.coalesce(F.col("_new._gone"), F.lit(False))))
    chosen = [F.when(F.col("_wins"), F.col(f"_new.{name}")).otherwise(F.col(f"_old.{name}")).alias(name) for name in spec.schema.names]
    first = F.coalesce(F.col(f"_old.{FIRST}"), F.lit(number).cast("long")).alias(FIRST)
    since = F.when(F.col("_wins"), F.lit(number).cast("long")).otherwise(F.col(f"_old.{SINCE}")).alias(SINCE)
    return rows.select(*chosen, first, since).withColumn(RANGE, spec.label(bits))


def merge(fresh: DataFrame, path: str, spec: Keyed, now: Version, bits: int, notes: dict) -> Version | None:
    """The next version after ``now``: its rows with those of ``fresh``, which may repeat keys; a row whose ``_gone``
    is true takes its key away. Only ranges with fresh rows are read and written, or all when they become too many and
    are widened. None if another writer was first."""
    spark, number = fresh.sparkSession, now.number + 1
    # Folders of a table that was replaced as a whole are no ranges.
    keyed = BITS in now.notes
    bits = range_bits(now, bits)
    touched = touched_ranges(fresh, spec, bits)
    held = {range_of(f) for f in now.folders} if keyed else set()
    wide = widened(touched | held, bits)
    if wide != bits:
        bits, touched = wide, touched | held
    hit = sorted(f for f in now.folders if range_of(f) in touched) if keyed else []
    rows = _merged(versions.rows_of(spark, path, now, spec.stored, hit), fresh, spec, number, bits)
    laid = rows.hint("rebalance", RANGE).sortWithinPartitions(RANGE, *spec.keys)
    entry = versions.write_attempt(laid, path, [RANGE], f"{number:020d}-{uuid.uuid4().hex}")

    def step(current: Version) -> list[versions.Entry] | None:
        if current.number != now.number:
            return None
        kept = [versions.Entry(e.attempt, tuple(f for f in e.folders if range_of(f) not in touched)) for e in now.entries if keyed]
        return [*(left for left in kept if left.folders), entry]

    try:
        published = versions.change(spark, path, step, spec.stored.json(), {**notes, BITS: bits})
    except Exception:
        versions.drop_attempt(spark, path, entry.attempt)
        raise
    if published is None:
        versions.drop_attempt(spark, path, entry.attempt)
    else:
        versions.expire(spark, path)
    return published


def read_keyed(
    spark: SparkSession,
    path: str,
    spec: Keyed,
    version: Version,
    fresh: DataFrame | None = None,
    parts: Collection[str] | None = None,
) -> DataFrame:
    """The rows of a version together with fresh ones. Ranges without fresh rows are scanned and nothing else."""
    folders = [f for f in version.folders if parts is None or part_of(f) in parts]
    names = spec.schema.names
    if fresh is None:
        return versions.rows_of(spark, path, version, spec.stored, sorted(folders)).select(*names)
    if not folders:
        return newest_rows(fresh.select(*names), spec)
    touched = touched_ranges(fresh, spec, version.notes[BITS])
    hit = sorted(f for f in folders if range_of(f) in touched)
    rest = sorted(f for f in folders if range_of(f) not in touched)
    both = versions.rows_of(spark, path, version, spec.stored, hit).select(*names).unionByName(fresh.select(*names))
    collapsed = newest_rows(both, spec)
    return collapsed.unionByName(versions.rows_of(spark, path, version, spec.stored, rest).select(*names)) if rest else collapsed


def changed_since(spark: SparkSession, path: str, spec: Keyed, version: Version, number: int) -> DataFrame:
    """The rows of ``version`` that came or were replaced after version ``number``, with the version that brought the
    key. A row that changed twice is there once, as it is now."""
    folders: Sequence[str] = [f for entry in version.entries if _written(entry.attempt) > number for f in entry.folders]
    return versions.rows_of(spark, path, version, spec.stored, sorted(folders)).where(F.col(SINCE) > number)
