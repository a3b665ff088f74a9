"""Filters of silver's keys, one for each folder of silver.

Folders of silver are never written to again, so a filter is made once, by reading the folder's keys, and goes with its
folder when days are merged. A folder that has no filter yet may hold any key: its keys are read. So filters can lag
behind, or be missing altogether, and the rows are the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.joins import lookup_join
from medallion.operators.key_filters import BITS, BLOCK, SIZE, build_filters, maybe_held
from medallion.plans.lake import DAY, Lake, committed_folders
from medallion.session import scratch_path
from medallion.sources import versions
from medallion.sources.tables import balanced, write_once
from medallion.sources.versions import ATTEMPT

KEY = "fact_uid"
# The attempt that wrote a folder of silver, in the filters' table.
SILVER_ATTEMPT = "_silver"
KEYS = T.StructType([T.StructField(DAY, T.StringType()), T.StructField(KEY, T.StringType())])
FILTERS = T.StructType(
    [
        T.StructField(SILVER_ATTEMPT, T.StringType()),
        T.StructField(DAY, T.StringType()),
        T.StructField(SIZE, T.IntegerType()),
        T.StructField(BLOCK, T.LongType()),
        *[T.StructField(name, T.BinaryType()) for name in BITS],
    ]
)


def _silver_folder(folder: str) -> str:
    """The folder of silver that a folder of filters speaks for."""
    return folder.split("/", 1)[1].replace(f"{SILVER_ATTEMPT}=", f"{ATTEMPT}=", 1)


def refresh_key_filters(spark: SparkSession, lake: Lake) -> int:
    """Make the filters that silver's folders lack and drop those of folders that are gone; returns how many were made.
    Of two runs that meet, the later one looks again. A failed run changes nothing."""
    path = lake.silver_keys
    while True:
        found = committed_folders(spark, lake.silver, lake.silver_ledger)
        if found is None:
            return 0
        source, wanted = found[0], set(found[1])
        now = versions.latest(spark, path) or versions.Version(0, ())
        made = {_silver_folder(folder) for folder in now.folders}
        lacking = sorted(wanted - made)
        if not lacking and made <= wanted:
            return 0
        kept = [versions.Entry(e.attempt, tuple(f for f in e.folders if _silver_folder(f) in wanted)) for e in now.entries]
        entries = [entry for entry in kept if entry.folders]
        new = None
        if lacking:
            keys = versions.rows_of(spark, lake.silver, source, KEYS, lacking, with_attempt=True)
            filters = build_filters(keys.withColumnRenamed(ATTEMPT, SILVER_ATTEMPT), [SILVER_ATTEMPT, DAY], KEY)
            by = [SILVER_ATTEMPT, DAY]
            new = versions.write_attempt(balanced(filters.select(*FILTERS.names), *by), path, by)
            entries.append(new)

        def step(current: versions.Version) -> list[versions.Entry] | None:
            return entries if current.number == now.number else None

        try:
            published = versions.change(spark, path, step, FILTERS.json())
        except Exception:
            if new:
                versions.drop_attempt(spark, path, new.attempt)
            raise
        if published is not None:
            versions.expire(spark, path)
            return len(lacking)
        if new:
            versions.drop_attempt(spark, path, new.attempt)


def unseen_by_filters(spark: SparkSession, lake: Lake, candidates: DataFrame, selected: DataFrame) -> DataFrame:
    """``increment.unseen`` with filters: of silver, only folders are read that may hold a key of the selection, and of
    their keys only those that may be there are shuffled. Stores these keys in the shared folder before it returns."""
    found = committed_folders(spark, lake.silver, lake.silver_ledger)
    if found is None:
        return candidates
    source, folders = found[0], set(found[1])
    state = versions.latest(spark, lake.silver_keys) or versions.Version(0, ())
    current = {_silver_folder(folder): folder for folder in state.folders if _silver_folder(folder) in folders}
    filters = versions.rows_of(spark, lake.silver_keys, state, FILTERS, sorted(current.values()))
    maybe = maybe_held(selected.select(DAY, KEY), filters, [SILVER_ATTEMPT, DAY], DAY, KEY)
    maybe = write_once(maybe, scratch_path(spark, "maybe"))
    # At most as many as silver has folders.
    places = maybe.select(SILVER_ATTEMPT, DAY).distinct().collect()
    hit = sorted(f"{ATTEMPT}={row[0]}/{DAY}={row[1]}" for row in places)
    held = versions.rows_of(spark, lake.silver, source, KEYS, hit).select(KEY)
    present = lookup_join(held, maybe.select(KEY).distinct(), KEY, "left_semi")
    # Folders without a filter: their days are compared whole.
    days = selected.select(DAY).distinct()
    open_folders = sorted(folders - current.keys())
    others = versions.rows_of(spark, lake.silver, source, KEYS, open_folders).join(days, DAY, "left_semi").select(KEY)
    return candidates.join(present.unionByName(others), KEY, "left_anti")
