"""Raw parquet files: discovery, lineage, scan."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.indexing import dense_index
from medallion.sources.versions import escaped, nullable

FILE_SUFFIX = "*.parquet"
# Files that one job loads. More are loaded by further jobs of the same run, each with its own ledger entry.
FILES_PER_JOB = 1_000
_FOOTERS_AT_ONCE = 16
# Rows that one task makes facts of: some hundred megabytes of them.
ROWS_PER_TASK = 50_000


def file_tag(path: str, size: str, modified: str) -> F.Column:
    """Identity of one version of a file: replacing a file gives a new tag."""
    return F.sha2(F.concat_ws("|", F.col(path), F.col(size).cast("string"), F.col(modified).cast("string")), 256)


def file_columns(listing: DataFrame) -> DataFrame:
    """(path, etag, size, place) of a binary-file listing, batch or stream. ``path`` is the form that
    ``_metadata.file_path`` has in a scan, ``place`` the one that opens the file. Contents are not read."""
    named = listing.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.unix_micros("_metadata.file_modification_time").alias("_modified"),
        F.col("path").alias("place"),
    )
    return named.select("path", file_tag("path", "size", "_modified").alias("etag"), "size", "place")


def list_files(spark: SparkSession, root: str, pattern: str = FILE_SUFFIX) -> DataFrame:
    """Every matching file below ``root``; see ``file_columns``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return file_columns(files.option("pathGlobFilter", pattern).load(root))


def new_files(listing: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Files the ledger does not know yet, numbered 0, 1, 2, … by path."""
    fresh = listing if ledger is None else listing.join(ledger.select("etag").distinct(), "etag", "left_anti")
    return dense_index(fresh.select(*listing.columns), ["path"], "part_index")


def ledger_rows(results: DataFrame, loaded_at: str) -> DataFrame:
    """Ledger entries of the files that were loaded; failed ones stay pending."""
    loaded = results.where(F.col("load_status") == "SUCCESS")
    return loaded.select("path", "etag", "size", "part_index", "batch_id", F.lit(loaded_at).alias("loaded_at"))


def with_file_lineage(scan: DataFrame) -> DataFrame:
    """A file scan with the path and version tag of each row's file."""
    tag = F.sha2(
        F.concat_ws(
            "|",
            F.col("_metadata.file_path"),
            F.col("_metadata.file_size").cast("string"),
            F.unix_micros("_metadata.file_modification_time").cast("string"),
        ),
        256,
    )
    return scan.withColumns({"_source_file": F.col("_metadata.file_path"), "_file_hash": tag})


@dataclass(frozen=True)
class RawScan:
    """The readable files of one job as one frame, and what is wrong with the others."""

    rows: DataFrame | None
    errors: dict[str, str]


def scan_files(spark: SparkSession, places: Mapping[str, str], schema: T.StructType) -> RawScan:
    """Files (path -> place) read with their own types and then cast to the contract, with their lineage.

    The files of a job are grouped by the schema in their footers, one scan a group. ``_lost`` counts the values of
    a row that could not be cast. Files that can't be opened, lack columns or hold a type that no cast leads from are
    reported by path.
    """

    def footer(item: tuple[str, str]) -> tuple[str, T.StructType | str]:
        try:
            found = spark.read.parquet(escaped(item[1])).schema
        except Exception as error:
            return item[0], f"{type(error).__name__}: {error}"
        absent = [name for name in schema.names if name not in found.names]
        return item[0], f"lacks columns {absent}" if absent else found

    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    errors: dict[str, str] = {}
    with ThreadPoolExecutor(_FOOTERS_AT_ONCE) as pool:
        for path, found in pool.map(footer, places.items()):
            if isinstance(found, str):
                errors[path] = found
            else:
                groups.setdefault(found.json(), (found, []))[1].append(escaped(places[path]))
    parts = []
    opened = {escaped(place): path for path, place in places.items()}
    for found, paths in groups.values():
        try:
            counted_casts(spark.createDataFrame([], found), schema)
        except AnalysisException as error:
            errors |= {opened[place]: f"{type(error).__name__}: {error}" for place in paths}
            continue
        scan = with_file_lineage(spark.read.schema(nullable(found)).parquet(*paths).select(*schema.names, "_metadata"))
        parts.append(counted_casts(scan.drop("_metadata"), schema))
    return RawScan(reduce(DataFrame.unionByName, parts) if parts else None, errors)


def unreadable(spark: SparkSession, places: Mapping[str, str], schema: T.StructType) -> dict[str, str]:
    """Which files (path -> place) make a scan of all their columns fail, and why.

    Group testing: a list that can be read as a whole is done; one that can't is halved until the bad files stand
    alone. The second half is not scanned to learn what follows from the first. One bad file among 1,000 takes some
    fifteen scans, of twice the list in all.
    """

    def error_of(paths: list[str]) -> str | None:
        scan = scan_files(spark, {path: places[path] for path in paths}, schema)
        try:
            if scan.rows is not None:
                scan.rows.write.format("noop").mode("overwrite").save()
        except Exception as error:
            return f"{type(error).__name__}: {error}"
        return None

    def among(paths: list[str], error: str) -> dict[str, str]:
        if len(paths) == 1:
            return {paths[0]: error}
        halves = paths[: len(paths) // 2], paths[len(paths) // 2 :]
        first = error_of(halves[0])
        found = among(halves[0], first) if first else {}
        second = error_of(halves[1]) if first else error
        return found | (among(halves[1], second) if second else {})

    every = sorted(places)
    error = error_of(every) if every else None
    return among(every, error) if error else {}


def counted_casts(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The contract's columns in its types, and in ``_lost`` how many values of the row became NULL by that."""
    kinds = {field.name: field.dataType for field in df.schema.fields}
    casts = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields if kinds[f.name] != f.dataType}
    lost = F.lit(0)
    for name, value in casts.items():
        lost = lost + (F.col(name).isNotNull() & value.isNull()).cast("int")
    return df.select(
        *[casts.get(name, F.col(name)).alias(name) for name in schema.names],
        *[name for name in df.columns if name not in schema.names],
        lost.alias("_lost"),
    )


def spread(df: DataFrame) -> DataFrame:
    """Use all cores when a scan has fewer splits than there are cores, as with a few unsplittable files.

    A scan of many files has far more splits than cores and is left as it is: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def spread_rows(df: DataFrame, n_rows: int) -> DataFrame:
    """So many rows over as many tasks as they need. A parquet file can't be split below its row groups: a scan of few
    files leaves most rows to few tasks, however many splits it has. Do it while rows are narrow."""
    tasks = -(-n_rows // ROWS_PER_TASK)
    return df.repartition(tasks) if tasks > 1 else df


def stamp_batch(df: DataFrame, batch_id: str, loaded_at: str, part_index: int | None = None) -> DataFrame:
    """Batch lineage. Without a number the part index must already be there."""
    stamped = df.withColumns({"_batch_id": F.lit(batch_id), "_loaded_at": F.lit(loaded_at)})
    return stamped if part_index is None else stamped.withColumn("_part_index", F.lit(part_index).cast("long"))


def stamp_table_source(df: DataFrame, name: str, batch_id: str, loaded_at: str, n_rows: int) -> DataFrame:
    """Lineage of a batch read from a staging table instead of files."""
    tag = F.sha2(F.lit(f"{name}|{batch_id}|{n_rows}"), 256)
    return stamp_batch(
        df.withColumns({"_source_file": F.lit(name), "_file_hash": tag}), batch_id, loaded_at, part_index=0
    )
