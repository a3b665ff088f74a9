"""Raw files to the bronze star: discover, load dimensions, write facts, record."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from medallion.operators import audit
from medallion.operators.dims import (
    category_values,
    device_values,
    new_category_rows,
    new_device_rows,
    only_stable_ids,
)
from medallion.operators.facts import build_fact, lacks_keys, load_lookups
from medallion.plans.lake import ATTEMPT, BRONZE_LEDGER, Lake, new_attempt, second_text, write_rows
from medallion.schemas import CATEGORY_DIM, DEVICE_DIM, RAW_TELEMETRY
from medallion.session import scratch_path
from medallion.sources.files import (
    FILE_SUFFIX,
    FILES_PER_JOB,
    file_columns,
    list_files,
    new_files,
    scan_files,
    spread_rows,
    stamp_batch,
    stamp_table_source,
    unreadable,
)
from medallion.sources.tables import append, optional_table, read_table, write_once
from medallion.streaming.queries import run_stream

LOADER = "raw_to_bronze"
REJECTED = T.StructType([*RAW_TELEMETRY.fields, *[T.StructField(n, T.StringType()) for n in ("_source_file", ATTEMPT)]])


@dataclass(frozen=True)
class BronzeResult:
    batch_id: str
    n_files: int
    n_facts: int
    n_new_categories: int
    n_new_devices: int
    failed: tuple[str, ...] = ()

    def plus(self, other: BronzeResult) -> BronzeResult:
        return replace(
            self,
            n_files=self.n_files + other.n_files,
            n_facts=self.n_facts + other.n_facts,
            n_new_categories=self.n_new_categories + other.n_new_categories,
            n_new_devices=self.n_new_devices + other.n_new_devices,
            failed=self.failed + other.failed,
        )


def load_dimensions(
    spark: SparkSession, raw: DataFrame, lake: Lake, loaded_at: str, random_ids: bool = False
) -> tuple[int, int]:
    """Append the natural values the dimension tables lack; returns how many categories and devices.

    New rows are written to the shared folder first, so that counting and appending see the same ids.
    """
    counts = []
    for name, values, build, path, schema, partition_by in (
        ("categories", category_values(raw), new_category_rows, lake.dims, CATEGORY_DIM, ["dim_name"]),
        ("devices", device_values(raw), new_device_rows, lake.devices, DEVICE_DIM, []),
    ):
        existing = optional_table(spark, path, schema)
        fresh = write_once(build(values, existing, loaded_at, random_ids), scratch_path(spark, name))
        n_new = fresh.count()
        if n_new:
            append(fresh, path, partition_by)
        counts.append(n_new)
    return counts[0], counts[1]


def write_facts(spark: SparkSession, raw: DataFrame, lake: Lake, attempt: str) -> int:
    """Write the facts of one attempt; the row count is observed during the write. Whichever ids the dimension
    tables hold, those are the facts' ids."""
    devices = read_table(spark, lake.devices, DEVICE_DIM)
    lookups = load_lookups(read_table(spark, lake.dims, CATEGORY_DIM), None if only_stable_ids(devices) else devices)
    fact, seen = audit.counting(build_fact(raw, lookups))
    write_rows(fact, lake.fact, attempt)
    return audit.counted(seen, lambda: 0)


def ingest_frame(
    spark: SparkSession, raw: DataFrame, lake: Lake, loaded_at: str, attempt: str, random_ids: bool = False
) -> tuple[int, int, int]:
    """Dimensions, then facts, of raw telemetry that carries its lineage columns."""
    n_categories, n_devices = load_dimensions(spark, raw, lake, loaded_at, random_ids)
    return write_facts(spark, raw, lake, attempt), n_categories, n_devices


def commit(spark: SparkSession, lake: Lake, attempt: str, loaded_at: str, files: list[dict]) -> None:
    """Enter the files of an attempt into the ledger, as one file: from then on their facts are read."""
    fields = BRONZE_LEDGER.names
    rows = [tuple({**row, ATTEMPT: attempt, "loaded_at": loaded_at}[name] for name in fields) for row in files]
    append(spark.createDataFrame(rows, BRONZE_LEDGER).coalesce(1), lake.ledger)


def ingest_table(
    spark: SparkSession, raw: DataFrame, name: str, lake: Lake, batch_id: str, loaded_at: str
) -> BronzeResult:
    """A staging table as source instead of files. A batch that is in the ledger is not loaded again."""
    n_rows, attempt = raw.count(), new_attempt()
    stamped = stamp_table_source(raw, name, batch_id, loaded_at, n_rows)
    etag = stamped.select("_file_hash").head()
    ledger = optional_table(spark, lake.ledger, BRONZE_LEDGER)
    known = etag is None or ledger is not None and not ledger.where(F.col("etag") == etag[0]).isEmpty()
    if known:
        return BronzeResult(batch_id, 0, 0, 0, 0)
    n_facts, n_categories, n_devices = ingest_frame(spark, spread_rows(stamped, n_rows), lake, loaded_at, attempt)
    entry = {"path": name, "etag": etag[0], "size": n_rows, "part_index": 0, "batch_id": batch_id}
    commit(spark, lake, attempt, loaded_at, [entry])
    return BronzeResult(batch_id, 0, n_facts, n_categories, n_devices)


def ingest_files(
    spark: SparkSession,
    raw_root: str,
    lake: Lake,
    batch_id: str,
    now: dt.datetime | None = None,
    random_ids: bool = False,
    files_per_job: int = FILES_PER_JOB,
) -> BronzeResult | None:
    """Load all files that are new below ``raw_root``; None when there are none.

    The folder is listed once. Its new files are loaded job by job, and each job's files enter the ledger when their
    facts are written, so a run that is cut short goes on where it was. A file that can't be read, lacks columns or
    holds rows without keys fails alone: its bad rows are set aside, the file is recorded and offered again.
    One loader at a time may work on a folder.
    """
    listing = list_files(spark, raw_root)
    return load_listed(spark, listing, lake, batch_id, now, random_ids, files_per_job)


def load_listed(
    spark: SparkSession,
    listing: DataFrame,
    lake: Lake,
    batch_id: str,
    now: dt.datetime | None = None,
    random_ids: bool = False,
    files_per_job: int = FILES_PER_JOB,
) -> BronzeResult | None:
    ledger = optional_table(spark, lake.ledger, BRONZE_LEDGER)
    pending = write_once(new_files(listing, ledger), scratch_path(spark, "listing"))
    total, n_files = None, pending.count()
    for first in range(0, n_files, files_per_job):
        number = F.col("part_index")
        part = pending.where((number >= first) & (number < first + files_per_job)).orderBy("part_index")
        done = load_files(spark, [row.asDict() for row in part.collect()], lake, batch_id, now, random_ids)
        total = done if total is None else total.plus(done)
    return total


def load_files(
    spark: SparkSession,
    files: list[dict],
    lake: Lake,
    batch_id: str,
    now: dt.datetime | None = None,
    random_ids: bool = False,
) -> BronzeResult:
    """One job's files: a bounded list of path, etag, size, place and part_index.

    A file whose pages can't be read makes a scan of all files fail. Then the bad ones are searched by halving the
    list, recorded, and the rest is loaded. If every file can be read, it was not the files: the error is raised.
    """
    started = now or dt.datetime.now(dt.timezone.utc)
    outcomes = {file["path"]: dict(file, batch_id=batch_id) for file in files}
    failures: dict[str, str] = {}
    while True:
        left = [file for file in files if file["path"] not in failures]
        try:
            loaded, counts, refused = _load_readable(spark, left, outcomes, lake, batch_id, second_text(started), random_ids)
            break
        except Exception as error:
            bad = unreadable(spark, {file["path"]: file["place"] for file in left}, RAW_TELEMETRY)
            if not bad:
                _record_loads(spark, outcomes, dict.fromkeys(outcomes, audit.error_text(error)), lake, started)
                raise
            failures |= bad
    failures |= refused
    _record_loads(spark, outcomes, failures, lake, started)
    return BronzeResult(batch_id, loaded, *counts, tuple(sorted(failures)))


def _load_readable(
    spark: SparkSession, files: list[dict], outcomes: dict[str, dict], lake: Lake, batch_id: str, loaded_at: str, random_ids: bool
) -> tuple[int, tuple[int, int, int], dict[str, str]]:
    """One attempt: how many files were loaded, their facts, new categories and devices, and what is wrong with the
    others."""
    attempt, counts = new_attempt(), (0, 0, 0)
    scan = scan_files(spark, {file["path"]: file["place"] for file in files}, RAW_TELEMETRY)
    failures = dict(scan.errors)
    if scan.rows is not None:
        numbers = spark.createDataFrame([(f["path"], f["part_index"]) for f in files], "_source_file string, _part_index long")
        raw = stamp_batch(scan.rows.join(F.broadcast(numbers), "_source_file"), batch_id, loaded_at)
        failures |= _profile(raw, outcomes)
        if failures:
            good = ~F.col("_source_file").isin(*failures)
            bad = raw.where(~good & lacks_keys()).withColumn(ATTEMPT, F.lit(attempt))
            append(bad.select(*REJECTED.names), lake.rejects)
            raw = raw.where(good)
        if len(failures) < len(files):
            n_rows = sum(outcomes[f["path"]].get("source_rows", 0) for f in files if f["path"] not in failures)
            counts = ingest_frame(spark, spread_rows(raw.drop("_lost"), n_rows), lake, loaded_at, attempt, random_ids)
    loaded = [outcomes[file["path"]] for file in files if file["path"] not in failures]
    if loaded:
        commit(spark, lake, attempt, loaded_at, loaded)
    return len(loaded), counts, failures


def _profile(raw: DataFrame, outcomes: dict[str, dict]) -> dict[str, str]:
    """Rows, devices and lost values of each file into ``outcomes``; what is wrong with the files that can't be
    loaded. Reads the key columns and those that are cast."""
    rows = raw.groupBy("_source_file").agg(
        F.count("*").alias("source_rows"),
        F.countDistinct("device_id").alias("device_count"),
        F.count_if(lacks_keys()).alias("bad"),
        F.sum("_lost").alias("lost"),
    )
    failures = {}
    for row in rows.collect():
        outcome = outcomes[row["_source_file"]]
        outcome |= {"source_rows": row["source_rows"], "device_count": row["device_count"]}
        if row["lost"]:
            outcome["message"] = f"{row['lost']} values could not be cast"
        if row["bad"]:
            failures[row["_source_file"]] = f"{row['bad']} rows without device, id or time"
    return failures


def stream_files(
    spark: SparkSession,
    raw_root: str,
    lake: Lake,
    checkpoint: str,
    files_per_job: int = FILES_PER_JOB,
    every: str | None = None,
) -> StreamingQuery:
    """The streaming twin of ``ingest_files``: Spark's file source finds the new files, and each micro-batch loads
    those that the ledger lacks, with the same records. A micro-batch that is run again loads nothing twice."""
    listing = (
        spark.readStream.schema("path string, modificationTime timestamp, length long, content binary")
        .format("binaryFile")
        .option("maxFilesPerTrigger", str(files_per_job))
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", FILE_SUFFIX)
        .load(raw_root)
    )

    def write(batch: DataFrame, query: str, epoch: int) -> None:
        load_listed(spark, batch, lake, f"stream-{query}-{epoch:012d}", files_per_job=files_per_job)

    return run_stream(file_columns(listing), write, checkpoint, every)


def _record_loads(
    spark: SparkSession, outcomes: dict[str, dict], failures: dict[str, str], lake: Lake, started: dt.datetime
) -> None:
    now, rows = audit.utc_now(), []
    for path, outcome in outcomes.items():
        error = failures.get(path)
        n_rows = 0 if error else outcome.get("source_rows", 0)
        rows.append(
            {
                "batch_id": outcome["batch_id"],
                "loader": LOADER,
                "target_layer": "bronze",
                "file_key": path,
                "etag": outcome["etag"],
                "file_size": outcome["size"],
                "part_index": outcome["part_index"],
                "source_rows": outcome.get("source_rows"),
                "device_count": outcome.get("device_count"),
                "message": outcome.get("message"),
                "rows_inserted": n_rows,
                "fact_rows": n_rows,
                "load_status": audit.FAILED if error else audit.SUCCESS,
                "rc": 1 if error else audit.SUCCESS_RC,
                "error": error,
                "started_at": audit.iso(started),
                "finished_at": now,
            }
        )
    loads = audit.file_loads(audit.audit_frame(spark, rows, audit.FILE_LOADS), now).coalesce(1)
    append(loads, lake.audit("file_loads"))
    rolled = audit.dag_run(audit.run_rollup(loads), event_at=now, loader=LOADER, message=f"ledger={lake.ledger}")
    append(rolled, lake.audit("dag_runs"))
