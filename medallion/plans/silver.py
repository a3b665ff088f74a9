"""Bronze to silver, incrementally."""

from __future__ import annotations

import datetime as dt
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.operators import audit
from medallion.operators.dedup import fact_dedup
from medallion.operators.enrich import build_silver, load_decoders
from medallion.operators.increment import OVERLAP_HOURS, choose_mode, newest_load, overlap_selection, unseen
from medallion.operators.indexing import dense_index
from medallion.plans.key_filters import refresh_key_filters, unseen_by_filters
from medallion.plans.lake import (
    ATTEMPT,
    BRONZE_LEDGER,
    SILVER_LEDGER,
    Lake,
    new_attempt,
    read_facts,
    read_silver_rows,
    second_text,
    write_rows,
)
from medallion.schemas import CATEGORY_DIM, DEVICE_DIM, FACT, LAYER_RUNS
from medallion.session import scratch_path
from medallion.sources.files import FILES_PER_JOB
from medallion.sources.reference import read_reference
from medallion.sources.tables import append, nullable, optional_table, read_table, table_or_empty, write_once

LOADER = "bronze_to_silver"


@dataclass(frozen=True)
class SilverResult:
    mode: str
    n_selected: int
    n_after_dedup: int
    n_silver: int

    @property
    def n_duplicates(self) -> int:
        return self.n_selected - self.n_after_dedup


def refresh_silver(
    spark: SparkSession,
    lake: Lake,
    batch_id: str,
    now: dt.datetime | None = None,
    mode: str = "auto",
    overlap_hours: int = OVERLAP_HOURS,
    files_per_job: int = FILES_PER_JOB,
    by_filters: bool = False,
) -> SilverResult:
    """Add the bronze rows silver lacks, and record the run whether it succeeds or fails. A run that is cut short
    goes on behind the files that it has entered into the ledger. ``by_filters`` keeps filters of silver's keys and
    reads only what they let through; the rows are the same."""
    started = now or dt.datetime.now(dt.timezone.utc)
    results: list[SilverResult] = []

    def work() -> dict:
        result = _refresh(spark, lake, batch_id, second_text(started), mode, overlap_hours, files_per_job, by_filters)
        results.append(result)
        return {
            "rows_bronze_in": result.n_selected,
            "rows_after_dedup": result.n_after_dedup,
            "rows_silver_out": result.n_silver,
            "message": str(asdict(result)),
        }

    fields = {
        "batch_id": batch_id,
        "loader": LOADER,
        "source_layer": "bronze",
        "target_layer": "silver",
        "target_table": lake.silver,
    }
    audit.recorded_run(spark, lake.audit("layer_runs"), LAYER_RUNS, started, fields, work)
    return results[0]


def pending_files(spark: SparkSession, lake: Lake) -> DataFrame:
    """The loaded files that silver has not taken in, numbered: the bronze ledger without the silver ledger."""
    loaded = table_or_empty(spark, lake.ledger, BRONZE_LEDGER).select("etag", "path", "loaded_at").dropDuplicates(["etag"])
    taken = optional_table(spark, lake.silver_ledger, SILVER_LEDGER)
    if taken is not None:
        loaded = loaded.join(taken.select("etag").where("etag IS NOT NULL").distinct(), "etag", "left_anti")
    return write_once(dense_index(loaded, ["loaded_at", "path", "etag"], "number"), scratch_path(spark, "pending"))


def _refresh(
    spark: SparkSession,
    lake: Lake,
    batch_id: str,
    built_at: str,
    mode: str,
    overlap_hours: int,
    files_per_job: int,
    by_filters: bool,
) -> SilverResult:
    """Catch up file by file, a bounded number in each job, or look at the latest loads once more."""
    pending = pending_files(spark, lake)
    chosen = choose_mode(pending, mode)
    if chosen == "increment":
        newest = newest_load(optional_table(spark, lake.silver_ledger, SILVER_LEDGER))
        fact = _facts(spark, lake)
        selected = overlap_selection(fact, newest, overlap_hours)
        return _take_in(spark, lake, batch_id, built_at, chosen, selected, None, by_filters)
    total = SilverResult(chosen, 0, 0, 0)
    for first in range(0, pending.count(), files_per_job):
        number = F.col("number")
        part = pending.where((number >= first) & (number < first + files_per_job))
        # At most ``files_per_job`` hashes.
        hashes = F.broadcast(part.select(F.col("etag").alias("_file_hash")))
        selected = _facts(spark, lake).join(hashes, "_file_hash", "left_semi")
        done = _take_in(spark, lake, batch_id, built_at, chosen, selected, part, by_filters)
        total = SilverResult(
            chosen,
            total.n_selected + done.n_selected,
            total.n_after_dedup + done.n_after_dedup,
            total.n_silver + done.n_silver,
        )
    return total


def _facts(spark: SparkSession, lake: Lake) -> DataFrame:
    facts = read_facts(spark, lake)
    return spark.createDataFrame([], nullable(FACT)) if facts is None else facts


def _take_in(
    spark: SparkSession,
    lake: Lake,
    batch_id: str,
    built_at: str,
    mode: str,
    selected: DataFrame,
    files: DataFrame | None,
    by_filters: bool,
) -> SilverResult:
    """One write, with its counts observed while it runs; then the ledger entry that makes it count."""
    attempt = new_attempt()
    rows_in, n_selected = audit.counting(selected)
    newest, n_dedup = audit.counting(fact_dedup(rows_in))
    if by_filters:
        fresh = unseen_by_filters(spark, lake, newest, selected)
    else:
        fresh = unseen(newest, selected, read_silver_rows(spark, lake))
    decoders = load_decoders(read_table(spark, lake.dims, CATEGORY_DIM), read_table(spark, lake.devices, DEVICE_DIM))
    reference = read_reference(spark, lake.reference)
    rows = build_silver(fresh, decoders, reference, batch_id, built_at, keys_from=selected)
    rows_out, n_out = audit.counting(rows)
    write_rows(rows_out, lake.silver, attempt)
    entry = {"batch_id": F.lit(batch_id), ATTEMPT: F.lit(attempt)}
    if files is None and audit.counted(n_out, lambda: 0):
        files = spark.range(1).select(F.lit(None).cast("string").alias("etag"), F.lit(None).cast("string").alias("loaded_at"))
    if files is not None:  # else late rows were looked for and none found: there is nothing to enter
        append(files.withColumns(entry).select(*SILVER_LEDGER.names).coalesce(1), lake.silver_ledger)
    if by_filters:
        refresh_key_filters(spark, lake)
    return SilverResult(
        mode,
        audit.counted(n_selected, selected.count),
        audit.counted(n_dedup, lambda: selected.select("fact_uid").distinct().count()),
        audit.counted(n_out, lambda: 0),
    )
