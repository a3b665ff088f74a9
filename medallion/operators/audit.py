"""Run records: what was loaded, when, with which outcome."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.conform import conform
from medallion.operators.dedup import latest_by
from medallion.schemas import DAG_RUNS, FILE_LOADS
from medallion.sources.tables import nullable

SUCCESS = "SUCCESS"
FAILED = "FAILED"
SUCCESS_RC = 0
_MICROS = 1_000_000


def utc_now() -> str:
    return iso(dt.datetime.now(dt.timezone.utc))


def duration_seconds(started_at: str | Column, finished_at: str | Column) -> Column:
    """Seconds between two ISO times: never negative, NULL when either is missing or unreadable."""

    def micros(value: str | Column) -> Column:
        return F.unix_micros((F.col(value) if isinstance(value, str) else value).try_cast("timestamp"))

    span = (micros(finished_at) - micros(started_at)) / F.lit(_MICROS)
    return F.when(span.isNotNull(), F.greatest(span, F.lit(0.0)))


def status_of(rc: str | Column) -> Column:
    value = F.col(rc) if isinstance(rc, str) else rc
    return F.when(value == SUCCESS_RC, F.lit(SUCCESS)).otherwise(F.lit(FAILED))


def file_row_counts(rows: DataFrame, keys: Iterable[str] = ("_source_file", "_part_index")) -> DataFrame:
    """Rows per loaded file."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows"))


def file_loads(items: DataFrame, event_at: str) -> DataFrame:
    """File-load records of loaded files; fields the items lack are NULL."""
    rows = items.withColumns(
        {"event_at": F.lit(event_at), "duration_sec": duration_seconds("started_at", "finished_at")}
    )
    absent = {f.name: F.lit(None).cast(f.dataType) for f in FILE_LOADS.fields if f.name not in rows.columns}
    return conform(rows.withColumns(absent) if absent else rows, FILE_LOADS, what="file_loads")


def run_rollup(loads: DataFrame) -> DataFrame:
    """One record per batch from its file loads. Times are fixed-width ISO text, compared as timestamps."""
    ok = F.col("load_status") == SUCCESS
    rolled = loads.groupBy("batch_id").agg(
        F.min(F.col("started_at").try_cast("timestamp")).alias("_started"),
        F.max(F.col("finished_at").try_cast("timestamp")).alias("_finished"),
        F.count("*").alias("total_items"),
        F.count_if(ok).alias("success_items"),
        F.count_if(~F.coalesce(ok, F.lit(False))).alias("failed_items"),
    )
    failed = F.col("failed_items")
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    return rolled.select(
        "batch_id",
        F.date_format("_started", iso).alias("started_at"),
        F.date_format("_finished", iso).alias("finished_at"),
        F.when(
            F.col("_started").isNotNull() & F.col("_finished").isNotNull(),
            F.greatest((F.unix_micros("_finished") - F.unix_micros("_started")) / F.lit(_MICROS), F.lit(0.0)),
        ).alias("duration_sec"),
        F.when(failed == 0, F.lit(SUCCESS)).otherwise(F.lit(FAILED)).alias("status"),
        "total_items",
        "success_items",
        "failed_items",
        F.lit(0).cast("long").alias("skipped_items"),
        F.when(failed > 0, F.concat_ws(" ", failed, F.lit("of"), "total_items", F.lit("files failed"))).alias("error"),
    )


def last_success(runs: DataFrame, by: str = "mart", finished_at: str = "finished_at") -> DataFrame:
    """The latest successful run of each mart."""
    return latest_by(runs.where(F.col("load_status") == SUCCESS), [by], [finished_at])


def audit_frame(spark: SparkSession, rows: Iterable[Mapping[str, Any]], schema: T.StructType) -> DataFrame:
    """Audit records, one per run, as a frame; unknown fields are refused, absent ones are NULL."""
    records = []
    for row in rows:
        unknown = set(row) - set(schema.names)
        if unknown:
            raise ValueError(f"unknown audit fields {sorted(unknown)}")
        records.append(tuple(row.get(name) for name in schema.names))
    return spark.createDataFrame(records, nullable(schema))


def record(spark: SparkSession, rows: Iterable[Mapping[str, Any]], schema: T.StructType, path: str) -> None:
    audit_frame(spark, rows, schema).coalesce(1).write.mode("append").parquet(path)


def counting(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame with its rows counted by whichever job runs it."""
    seen = Observation()
    return df.observe(seen, F.count("*").alias("n")), seen


def counted(seen: Observation, otherwise: Callable[[], int]) -> int:
    """The observed count. When Spark finds at run time that the result is empty it drops the plan below,
    observations included; only then is ``otherwise`` computed."""
    try:
        return seen.get["n"]
    except (Py4JJavaError, KeyError):
        return otherwise()


def error_text(failure: Exception) -> str:
    """The whole text of a failure."""
    return f"{type(failure).__name__}: {failure}"


def iso(moment: dt.datetime) -> str:
    return moment.strftime("%Y-%m-%dT%H:%M:%SZ")


def recorded_run(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    started: dt.datetime,
    fields: Mapping[str, Any],
    work: Callable[[], Mapping[str, Any]],
) -> Mapping[str, Any]:
    """Do the work, then append its run record: its counts when it succeeds, its error when it fails."""
    outcome: Mapping[str, Any] = {}
    status, rc, error = FAILED, 1, None
    try:
        outcome = work()
        status, rc = SUCCESS, SUCCESS_RC
        return outcome
    except Exception as failure:
        error = error_text(failure)
        raise
    finally:
        finished = dt.datetime.now(dt.timezone.utc)
        names = {
            "event_at": utc_now(),
            "load_status": status,
            "status": status.lower(),
            "started_at": iso(started),
            "start_ts": iso(started),
            "finished_at": iso(finished),
            "end_ts": iso(finished),
            "duration_sec": elapsed(started, finished),
            "rc": rc,
            "error": error,
            "error_message": error or "",
            **fields,
            **outcome,
        }
        record(spark, [{name: value for name, value in names.items() if name in schema.names}], schema, path)


def elapsed(started: dt.datetime, finished: dt.datetime) -> float:
    return max((finished - started).total_seconds(), 0.0)


def dag_run(rolled: DataFrame, **fields: str | None) -> DataFrame:
    """Run records with the context of the run added, in the contract of the run table."""
    rows = rolled.withColumns({name: F.lit(value).cast("string") for name, value in fields.items()})
    absent = {f.name: F.lit(None).cast(f.dataType) for f in DAG_RUNS.fields if f.name not in rows.columns}
    return conform(rows.withColumns(absent) if absent else rows, DAG_RUNS, what="dag_runs")
