"""The periodic refresh of the streaming silver tables, whole or by changes, with its run records."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

from medallion.operators import audit
from medallion.schemas import STREAMING_SILVER_RUNS
from medallion.streaming.layers import PAYLOADS, PayloadSpec
from medallion.streaming.queries import apply_changes, rebuild_silver


def rebuild_all(
    spark: SparkSession, bronze_path: str | Sequence[str], silver_root: str, audit_path: str
) -> dict[str, str]:
    """Rebuild every streaming silver table, from one bronze table or those of all queue partitions; one that fails
    is recorded and does not keep back the others."""
    return _for_each_table(spark, silver_root, audit_path, lambda spec, target: rebuild_silver(spark, bronze_path, spec, target))


def refresh_from_changes(
    spark: SparkSession, bronze_path: str | Sequence[str], silver_root: str, audit_path: str
) -> dict[str, str]:
    """The same tables, brought up to the compacted part of bronze by what changed there."""
    return _for_each_table(spark, silver_root, audit_path, lambda spec, target: apply_changes(spark, bronze_path, spec, target))


def _for_each_table(
    spark: SparkSession, silver_root: str, audit_path: str, refresh: Callable[[PayloadSpec, str], object]
) -> dict[str, str]:
    run_id, outcomes = uuid.uuid4().hex, {}
    for name, spec in PAYLOADS.items():
        target = f"{silver_root.rstrip('/')}/{name}"

        def work(spec=spec, target=target) -> dict:
            refresh(spec, target)
            return {}

        fields = {"run_id": run_id, "task_id": name, "target_table": target}
        started = dt.datetime.now(dt.timezone.utc)
        try:
            audit.recorded_run(spark, audit_path, STREAMING_SILVER_RUNS, started, fields, work)
            outcomes[name] = audit.SUCCESS
        except Exception as failure:  # recorded above
            outcomes[name] = f"{audit.FAILED}: {audit.error_text(failure)}"
    return outcomes
