"""A record of every micro-batch: rows, lag, seconds, and the error a query ended with.

Spark reports batches to a listener as they end, whatever the query's sink is. The listener only keeps what it is told,
so that it holds up no query; a thread of its own writes the records, at most ``every`` seconds later. A driver that is
lost takes those seconds' records with it, never rows: what a stream has done is told by its checkpoint alone.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from medallion.operators import audit
from medallion.schemas import STREAM_BATCHES

DONE, FAILED, STOPPED = "done", "failed", "stopped"


def rows_behind(sources: list[Mapping[str, Any]]) -> int | None:
    """How many rows a batch left unread at its sources; None where no source tells it, as files don't."""
    told = [source["metrics"]["maxOffsetsBehindLatest"] for source in sources if "maxOffsetsBehindLatest" in (source.get("metrics") or {})]
    return sum(int(behind) for behind in told) if told else None


def batch_row(progress: Mapping[str, Any]) -> dict[str, Any]:
    """The record of a finished batch, from Spark's report as JSON."""
    return {
        "event_at": progress["timestamp"],
        "query_id": progress["id"],
        "run_id": progress["runId"],
        "query_name": progress.get("name"),
        "batch": progress["batchId"],
        "rows_in": progress["numInputRows"],
        "rows_behind": rows_behind(progress.get("sources", [])),
        "duration_sec": progress.get("durationMs", {}).get("triggerExecution", 0) / 1000,
        "status": DONE,
        "message": None,
    }


class BatchRecords(StreamingQueryListener):
    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path
        self._rows: list[dict[str, Any]] = []
        self._names: dict[str, str | None] = {}
        self._ended: set[str] = set()
        self._guard, self._writing = threading.Lock(), threading.Lock()

    def onQueryStarted(self, event) -> None:
        with self._guard:
            self._names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        row = batch_row(json.loads(event.progress.json))
        with self._guard:
            self._rows.append(row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        with self._guard:
            row = {
                "event_at": audit.utc_now(),
                "query_id": str(event.id),
                "run_id": run,
                "query_name": self._names.get(run),
                "status": FAILED if event.exception else STOPPED,
                "message": event.exception,
            }
            self._rows.append({**dict.fromkeys(STREAM_BATCHES.names), **row})
            self._ended.add(run)

    def flush(self) -> None:
        """Write what was reported so far. Records that cannot be written are kept for the next time."""
        with self._writing:
            with self._guard:
                rows, self._rows = self._rows, []
            if not rows:
                return
            try:
                audit.record(self._spark, rows, STREAM_BATCHES, self._path)
            except Exception:
                with self._guard:
                    self._rows = rows + self._rows
                raise

    def settle(self, seconds: float = 60) -> bool:
        """Wait until the end of every query that has ended is reported: reports come a little later."""
        until = time.monotonic() + seconds
        while True:
            running = {str(query.runId) for query in self._spark.streams.active}
            with self._guard:
                if self._names.keys() - running <= self._ended:
                    return True
            if time.monotonic() > until:
                return False
            time.sleep(0.05)


@contextmanager
def recorded_batches(spark: SparkSession, path: str, every: float = 60) -> Iterator[BatchRecords]:
    """Record the batches of all queries that the session starts in the block."""
    records, stop = BatchRecords(spark, path), threading.Event()

    def write() -> None:
        while not stop.wait(every):
            try:
                records.flush()
            except Exception as error:  # they are kept; the last flush raises
                print(f"batch records wait: {audit.error_text(error)[:200]}")

    writer = threading.Thread(target=write, daemon=True)
    spark.streams.addListener(records)
    writer.start()
    try:
        yield records
    finally:
        records.settle()
        spark.streams.removeListener(records)
        stop.set()
        writer.join()
        records.flush()
