"""Records of micro-batches, and keys that the state store has seen."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from medallion.schemas import RAW_EVENTS, STREAM_BATCHES
from medallion.session import configure
from medallion.sources.tables import read_table
from medallion.streaming import queries as streams
from medallion.streaming import records


def test_lag_is_told_by_sources_that_know_it():
    assert records.rows_behind([]) is None and records.rows_behind([{"metrics": {}}, {"metrics": None}, {}]) is None
    assert records.rows_behind([{"metrics": {"maxOffsetsBehindLatest": "7"}}, {"metrics": {"maxOffsetsBehindLatest": "5"}}]) == 12
    row = records.batch_row({"timestamp": "t", "id": "q", "runId": "r", "batchId": 3, "numInputRows": 9})
    assert row["rows_in"] == 9 and row["duration_sec"] == 0 and set(row) == set(STREAM_BATCHES.names)


def test_records_that_cannot_be_written_are_kept(spark, tmp_path, monkeypatch):
    kept = records.BatchRecords(spark, str(tmp_path / "runs"))
    kept._rows.append({**dict.fromkeys(STREAM_BATCHES.names), "query_name": "a"})

    def fail(*_):
        raise OSError("no room")

    with monkeypatch.context() as patch:
        patch.setattr(records.audit, "record", fail)
        with pytest.raises(OSError, match="no room"):
            kept.flush()
    kept.flush()
    kept.flush()
    assert [row["query_name"] for row in read_table(spark, str(tmp_path / "runs"), STREAM_BATCHES).collect()] == ["a"]


def test_batches_and_errors_are_recorded(spark, tmp_path):
    for part in range(3):
        spark.range(part, part + 4).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))

    def fail(batch, identity, epoch):
        raise RuntimeError("bad sink")

    with records.recorded_batches(spark, str(tmp_path / "runs"), every=0.2):
        streams.run_stream(stream, lambda batch, q, n: batch.count(), str(tmp_path / "cp"), name="good").awaitTermination()
        with pytest.raises(StreamingQueryException):
            streams.run_stream(stream, fail, str(tmp_path / "cp2"), name="bad").awaitTermination()
    # A query that starts behind the block is not recorded.
    streams.run_stream(stream, lambda batch, q, n: batch.count(), str(tmp_path / "cp3")).awaitTermination()
    found = read_table(spark, str(tmp_path / "runs"), STREAM_BATCHES)
    done = found.where(F.col("status") == records.DONE).orderBy("batch").collect()
    assert [(row["query_name"], row["batch"], row["rows_in"]) for row in done] == [("good", n, 4) for n in range(3)]
    assert all(row["duration_sec"] > 0 for row in done) and len({row["run_id"] for row in done}) == 1
    ends = {row["query_name"]: (row["status"], "bad sink" in (row["message"] or "")) for row in found.where("batch IS NULL").collect()}
    assert ends == {"good": (records.STOPPED, False), "bad": (records.FAILED, True)}


def queue(spark, offsets, arrived="2024-02-01T00:00:00Z"):
    rows = spark.createDataFrame([(n,) for n in offsets], "kafka_offset long")
    fixed = {"source": "s", "stream_id": "s0", "kafka_topic": "t", "tablet_index": 0, "kafka_partition": 0, "ingested_at": arrived}
    frame = rows.withColumns({name: F.lit(value) for name, value in fixed.items()})
    return frame.select(*[(F.col(f.name) if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in RAW_EVENTS.fields])


def test_repeats_are_known_after_a_restart(spark, tmp_path):
    configure(spark)
    raw, bronze = str(tmp_path / "raw"), str(tmp_path / "bronze")

    def run():
        stream = streams.read_queue(spark, raw)
        streams.raw_to_bronze(stream, bronze, str(tmp_path / "cp"), once_within="1 hour").awaitTermination()
        return sorted(row[0] for row in spark.read.parquet(bronze).select("row_index").collect())

    streams.write_epoch(queue(spark, [1, 2, 2]), raw, "q", 0, ["tablet_index"])
    assert run() == [1, 2]
    # Old and unreadable arrival times are no reason to drop a row.
    streams.write_epoch(queue(spark, [2, 3], "2001-01-01T00:00:00Z"), raw, "q", 1, ["tablet_index"])
    streams.write_epoch(queue(spark, [1, 4], None), raw, "q", 2, ["tablet_index"])
    assert run() == [1, 2, 3, 4]
