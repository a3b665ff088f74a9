"""Queue -> bronze -> typed silver tables, as row mappings that serve batches and streams alike."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.conform import conform
from medallion.operators.dedup import latest_by
from medallion.schemas import BRONZE_STREAM, STREAMING_COMMENTS, STREAMING_POSTS, STREAMING_TODOS, table

BRONZE_KEY = ("stream_id", "row_index")
NEWEST = ("processed_at", "queue_timestamp")
# Stored tables carry the topic next to the contract, as offsets are counted anew in each.
TOPIC = "_topic"
OFFSET_BITS = 48


def row_index() -> Column:
    """A row number that a replay reproduces: the topic's partition above, the offset below. It doesn't depend on
    how many partitions there are, so a topic can grow."""
    return F.shiftleft(F.col("kafka_partition").cast("long"), OFFSET_BITS) + F.col("kafka_offset")


def topic_bronze_rows(raw: DataFrame, processed_at: Column) -> DataFrame:
    """Bronze rows of queue rows with their topic, as they are stored; ``queue_timestamp`` is the arrival time in
    microseconds."""
    stored = T.StructType([*BRONZE_STREAM.fields, T.StructField(TOPIC, T.StringType())])
    rows = raw.withColumns(
        {
            "row_index": row_index(),
            "queue_timestamp": F.unix_micros(F.col("ingested_at").try_cast("timestamp")),
            "processed_at": processed_at,
            TOPIC: F.col("kafka_topic"),
        }
    )
    return conform(rows, stored, what="bronze stream")


def bronze_rows(raw: DataFrame, processed_at: Column) -> DataFrame:
    """Bronze rows of the queue rows of one topic, in the table's contract."""
    return topic_bronze_rows(raw, processed_at).drop(TOPIC)


def collapse(bronze: DataFrame) -> DataFrame:
    """One row per key, the latest processed: what a keyed table would hold after replays. Rows of different topics
    have different keys."""
    topic = [TOPIC] if TOPIC in bronze.columns else []
    return latest_by(bronze, [*topic, *BRONZE_KEY], NEWEST)


@dataclass(frozen=True)
class PayloadSpec:
    """A typed silver table: which source it takes, and which payload field becomes which column."""

    name: str
    source: str
    tablet_index: int
    fields: dict[str, str]
    payload: T.StructType
    schema: T.StructType


# The three sources, their queue partitions and payload fields.
PAYLOADS = {
    spec.name: spec
    for spec in (
        PayloadSpec(
            name="streaming_posts",
            source="jsonplaceholder_posts",
            tablet_index=0,
            fields={"post_id": "id", "user_id": "userId", "title": "title", "body": "body"},
            payload=table(long="id userId", string="title body"),
            schema=STREAMING_POSTS,
        ),
        PayloadSpec(
            name="streaming_comments",
            source="jsonplaceholder_comments",
            tablet_index=1,
            fields={"comment_id": "id", "post_id": "postId", "name": "name", "email": "email", "body": "body"},
            payload=table(long="id postId", string="name email body"),
            schema=STREAMING_COMMENTS,
        ),
        PayloadSpec(
            name="streaming_todos",
            source="jsonplaceholder_todos",
            tablet_index=2,
            fields={"todo_id": "id", "user_id": "userId", "title": "title", "completed": "completed"},
            payload=table(long="id userId", string="title", boolean="completed"),
            schema=STREAMING_TODOS,
        ),
    )
}


def payload_rows(bronze: DataFrame, spec: PayloadSpec, processed_at: Column, keep: Sequence[str] = ()) -> DataFrame:
    """The typed silver rows of one source. A field of the wrong type is NULL, as is every field of bad JSON.
    Text columns to ``keep`` follow the contract."""
    payload = F.from_json(F.coalesce("payload_json", F.lit("{}")), spec.payload)
    chosen = bronze.where((F.col("tablet_index") == spec.tablet_index) & (F.col("source") == spec.source))
    rows = chosen.withColumn("_payload", payload).withColumns(
        {
            **{column: F.col(f"_payload.{name}") for column, name in spec.fields.items()},
            "silver_processed_at": processed_at,
        }
    )
    schema = T.StructType([*spec.schema.fields, *[T.StructField(name, T.StringType()) for name in keep]])
    return conform(rows, schema, what=spec.name)
