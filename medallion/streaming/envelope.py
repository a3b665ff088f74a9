"""The event envelope: building, publishing, parsing, routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.conform import conform
from medallion.schemas import ENVELOPE, RAW_EVENTS
from medallion.sources.tables import nullable

# Queue partition per stream; every other stream goes to partition 0, a missing one is s0.
DEFAULT_STREAM = "s0"
STREAM_PARTITIONS = {"s0": 0, "s1": 1, "s2": 2}
DEFAULT_PARTITION = 0

_CORRUPT = "_corrupt"
_OBJECT = T.StructType([T.StructField("source", T.StringType())])
_ELEMENTS = T.ArrayType(_OBJECT)
_MEMBER = T.StructType([T.StructField("m", _OBJECT)])


def payload_text(columns: Sequence[str]) -> Column:
    """The named columns as one JSON object; NULLs are written and non-ASCII text is kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def build_envelopes(
    items: DataFrame,
    source: str | Column,
    stream_id: str | Column,
    event_type: str | Column,
    entity: str,
    batch_id: str,
    now: str,
    payload: Column | None = None,
    event_ts: Column | None = None,
) -> DataFrame:
    """One envelope per item. The payload is the whole item unless another expression is given."""

    def text(value: str | Column) -> Column:
        return F.lit(value) if isinstance(value, str) else value

    envelopes = items.select(
        text(source).alias("source"),
        text(stream_id).alias("stream_id"),
        text(event_type).alias("event_type"),
        (F.lit(now) if event_ts is None else event_ts).alias("event_ts"),
        F.col(entity).cast("string").alias("entity_id"),
        (payload_text(items.columns) if payload is None else payload).alias("payload_json"),
        F.lit(batch_id).alias("ingest_batch_id"),
        F.lit(now).alias("ingest_ts"),
    )
    return conform(envelopes, ENVELOPE, what="envelope")


def kafka_messages(envelopes: DataFrame) -> DataFrame:
    """(key, value) rows: key stream:entity, value the envelope as JSON."""
    return envelopes.select(
        F.concat(F.col("stream_id"), F.lit(":"), F.col("entity_id")).alias("key"),
        payload_text(ENVELOPE.names).alias("value"),
    )


def parse_messages(messages: DataFrame) -> DataFrame:
    """Decode ``value`` into the envelope fields; text that is not one JSON object lands in ``_corrupt``.

    The parser stops behind the first value. So the text is also parsed as the only element of an array and as the
    only member of an object: what may follow a value in both is a comma, which gives the array a second element.
    """
    strict = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
    shape = nullable(ENVELOPE).add(_CORRUPT, "string")
    text = F.col("value").cast("string")
    parsed = F.from_json(text, shape, {**strict, "columnNameOfCorruptRecord": _CORRUPT})
    others = [name for name in messages.columns if name != "value"]
    decoded = messages.select(
        *others,
        text.alias("_text"),
        parsed.alias("_event"),
        F.from_json(F.concat(F.lit("["), text, F.lit("]")), _ELEMENTS, strict).alias("_listed"),
        F.from_json(F.concat(F.lit('{"m":'), text, F.lit("}")), _MEMBER, strict).alias("_member"),
    )
    alone = (F.size("_listed") == 1) & F.col("_listed")[0].isNotNull() & F.col("_member.m").isNotNull()
    is_object = F.col(f"_event.{_CORRUPT}").isNull() & F.ltrim("_text").startswith("{") & alone
    return decoded.select(
        *others,
        *[F.col(f"_event.{name}").alias(name) for name in ENVELOPE.names],
        F.when(~F.coalesce(is_object, F.lit(False)), F.coalesce("_text", F.lit(""))).alias(_CORRUPT),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(_CORRUPT).isNull()).drop(_CORRUPT)


def rejected(parsed: DataFrame) -> DataFrame:
    """Messages to set aside, with where they came from."""
    return parsed.where(F.col(_CORRUPT).isNotNull()).select(
        "topic", "partition", "offset", F.col(_CORRUPT).alias("message")
    )


def route(stream_id: Column) -> Column:
    """The queue partition of a stream."""
    partition = F.lit(DEFAULT_PARTITION)
    for name, number in STREAM_PARTITIONS.items():
        partition = F.when(stream_id == name, F.lit(number)).otherwise(partition)
    return partition.cast("long")


def raw_rows(events: DataFrame, batch_id: Column, ingested_at: Column) -> DataFrame:
    """Queue rows of accepted messages, routed to their partition."""
    stream = F.coalesce("stream_id", F.lit(DEFAULT_STREAM))
    rows = events.withColumns(
        {
            "stream_id": stream,
            "kafka_topic": F.col("topic"),
            "kafka_partition": F.col("partition"),
            "kafka_offset": F.col("offset"),
            "ingested_at": ingested_at,
            "batch_id": batch_id,
            "tablet_index": route(stream),
        }
    )
    return conform(rows, RAW_EVENTS, what="raw_events")
