"""The test tables in the shape of raw telemetry, country reference and event envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.operators.conform import conform
from medallion.schemas import RAW_TELEMETRY
from medallion.sources.files import ROWS_PER_TASK, spread, spread_rows

# How many values each invented category takes.
CATEGORY_CYCLES = {
    "network_status": 3,
    "charger": 2,
    "health": 5,
    "mobile_network_type": 4,
    "mobile_data_status": 2,
    "mobile_data_activity": 3,
    "wifi_status": 3,
}
VALUE_MEASURES = (
    "usage",
    "up_time",
    "sleep_time",
    "wifi_signal_strength",
    "wifi_link_speed",
    "free_system",
    "total_system",
)
TRI_FLAGS = (
    "roaming_enabled",
    "bluetooth_enabled",
    "location_enabled",
    "power_saver_enabled",
    "nfc_enabled",
    "developer_mode",
)
PART_COUNT = 3
BATCH_ID = "batch-1"
LATE_BATCH_ID = "batch-2"
LATE_LOADED_AT = "2024-02-01 12:00:00"


def sample_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(column: str, values: dict) -> Column:
    choice = None
    for key, value in values.items():
        choice = (
            F.when(F.col(column) == key, F.lit(value))
            if choice is None
            else choice.when(F.col(column) == key, F.lit(value))
        )
    return choice


def with_home(spark: SparkSession, sf_dir: str, events: DataFrame, user: str) -> DataFrame:
    """Nation name and region of a user. nation has a fixed size; customer is left to Spark's own size check,
    and beyond it to its skew handling."""
    nation = sample_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    customer = sample_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (
        events.join(customer, F.col(user) == F.col("c_custkey"), "left")
        .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .drop("c_custkey", "c_nationkey", "n_nationkey")
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as raw telemetry. Many events are spread while they are narrow, behind the join, whose tasks are
    measured by their bytes: telemetry and facts are some twenty times as wide."""
    stored = sample_table(spark, sf_dir, "events")
    n_rows = stored.count()
    many = n_rows > ROWS_PER_TASK * spark.sparkContext.defaultParallelism
    events = stored if many else spread(stored)
    k = F.get_json_object("props", "$.k").cast("long")
    total = (F.lit(10) * (F.col("event_id") % 10)).cast("double")
    base = with_home(spark, sf_dir, events, "user_id")
    base = spread_rows(base, n_rows) if many else base
    raw = base.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("device_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(F.col("event_id") % 7 == 0, F.lower("n_name")).otherwise(F.col("n_name")).alias("country_code"),
        F.concat(F.lit("TZ_"), F.col("n_regionkey").cast("string")).alias("timezone"),
        _pick(
            "event_type",
            {"click": "Charging", "view": "Discharging", "purchase": "Full", "error": "Not charging"},
        ).alias("battery_state"),
        F.when(F.col("event_id") % 4 == 0, F.lit("WIFI"))
        .when(F.col("event_id") % 4 == 1, F.lit("MOBILE"))
        .when(F.col("event_id") % 4 == 3, F.lit(" WIFI "))
        .alias("network_type"),
        *[
            F.concat(F.lit(f"{name}_"), (F.col("event_id") % cycle).cast("string")).alias(name)
            for name, cycle in CATEGORY_CYCLES.items()
        ],
        F.least(F.col("value"), F.lit(100.0)).alias("battery_level"),
        (F.lit(3.0) + F.col("value") / 100).alias("voltage"),
        (F.lit(20) + k / 10).alias("temperature"),
        k.alias("memory_active"),
        (k * 2).alias("memory_inactive"),
        (k * 3).alias("memory_free"),
        k.alias("memory_user"),
        k.alias("screen_brightness"),
        total.alias("total"),
        F.least(k.cast("double"), total).alias("free"),
        *[F.col("value").alias(name) for name in VALUE_MEASURES],
        (F.col("event_id") % 2).alias("screen_on"),
        *[
            F.when(F.col("event_id") % 3 == 0, F.lit(0.0)).when(F.col("event_id") % 3 == 1, F.lit(1.0)).alias(name)
            for name in TRI_FLAGS
        ],
    )
    return conform(raw, RAW_TELEMETRY, enforce_required=False, what="telemetry")


def with_parts(raw: DataFrame) -> DataFrame:
    """Lineage of a load of three files, three hours apart."""
    part = F.col("id") % PART_COUNT
    text = F.concat(F.lit("part-"), part.cast("string"))
    return raw.withColumns(
        {
            "_source_file": text,
            "_file_hash": F.sha2(text, 256),
            "_loaded_at": F.concat(F.lit("2024-02-01 0"), (part * 3).cast("string"), F.lit(":00:00")),
            "_batch_id": F.lit(BATCH_ID),
            "_part_index": part,
        }
    )


def late_copies(raw: DataFrame) -> DataFrame:
    """All purchase events delivered once more, later, in a file of their own, with a corrected battery level."""
    copies = raw.where(F.col("battery_state") == "Full")
    return copies.withColumns(
        {
            "battery_level": F.lit(50.0),
            "_source_file": F.lit("part-late"),
            "_file_hash": F.sha2(F.lit("part-late"), 256),
            "_loaded_at": F.lit(LATE_LOADED_AT),
            "_batch_id": F.lit(LATE_BATCH_ID),
            "_part_index": F.lit(0).cast("long"),
        }
    )


def country_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation and region as a country reference (25 rows at every scale)."""
    nation = sample_table(spark, sf_dir, "nation")
    region = sample_table(spark, sf_dir, "region")
    name = F.upper("n_name")
    return nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        name.alias("country_code"),
        F.concat(F.lit("Land "), F.col("n_name")).alias("country_name"),
        F.substring(name, 1, 3).alias("alpha3_code"),
        F.col("n_nationkey").cast("string").alias("numeric_code"),
        name.alias("official_name"),
        F.col("r_name").alias("region"),
        F.lit("").alias("sub_region"),
    )



# Streams of the sample events; signup has an unknown stream, error none.
EVENT_STREAMS = {"click": "s0", "view": "s1", "purchase": "s2", "signup": "s9"}
TOPIC = "raw-events"


def event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as payload items, with the event time and the Kafka offset they will get."""
    return spread(sample_table(spark, sf_dir, "events")).select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("userId"),
        F.col("event_type").alias("title"),
        F.col("props").alias("body"),
        (F.col("value") > 50).alias("completed"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("_ts"),
        _pick("event_type", EVENT_STREAMS).alias("_stream"),
    )


def as_topic(values: DataFrame, offset: str, arrived: str) -> DataFrame:
    """(value, topic, partition, offset, timestamp) rows, as a topic with one partition delivers them."""
    return values.select(
        F.col("value"),
        F.lit(TOPIC).alias("topic"),
        F.lit(0).cast("long").alias("partition"),
        F.col(offset).cast("long").alias("offset"),
        F.lit(arrived).cast("timestamp").alias("timestamp"),
    )
