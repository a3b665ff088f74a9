"""Fixed table contracts: name, type, and whether a NULL is refused."""

from __future__ import annotations

from pyspark.sql import types as T

REQUIRED = True
_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def contract(*fields: tuple) -> T.StructType:
    """A schema from (name, type) and (name, type, REQUIRED) entries."""
    return T.StructType([T.StructField(name, _TYPES[kind], not any(required)) for name, kind, *required in fields])


def table(**columns_by_type: str) -> T.StructType:
    """A small schema from one keyword for each type, e.g. ``table(string="a! b", long="n")``; ``!`` marks a
    required column."""
    fields = []
    for kind, names in columns_by_type.items():
        for name in names.split():
            fields.append(T.StructField(name.rstrip("!"), _TYPES[kind.split("__")[0]], not name.endswith("!")))
    return T.StructType(fields)


def join_schemas(*parts: T.StructType) -> T.StructType:
    return T.StructType([field for part in parts for field in part.fields])


# Each dimension and the raw column it is taken from.
CATEGORY_SOURCES = {
    "country": "country_code",
    "timezone": "timezone",
    "battery_state": "battery_state",
    "network_status": "network_status",
    "charger": "charger",
    "health": "health",
    "network_type": "network_type",
    "mobile_network_type": "mobile_network_type",
    "mobile_data_status": "mobile_data_status",
    "mobile_data_activity": "mobile_data_activity",
    "wifi_status": "wifi_status",
}
# The flags of a reading.
FLAG_COLUMNS = (
    "roaming_enabled",
    "bluetooth_enabled",
    "location_enabled",
    "power_saver_enabled",
    "nfc_enabled",
    "developer_mode",
)


# The telemetry tables.
RAW_TELEMETRY = contract(
    ("id", "long"),
    ("device_id", "long"),
    ("timestamp", "timestamp"),
    ("country_code", "string"),
    ("timezone", "string"),
    ("battery_state", "string"),
    ("network_status", "string"),
    ("charger", "string"),
    ("health", "string"),
    ("network_type", "string"),
    ("mobile_network_type", "string"),
    ("mobile_data_status", "string"),
    ("mobile_data_activity", "string"),
    ("wifi_status", "string"),
    ("battery_level", "double"),
    ("memory_active", "long"),
    ("memory_inactive", "long"),
    ("memory_free", "long"),
    ("memory_user", "long"),
    ("screen_brightness", "long"),
    ("voltage", "double"),
    ("temperature", "double"),
    ("usage", "double"),
    ("up_time", "double"),
    ("sleep_time", "double"),
    ("wifi_signal_strength", "double"),
    ("wifi_link_speed", "double"),
    ("free", "double"),
    ("total", "double"),
    ("free_system", "double"),
    ("total_system", "double"),
    ("screen_on", "long"),
    ("roaming_enabled", "double"),
    ("bluetooth_enabled", "double"),
    ("location_enabled", "double"),
    ("power_saver_enabled", "double"),
    ("nfc_enabled", "double"),
    ("developer_mode", "double"),
)
FACT = contract(
    ("fact_uid", "string", REQUIRED),
    ("source_id", "long", REQUIRED),
    ("device_uid", "string", REQUIRED),
    ("event_ts_str", "string", REQUIRED),
    ("event_date", "string", REQUIRED),
    ("country_uid", "string", REQUIRED),
    ("timezone_uid", "string", REQUIRED),
    ("battery_state_uid", "string", REQUIRED),
    ("network_status_uid", "string", REQUIRED),
    ("charger_uid", "string"),
    ("health_uid", "string"),
    ("network_type_uid", "string"),
    ("mobile_network_type_uid", "string"),
    ("mobile_data_status_uid", "string"),
    ("mobile_data_activity_uid", "string"),
    ("wifi_status_uid", "string"),
    ("battery_level", "double"),
    ("memory_active", "long"),
    ("memory_inactive", "long"),
    ("memory_free", "long"),
    ("memory_user", "long"),
    ("screen_brightness", "long"),
    ("voltage", "double"),
    ("temperature", "double"),
    ("usage", "double"),
    ("up_time", "double"),
    ("sleep_time", "double"),
    ("wifi_signal_strength", "double"),
    ("wifi_link_speed", "double"),
    ("free", "double"),
    ("total", "double"),
    ("free_system", "double"),
    ("total_system", "double"),
    ("screen_on", "boolean"),
    ("roaming_enabled", "boolean"),
    ("bluetooth_enabled", "boolean"),
    ("location_enabled", "boolean"),
    ("power_saver_enabled", "boolean"),
    ("nfc_enabled", "boolean"),
    ("developer_mode", "boolean"),
    ("_source_file", "string", REQUIRED),
    ("_file_hash", "string", REQUIRED),
    ("_loaded_at", "string", REQUIRED),
    ("_batch_id", "string", REQUIRED),
    ("_part_index", "long", REQUIRED),
)

# All categorical dimensions share one table, partitioned by ``dim_name``.
CATEGORY_DIM = contract(
    ("dim_name", "string", REQUIRED),
    ("uid", "string", REQUIRED),
    ("raw_value", "string", REQUIRED),
    ("first_seen", "string", REQUIRED),
    ("_loaded_at", "string", REQUIRED),
)
DEVICE_DIM = contract(
    ("device_uid", "string", REQUIRED),
    ("device_id", "long", REQUIRED),
    ("first_seen", "string", REQUIRED),
    ("_loaded_at", "string", REQUIRED),
)

# The country reference and what silver takes from it.
COUNTRY_REFERENCE = contract(
    ("country_code", "string"),
    ("country_name", "string"),
    ("alpha3_code", "string"),
    ("numeric_code", "string"),
    ("official_name", "string"),
    ("region", "string"),
    ("sub_region", "string"),
)
COUNTRY_COLUMNS = contract(
    ("country_name", "string"),
    ("country_alpha3_code", "string"),
    ("country_region", "string"),
    ("country_sub_region", "string"),
)

# Silver and the marts.
SILVER = contract(
    ("fact_uid", "string", REQUIRED),
    ("source_id", "long", REQUIRED),
    ("device_id", "long"),
    ("device_uid", "string", REQUIRED),
    ("event_ts_str", "string", REQUIRED),
    ("event_date", "string", REQUIRED),
    ("country_code", "string"),
    ("country_name", "string"),
    ("country_alpha3_code", "string"),
    ("country_region", "string"),
    ("country_sub_region", "string"),
    ("timezone_name", "string"),
    ("battery_state", "string"),
    ("network_status", "string"),
    ("charger", "string"),
    ("health", "string"),
    ("network_type", "string"),
    ("mobile_network_type", "string"),
    ("mobile_data_status", "string"),
    ("mobile_data_activity", "string"),
    ("wifi_status", "string"),
    ("battery_level", "double"),
    ("memory_active", "long"),
    ("memory_inactive", "long"),
    ("memory_free", "long"),
    ("memory_user", "long"),
    ("screen_brightness", "long"),
    ("voltage", "double"),
    ("temperature", "double"),
    ("usage", "double"),
    ("up_time", "double"),
    ("sleep_time", "double"),
    ("wifi_signal_strength", "double"),
    ("wifi_link_speed", "double"),
    ("free", "double"),
    ("total", "double"),
    ("free_system", "double"),
    ("total_system", "double"),
    ("screen_on", "boolean"),
    ("roaming_enabled", "boolean"),
    ("bluetooth_enabled", "boolean"),
    ("location_enabled", "boolean"),
    ("power_saver_enabled", "boolean"),
    ("nfc_enabled", "boolean"),
    ("developer_mode", "boolean"),
    ("date_local", "string"),
    ("hour_of_day", "long"),
    ("day_of_week", "long"),
    ("is_night", "boolean"),
    ("is_charging", "boolean"),
    ("is_wifi", "boolean"),
    ("battery_low", "boolean"),
    ("memory_used_pct", "double"),
    ("storage_used_pct", "double"),
    ("_source_file", "string"),
    ("_file_hash", "string"),
    ("_bronze_loaded_at", "string"),
    ("_silver_batch_id", "string", REQUIRED),
    ("_silver_built_at", "string", REQUIRED),
)
GOLD_STAMP = contract(
    ("_gold_batch_id", "string", REQUIRED),
    ("_gold_built_at", "string", REQUIRED),
)
DAILY_COUNTRY_STATS = contract(
    ("date_local", "string", REQUIRED),
    ("country_code", "string"),
    ("country_name", "string"),
    ("n_events", "long", REQUIRED),
    ("n_devices", "long", REQUIRED),
    ("avg_battery_level", "double"),
    ("avg_temperature", "double"),
    ("avg_voltage", "double"),
    ("avg_memory_used_pct", "double"),
    ("avg_storage_used_pct", "double"),
    ("n_charging_events", "long"),
    ("n_low_battery_events", "long"),
    ("n_wifi_events", "long"),
    ("n_night_events", "long"),
    ("charging_rate", "double"),
    ("low_battery_rate", "double"),
    ("wifi_rate", "double"),
    ("_gold_batch_id", "string", REQUIRED),
    ("_gold_built_at", "string", REQUIRED),
)
COUNTRY_OVERVIEW = contract(
    ("country_code", "string", REQUIRED),
    ("n_devices", "long", REQUIRED),
    ("n_events", "long", REQUIRED),
    ("n_active_days", "long"),
    ("first_date", "string"),
    ("last_date", "string"),
    ("avg_battery_level", "double"),
    ("avg_temperature", "double"),
    ("avg_memory_used_pct", "double"),
    ("avg_storage_used_pct", "double"),
    ("n_charging_events", "long"),
    ("n_low_battery_events", "long"),
    ("n_wifi_events", "long"),
    ("charging_rate", "double"),
    ("low_battery_rate", "double"),
    ("wifi_rate", "double"),
    ("events_per_device", "double"),
    ("_gold_batch_id", "string", REQUIRED),
    ("_gold_built_at", "string", REQUIRED),
)
DEVICE_LIFECYCLE = contract(
    ("device_id", "long", REQUIRED),
    ("country_code", "string"),
    ("first_seen", "string", REQUIRED),
    ("last_seen", "string", REQUIRED),
    ("lifetime_days", "double", REQUIRED),
    ("n_events", "long", REQUIRED),
    ("n_active_days", "long", REQUIRED),
    ("avg_battery_level", "double"),
    ("min_battery_level", "double"),
    ("avg_temperature", "double"),
    ("avg_memory_used_pct", "double"),
    ("avg_storage_used_pct", "double"),
    ("n_charging_events", "long"),
    ("n_wifi_events", "long"),
    ("n_low_battery_events", "long"),
    ("events_per_active_day", "double"),
    ("_gold_batch_id", "string", REQUIRED),
    ("_gold_built_at", "string", REQUIRED),
)
HOURLY_BATTERY_HEALTH = contract(
    ("date_local", "string", REQUIRED),
    ("hour_of_day", "long", REQUIRED),
    ("country_code", "string"),
    ("n_events", "long", REQUIRED),
    ("n_devices", "long", REQUIRED),
    ("avg_battery_level", "double"),
    ("avg_temperature", "double"),
    ("max_temperature", "double"),
    ("avg_voltage", "double"),
    ("n_charging_events", "long"),
    ("n_low_battery_events", "long"),
    ("n_night_events", "long"),
    ("_gold_batch_id", "string", REQUIRED),
    ("_gold_built_at", "string", REQUIRED),
)

# The streaming tables.
ENVELOPE = contract(
    ("source", "string"),
    ("stream_id", "string"),
    ("event_type", "string"),
    ("event_ts", "string"),
    ("entity_id", "string"),
    ("payload_json", "string"),
    ("ingest_batch_id", "string"),
    ("ingest_ts", "string"),
)
RAW_EVENTS = contract(
    ("source", "string"),
    ("stream_id", "string"),
    ("event_type", "string"),
    ("event_ts", "string"),
    ("entity_id", "string"),
    ("payload_json", "string"),
    ("kafka_topic", "string"),
    ("kafka_partition", "long"),
    ("kafka_offset", "long"),
    ("ingested_at", "string"),
    ("batch_id", "string"),
    ("tablet_index", "long"),
)
BRONZE_STREAM = contract(
    ("stream_id", "string"),
    ("row_index", "long"),
    ("tablet_index", "long"),
    ("source", "string"),
    ("event_type", "string"),
    ("event_ts", "string"),
    ("entity_id", "string"),
    ("payload_json", "string"),
    ("queue_timestamp", "long"),
    ("processed_at", "string"),
    ("batch_id", "string"),
)
STREAMING_POSTS = contract(
    ("post_id", "long"),
    ("user_id", "long"),
    ("title", "string"),
    ("body", "string"),
    ("source", "string"),
    ("stream_id", "string"),
    ("event_type", "string"),
    ("event_ts", "string"),
    ("entity_id", "string"),
    ("queue_timestamp", "long"),
    ("tablet_index", "long"),
    ("row_index", "long"),
    ("processed_at", "string"),
    ("batch_id", "string"),
    ("silver_processed_at", "string"),
)
STREAMING_COMMENTS = contract(
    ("comment_id", "long"),
    ("post_id", "long"),
    ("name", "string"),
    ("email", "string"),
    ("body", "string"),
    ("source", "string"),
    ("stream_id", "string"),
    ("event_type", "string"),
    ("event_ts", "string"),
    ("entity_id", "string"),
    ("queue_timestamp", "long"),
    ("tablet_index", "long"),
    ("row_index", "long"),
    ("processed_at", "string"),
    ("batch_id", "string"),
    ("silver_processed_at", "string"),
)
STREAMING_TODOS = contract(
    ("todo_id", "long"),
    ("user_id", "long"),
    ("title", "string"),
    ("completed", "boolean"),
    ("source", "string"),
    ("stream_id", "string"),
    ("event_type", "string"),
    ("event_ts", "string"),
    ("entity_id", "string"),
    ("queue_timestamp", "long"),
    ("tablet_index", "long"),
    ("row_index", "long"),
    ("processed_at", "string"),
    ("batch_id", "string"),
    ("silver_processed_at", "string"),
)

# Ledger and run records.
FILE_LEDGER = contract(
    ("path", "string"),
    ("etag", "string"),
    ("size", "long"),
    ("part_index", "long"),
    ("batch_id", "string"),
    ("loaded_at", "string"),
)
FILE_LOADS = contract(
    ("event_at", "string"),
    ("dag_id", "string"),
    ("run_id", "string"),
    ("batch_id", "string"),
    ("source_system", "string"),
    ("bucket", "string"),
    ("prefix", "string"),
    ("file_key", "string"),
    ("s3a_path", "string"),
    ("etag", "string"),
    ("file_size", "long"),
    ("part_index", "long"),
    ("loader", "string"),
    ("target_layer", "string"),
    ("target_tables", "string"),
    ("load_status", "string"),
    ("started_at", "string"),
    ("finished_at", "string"),
    ("duration_sec", "double"),
    ("rows_inserted", "long"),
    ("source_rows", "long"),
    ("fact_rows", "long"),
    ("device_count", "long"),
    ("rc", "long"),
    ("error", "string"),
    ("remote_log", "string"),
    ("message", "string"),
)
STREAM_BATCHES = contract(
    ("event_at", "string"),
    ("query_id", "string"),
    ("run_id", "string"),
    ("query_name", "string"),
    ("batch", "long"),
    ("rows_in", "long"),
    ("rows_behind", "long"),
    ("duration_sec", "double"),
    ("status", "string"),
    ("message", "string"),
)
LAYER_RUNS = contract(
    ("event_at", "string"),
    ("dag_id", "string"),
    ("run_id", "string"),
    ("batch_id", "string"),
    ("loader", "string"),
    ("source_layer", "string"),
    ("target_layer", "string"),
    ("target_table", "string"),
    ("load_status", "string"),
    ("started_at", "string"),
    ("finished_at", "string"),
    ("duration_sec", "double"),
    ("rows_bronze_in", "long"),
    ("rows_after_dedup", "long"),
    ("rows_silver_out", "long"),
    ("rc", "long"),
    ("error", "string"),
    ("remote_log", "string"),
    ("message", "string"),
)
MART_RUNS = contract(
    ("event_at", "string"),
    ("dag_id", "string"),
    ("run_id", "string"),
    ("batch_id", "string"),
    ("loader", "string"),
    ("mart", "string"),
    ("source_layer", "string"),
    ("target_layer", "string"),
    ("target_table", "string"),
    ("load_status", "string"),
    ("started_at", "string"),
    ("finished_at", "string"),
    ("duration_sec", "double"),
    ("rows_silver_in", "long"),
    ("rows_gold_out", "long"),
    ("rc", "long"),
    ("error", "string"),
    ("remote_log", "string"),
    ("message", "string"),
)
DAG_RUNS = contract(
    ("event_at", "string"),
    ("dag_id", "string"),
    ("run_id", "string"),
    ("batch_id", "string"),
    ("source_system", "string"),
    ("loader", "string"),
    ("started_at", "string"),
    ("finished_at", "string"),
    ("duration_sec", "double"),
    ("status", "string"),
    ("total_items", "long"),
    ("success_items", "long"),
    ("failed_items", "long"),
    ("skipped_items", "long"),
    ("error", "string"),
    ("message", "string"),
)
STREAMING_SILVER_RUNS = contract(
    ("run_id", "string"),
    ("dag_id", "string"),
    ("task_id", "string"),
    ("target_table", "string"),
    ("sql_file", "string"),
    ("status", "string"),
    ("start_ts", "string"),
    ("end_ts", "string"),
    ("duration_sec", "double"),
    ("rc", "long"),
    ("error_message", "string"),
    ("message", "string"),
)
