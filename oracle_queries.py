"""The SQL that checks each query on the same tables, for DuckDB."""

from __future__ import annotations

LOADED_AT = "2024-02-01 00:00:00"
BUILT_AT = "2024-02-02 00:00:00"
GOLD_AT = "2024-02-03 00:00:00"
NOW = "2024-02-01T00:00:00Z"
ROUND = "round(({}) + 1e-9, 6)"

CATEGORIES = {
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
CYCLES = {
    "network_status": 3,
    "charger": 2,
    "health": 5,
    "mobile_network_type": 4,
    "mobile_data_status": 2,
    "mobile_data_activity": 3,
    "wifi_status": 3,
}
VALUE_MEASURES = (
    "usage up_time sleep_time wifi_signal_strength wifi_link_speed free_system total_system".split()
)
MEASURES = (
    "battery_level memory_active memory_inactive memory_free memory_user screen_brightness voltage temperature "
    "usage up_time sleep_time wifi_signal_strength wifi_link_speed free total free_system total_system"
).split()
FLAGS = "roaming_enabled bluetooth_enabled location_enabled power_saver_enabled nfc_enabled developer_mode".split()
LINEAGE = "_source_file _file_hash _loaded_at _batch_id _part_index".split()
DECODED = {name: {"country": "country_code", "timezone": "timezone_name"}.get(name, name) for name in CATEGORIES}


def comma(*items: str) -> str:
    return ",\n  ".join(items)


def normal(column: str) -> str:
    return f"coalesce(trim({column}), '__null__')"


def uid(namespace: str, *values: str) -> str:
    texts = ", ".join(f"coalesce(CAST({value} AS VARCHAR), '__null__')" for value in values)
    digest = f"sha256(concat_ws('|', {namespace}, {texts}))"
    return (
        f"substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-5' || substr({digest}, 14, 3)"
        f" || '-8' || substr({digest}, 17, 3) || '-' || substr({digest}, 20, 12)"
    )


K = "CAST(json_extract_string(e.props, '$.k') AS BIGINT)"
TOTAL = "CAST(10 * (e.event_id % 10) AS DOUBLE)"

CTES: dict[str, str] = {}

CTES["raw"] = "SELECT " + comma(
    "e.event_id AS id",
    "e.user_id AS device_id",
    "e.ts AS ts",
    "CASE WHEN e.event_id % 7 = 0 THEN lower(n.n_name) ELSE n.n_name END AS country_code",
    "'TZ_' || CAST(n.n_regionkey AS VARCHAR) AS timezone",
    "CASE e.event_type WHEN 'click' THEN 'Charging' WHEN 'view' THEN 'Discharging' WHEN 'purchase' THEN 'Full' "
    "WHEN 'error' THEN 'Not charging' END AS battery_state",
    "CASE e.event_id % 4 WHEN 0 THEN 'WIFI' WHEN 1 THEN 'MOBILE' WHEN 3 THEN ' WIFI ' END AS network_type",
    *[f"'{name}_' || CAST(e.event_id % {cycle} AS VARCHAR) AS {name}" for name, cycle in CYCLES.items()],
    "least(e.value, 100.0) AS battery_level",
    "CAST(3.0 AS DOUBLE) + e.value / 100 AS voltage",
    f"20 + {K} / 10 AS temperature",
    f"{K} AS memory_active",
    f"{K} * 2 AS memory_inactive",
    f"{K} * 3 AS memory_free",
    f"{K} AS memory_user",
    f"{K} AS screen_brightness",
    f"{TOTAL} AS total",
    f"least(CAST({K} AS DOUBLE), {TOTAL}) AS free",
    *[f"e.value AS {name}" for name in VALUE_MEASURES],
    "e.event_id % 2 AS screen_on",
    *[f"CASE e.event_id % 3 WHEN 0 THEN 0.0 WHEN 1 THEN 1.0 END AS {name}" for name in FLAGS],
) + """
FROM events e
LEFT JOIN customer c ON e.user_id = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""

CTES["parts"] = """SELECT *,
  'part-' || CAST(id % 3 AS VARCHAR) AS _source_file,
  sha256('part-' || CAST(id % 3 AS VARCHAR)) AS _file_hash,
  '2024-02-01 0' || CAST(id % 3 * 3 AS VARCHAR) || ':00:00' AS _loaded_at,
  'batch-1' AS _batch_id,
  id % 3 AS _part_index
FROM raw"""

CTES["copies"] = """SELECT * REPLACE (50.0 AS battery_level),
  'part-late' AS _source_file,
  sha256('part-late') AS _file_hash,
  '2024-02-01 12:00:00' AS _loaded_at,
  'batch-2' AS _batch_id,
  CAST(0 AS BIGINT) AS _part_index
FROM raw WHERE battery_state = 'Full'"""

CTES["loaded"] = "SELECT * FROM parts UNION ALL SELECT * FROM copies"
CTES["newest"] = """SELECT * FROM loaded
QUALIFY row_number() OVER (PARTITION BY id ORDER BY _loaded_at DESC) = 1"""

SECOND_TEXT = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
DAY_TEXT = "strftime(ts, '%Y-%m-%d')"
FACT_UID = uid("'fact_telemetry'", "id", "device_id", SECOND_TEXT)
DEVICE_UID = uid("'dim_device'", "device_id")


def category_uid(name: str) -> str:
    return uid(f"'dim_{name}'", normal(CATEGORIES[name]))


def tri(name: str) -> str:
    return f"{name} <> 0.0 AS {name}"


def fact_sql(source: str) -> str:
    return "SELECT " + comma(
        f"{FACT_UID} AS fact_uid",
        "id AS source_id",
        f"{DEVICE_UID} AS device_uid",
        f"{SECOND_TEXT} AS event_ts_str",
        f"{DAY_TEXT} AS event_date",
        *[f"{category_uid(name)} AS {name}_uid" for name in CATEGORIES],
        *MEASURES,
        "screen_on = 1 AS screen_on",
        *[tri(name) for name in FLAGS],
        *LINEAGE,
    ) + f"\nFROM {source}"


CTES["reference"] = """SELECT upper(n_name) AS ref_code, 'Land ' || n_name AS country_name,
  substr(upper(n_name), 1, 3) AS country_alpha3_code, r_name AS country_region, '' AS country_sub_region
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""

MEMORY = "(memory_active + memory_inactive + memory_free + memory_user)"
MEMORY_PCT = f"CASE WHEN {MEMORY} > 0 THEN (memory_active + memory_user) / {MEMORY} END"
STORAGE_PCT = "CASE WHEN total > 0 THEN (total - free) / total END"

CTES["silver"] = "SELECT " + comma(
    f"{FACT_UID} AS fact_uid",
    "id AS source_id",
    "device_id",
    f"{DEVICE_UID} AS device_uid",
    f"{SECOND_TEXT} AS event_ts_str",
    f"{DAY_TEXT} AS event_date",
    f"upper({normal('country_code')}) AS country_code",
    f"coalesce(country_name, upper({normal('country_code')})) AS country_name",
    "country_alpha3_code",
    "country_region",
    "country_sub_region",
    *[f"{normal(CATEGORIES[name])} AS {DECODED[name]}" for name in CATEGORIES if name != "country"],
    *MEASURES,
    "screen_on = 1 AS screen_on",
    *[tri(name) for name in FLAGS],
    f"{DAY_TEXT} AS date_local",
    "CAST(hour(ts) AS BIGINT) AS hour_of_day",
    "CAST(dayofweek(ts) + 1 AS BIGINT) AS day_of_week",
    "hour(ts) BETWEEN 0 AND 5 AS is_night",
    f"{normal('battery_state')} IN ('Charging', 'Full') AS is_charging",
    f"{normal('network_type')} = 'WIFI' AS is_wifi",
    "battery_level < 20 AS battery_low",
    f"{MEMORY_PCT} AS memory_used_pct",
    f"{STORAGE_PCT} AS storage_used_pct",
    "_source_file",
    "_file_hash",
    "_loaded_at AS _bronze_loaded_at",
    "'silver-1' AS _silver_batch_id",
    f"'{BUILT_AT}' AS _silver_built_at",
) + f"\nFROM parts LEFT JOIN reference ON upper({normal('country_code')}) = ref_code"

CTES["first_seen"] = "\nUNION ALL ".join(
    f"SELECT '{name}' AS dim_name, {normal(source)} AS raw_value, min({SECOND_TEXT}) AS first_seen, "
    f"min(CASE WHEN id % 3 = 0 THEN 1 ELSE 2 END) AS known FROM raw GROUP BY 1, 2"
    for name, source in CATEGORIES.items()
)
CTES["devices"] = f"""SELECT device_id, min({SECOND_TEXT}) AS first_seen,
  min(CASE WHEN ts < TIMESTAMP '2024-01-01 12:00:00' THEN 1 ELSE 2 END) AS known
FROM raw WHERE device_id IS NOT NULL GROUP BY 1"""

CTES["items"] = """SELECT event_id AS id, user_id AS "userId", event_type AS title, props AS body,
  value > 50 AS completed,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS event_ts,
  CASE event_type WHEN 'click' THEN 's0' WHEN 'view' THEN 's1' WHEN 'purchase' THEN 's2' WHEN 'signup' THEN 's9' END
    AS stream
FROM events"""
CTES["queue"] = """SELECT 'jsonplaceholder_todos' AS source, coalesce(stream, 's0') AS stream_id,
  'todo_event' AS event_type, event_ts, CAST("userId" AS VARCHAR) AS entity_id,
  CAST(to_json({'id': id, 'userId': "userId", 'title': title, 'completed': completed}) AS VARCHAR) AS payload_json,
  'raw-events' AS kafka_topic, CAST(0 AS BIGINT) AS kafka_partition, id AS kafka_offset,
  '2024-02-01T00:00:00Z' AS ingested_at, 'poll-1' AS batch_id,
  CAST(CASE stream WHEN 's1' THEN 1 WHEN 's2' THEN 2 ELSE 0 END AS BIGINT) AS tablet_index
FROM items"""
CTES["envelopes"] = f"""SELECT 'jsonplaceholder_todos' AS source, stream AS stream_id, 'todo_event' AS event_type,
  event_ts, CAST("userId" AS VARCHAR) AS entity_id,
  CAST(to_json({{'id': id, 'userId': "userId", 'title': title, 'body': body}}) AS VARCHAR) AS payload_json,
  'poll-1' AS ingest_batch_id, '{NOW}' AS ingest_ts
FROM items"""

CTES["runs"] = """SELECT o_orderkey AS run_id, CAST(o_custkey AS VARCHAR) AS batch_id, o_orderpriority AS mart,
  CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS load_status,
  date_trunc('second', o_orderdate) AS started,
  CASE WHEN o_orderstatus <> 'P'
    THEN date_trunc('second', o_orderdate) + to_hours(o_orderkey % 7 - 2) END AS finished
FROM orders"""

_NEEDS = {
    "parts": ["raw"],
    "copies": ["raw"],
    "loaded": ["parts", "copies"],
    "newest": ["loaded"],
    "silver": ["parts", "reference"],
    "first_seen": ["raw"],
    "devices": ["raw"],
    "queue": ["items"],
    "envelopes": ["items"],
}


def with_(names: str, body: str) -> str:
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS.get(name, []):
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        need(name)
    return "WITH " + ",\n".join(f"{name} AS (\n{CTES[name]}\n)" for name in ordered) + f"\n{body}"


STAMP = f"'gold-1' AS _gold_batch_id, '{GOLD_AT}' AS _gold_built_at"


def avg(alias: str, column: str) -> str:
    return ROUND.format(f"avg({column})") + f" AS {alias}"


def rate(alias: str, top: str, bottom: str = "count(*)") -> str:
    return ROUND.format(f"{top} / {bottom}") + f" AS {alias}"


def flag(column: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {column}) AS BIGINT)"


CLIMATE = [avg("avg_battery_level", "battery_level"), avg("avg_temperature", "temperature")]
USAGE = [avg("avg_memory_used_pct", "memory_used_pct"), avg("avg_storage_used_pct", "storage_used_pct")]
CHARGE = [f"{flag('is_charging')} AS n_charging_events", f"{flag('battery_low')} AS n_low_battery_events"]
RATES = [
    rate("charging_rate", flag("is_charging")),
    rate("low_battery_rate", flag("battery_low")),
    rate("wifi_rate", flag("is_wifi")),
]
WIFI = f"{flag('is_wifi')} AS n_wifi_events"
NIGHT = f"{flag('is_night')} AS n_night_events"

TAIL = f"""'{{source}}' AS source, '{{stream}}' AS stream_id, 'sample_event' AS event_type, '{NOW}' AS event_ts,
  CAST({{id}} AS VARCHAR) AS entity_id, epoch_us(TIMESTAMP '{LOADED_AT}') AS queue_timestamp,
  CAST({{tablet}} AS BIGINT) AS tablet_index, {{id}} AS row_index, '{NOW}' AS processed_at, 'poll-1' AS batch_id,
  '{NOW}' AS silver_processed_at"""


def tail(name: str, stream: int, key: str) -> str:
    return TAIL.format(source=f"jsonplaceholder_{name}", stream=f"s{stream}", tablet=stream, id=key)


def mart_queries() -> dict[str, str]:
    days = "count(DISTINCT date_local)"
    devices = "count(DISTINCT device_id)"
    first, last = "min(event_ts_str)", "max(event_ts_str)"
    found = {
        "daily_country_stats": with_(
            "silver",
            "SELECT "
            + comma(
                "date_local", "country_code", "country_name", "count(*) AS n_events", f"{devices} AS n_devices",
                *CLIMATE, avg("avg_voltage", "voltage"), *USAGE, *CHARGE, WIFI, NIGHT, *RATES, STAMP,
            )
            + "\nFROM silver GROUP BY date_local, country_code, country_name",
        ),
        "country_overview": with_(
            "silver",
            "SELECT "
            + comma(
                "country_code", f"{devices} AS n_devices", "count(*) AS n_events", f"{days} AS n_active_days",
                "min(date_local) AS first_date", "max(date_local) AS last_date",
                *CLIMATE, *USAGE, *CHARGE, WIFI, *RATES, rate("events_per_device", "count(*)", devices), STAMP,
            )
            + "\nFROM silver GROUP BY country_code",
        ),
        "device_lifecycle": with_(
            "silver",
            "SELECT "
            + comma(
                "device_id", "country_code", f"{first} AS first_seen", f"{last} AS last_seen",
                ROUND.format(f"(epoch(CAST({last} AS TIMESTAMP)) - epoch(CAST({first} AS TIMESTAMP))) / 86400.0")
                + " AS lifetime_days",
                "count(*) AS n_events", f"{days} AS n_active_days", *CLIMATE,
                ROUND.format("min(battery_level)") + " AS min_battery_level",
                *USAGE, *CHARGE, WIFI, rate("events_per_active_day", "count(*)", days), STAMP,
            )
            + "\nFROM silver GROUP BY device_id, country_code",
        ),
        "hourly_battery_health": with_(
            "silver",
            "SELECT "
            + comma(
                "date_local", "hour_of_day", "country_code", "count(*) AS n_events", f"{devices} AS n_devices",
                *CLIMATE, ROUND.format("max(temperature)") + " AS max_temperature", avg("avg_voltage", "voltage"),
                *CHARGE, NIGHT, STAMP,
            )
            + "\nFROM silver GROUP BY date_local, hour_of_day, country_code",
        ),
        "orders_daily_nation": "SELECT "
        + comma(
            "strftime(o_orderdate, '%Y-%m-%d') AS order_date", "n_name AS nation", "count(*) AS n_orders",
            "count(DISTINCT o_custkey) AS n_customers", avg("avg_price", "o_totalprice"),
            ROUND.format("min(o_totalprice)") + " AS min_price", ROUND.format("max(o_totalprice)") + " AS max_price",
            f"{flag(URGENT)} AS n_urgent", rate("urgent_rate", flag(URGENT)), STAMP,
        )
        + "\nFROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey"
        + "\nGROUP BY 1, 2",
        "supplier_overview": "SELECT "
        + comma(
            "l_suppkey", "count(*) AS n_lines", "count(DISTINCT l_orderkey) AS n_orders",
            "count(DISTINCT l_partkey) AS n_parts",
            "strftime(min(l_shipdate), '%Y-%m-%d') AS first_shipped",
            "strftime(max(l_shipdate), '%Y-%m-%d') AS last_shipped",
            avg("avg_quantity", "l_quantity"), avg("avg_discount", "l_discount"),
            f"{flag(RETURNED)} AS n_returned", rate("return_rate", flag(RETURNED)),
            rate("lines_per_order", "count(*)", "count(DISTINCT l_orderkey)"), STAMP,
        )
        + "\nFROM lineitem GROUP BY l_suppkey",
        "mart_without_names": with_(
            "silver",
            f"SELECT date_local, country_code, country_code AS country_name, count(*) AS n_events, {devices} AS n_devices "
            "FROM silver GROUP BY date_local, country_code",
        ),
    }
    return {**found, "mart_from_states": found["country_overview"]}


URGENT = "o_orderpriority = '1-URGENT'"
RETURNED = "l_returnflag = 'R'"


def expression_queries() -> dict[str, str]:
    return {
        "event_times": with_("raw", f"SELECT id, {SECOND_TEXT} AS event_ts_str, {DAY_TEXT} AS event_date FROM raw"),
        "normalize_keys": with_(
            "raw", "SELECT " + comma("id", *[f"{normal(s)} AS {n}" for n, s in CATEGORIES.items()]) + " FROM raw"
        ),
        "tri_bools": with_(
            "raw", "SELECT " + comma("id", "screen_on = 1 AS screen_on", *[tri(n) for n in FLAGS]) + " FROM raw"
        ),
        "calendar": with_(
            "raw",
            f"SELECT id, {DAY_TEXT} AS date_local, CAST(hour(ts) AS BIGINT) AS hour_of_day, "
            "CAST(dayofweek(ts) + 1 AS BIGINT) AS day_of_week FROM raw",
        ),
        "flags": with_(
            "raw",
            "SELECT id, hour(ts) BETWEEN 0 AND 5 AS is_night, battery_state IN ('Charging', 'Full') AS is_charging, "
            "network_type = 'WIFI' AS is_wifi, battery_level < 20 AS battery_low FROM raw",
        ),
        "usage_ratios": with_(
            "raw", f"SELECT id, {MEMORY_PCT} AS memory_used_pct, {STORAGE_PCT} AS storage_used_pct FROM raw"
        ),
        "stable_ids": with_(
            "raw",
            f"SELECT id, {FACT_UID} AS fact_uid, {DEVICE_UID} AS device_uid, "
            + uid("'dim_battery_state'", "battery_state")
            + " AS battery_state_uid FROM raw",
        ),
        "country_codes": with_(
            "raw", "SELECT upper(trim(country_code)) AS country_code, count(*) AS n_events FROM raw GROUP BY 1"
        ),
    }


def bronze_queries() -> dict[str, str]:
    dim_uid = uid("'dim_' || dim_name", "raw_value")
    row = f"dim_name, {dim_uid} AS uid, raw_value, first_seen, '{LOADED_AT}' AS _loaded_at"
    device_row = f"{DEVICE_UID} AS device_uid, device_id, first_seen, '{LOADED_AT}' AS _loaded_at"
    unkeyed = "\nUNION ALL ".join(
        [
            "SELECT 'device_uid' AS column_name, count(*) AS n_null FROM raw JOIN devices USING (device_id) "
            "WHERE known = 2",
            *[
                f"SELECT '{name}_uid', count(*) FROM raw JOIN first_seen f ON f.dim_name = '{name}' "
                f"AND f.raw_value = {normal(source)} WHERE known = 2"
                for name, source in CATEGORIES.items()
            ],
        ]
    )
    return {
        "dim_first_seen": with_("first_seen", "SELECT dim_name, raw_value, first_seen FROM first_seen"),
        "dim_device_first_seen": with_("devices", "SELECT device_id, first_seen FROM devices"),
        "dim_only_new": with_("first_seen", f"SELECT {row} FROM first_seen WHERE known = 2"),
        "dim_device_only_new": with_("devices", f"SELECT {device_row} FROM devices WHERE known = 2"),
        "dim_mapping": with_("first_seen", f"SELECT dim_name, raw_value, {dim_uid} AS uid FROM first_seen"),
        "dim_device_mapping": with_("devices", f"SELECT device_id, {DEVICE_UID} AS device_uid FROM devices"),
        "dim_random_keys": with_(
            "first_seen devices",
            "SELECT dim_name, raw_value, CAST(1 AS BIGINT) AS n_ids, CAST(1 AS BIGINT) AS n_values, CAST(36 AS BIGINT) AS width FROM first_seen UNION ALL "
            "SELECT 'device', CAST(device_id AS VARCHAR), 1, 1, 36 FROM devices",
        ),
        "fact_stable_keys": with_("parts", fact_sql("parts")),
        "fact_lookup": with_("parts", fact_sql("parts")),
        "fact_lookup_large": with_("parts", fact_sql("parts")),
        "fact_lookup_bucketed": with_("parts", fact_sql("parts")),
        "fact_random_keys": with_(
            "raw",
            "SELECT "
            + comma(
                f"{FACT_UID} AS fact_uid", "device_id", *[f"{normal(s)} AS {DECODED[n]}" for n, s in CATEGORIES.items()]
            )
            + " FROM raw",
        ),
        "null_key_check": with_("first_seen devices", unkeyed),
        "table_source_lineage": with_(
            "raw",
            f"SELECT {FACT_UID} AS fact_uid, 'staging' AS _source_file, "
            "sha256('staging|batch-1|' || CAST((SELECT count(*) FROM raw) AS VARCHAR)) AS _file_hash, "
            f"'{LOADED_AT}' AS _loaded_at, 'batch-1' AS _batch_id, CAST(0 AS BIGINT) AS _part_index FROM raw",
        ),
        "dedup_latest": with_("newest", fact_sql("newest")),
        "file_load_audit": with_(
            "loaded",
            f"SELECT '{NOW}' AS event_at, 'batch-1' AS batch_id, _source_file AS file_key, _part_index AS part_index, "
            "count(*) AS rows_inserted, count(*) AS fact_rows, CAST(90 AS DOUBLE) AS duration_sec, "
            "'SUCCESS' AS load_status FROM loaded GROUP BY _source_file, _part_index",
        ),
    }


def silver_queries() -> dict[str, str]:
    # Silver knows the first two files, so the third one's events are new, in their newest version.
    fresh = with_("newest", fact_sql("newest") + "\nWHERE id % 3 = 2")
    restored = [
        f"nullif({'upper(trim(country_code))' if n == 'country' else f'trim({s})'}, '__null__') AS {DECODED[n]}"
        for n, s in CATEGORIES.items()
    ]
    return {
        "missing_files": "SELECT sha256('part-2') AS _file_hash FROM events WHERE event_id % 3 = 2 GROUP BY 1 "
        "UNION ALL SELECT sha256('part-late') FROM events WHERE event_type = 'purchase' GROUP BY 1",
        "file_catchup": fresh,
        "increment_overlap": fresh,
        "unseen_by_filters": fresh,
        "silver_wide": with_("silver", "SELECT * FROM silver"),
        "silver_direct": with_("silver", "SELECT * FROM silver"),
        "silver_restored_nulls": with_(
            "raw", "SELECT " + comma(f"{FACT_UID} AS fact_uid", *restored) + " FROM raw"
        ),
        "country_enrich": """SELECT c_custkey AS customer, upper(n_name) AS country_code,
  CASE WHEN r_name <> 'EUROPE' THEN 'Land ' || n_name ELSE upper(n_name) END AS country_name,
  CASE WHEN r_name <> 'EUROPE' THEN substr(upper(n_name), 1, 3) END AS country_alpha3_code,
  CASE WHEN r_name <> 'EUROPE' THEN r_name END AS country_region,
  CASE WHEN r_name <> 'EUROPE' THEN '' END AS country_sub_region
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
        "reference_replaced": """SELECT upper(n_name) AS country_code, 'Land ' || n_name AS country_name,
  substr(upper(n_name), 1, 3) AS alpha3_code, CAST(n_nationkey AS VARCHAR) AS numeric_code, upper(n_name) AS official_name,
  r_name AS region, '' AS sub_region
FROM nation JOIN region ON n_regionkey = r_regionkey""",
        "salted_lookup": "SELECT event_id, event_type, user_id, c_name, c_mktsegment "
        "FROM events LEFT JOIN customer ON user_id = c_custkey",
        "checked_lookup": "SELECT event_id, user_id, event_type FROM events "
        "WHERE user_id IN (SELECT c_custkey FROM customer)",
        "sql_layer_counts": with_(
            "silver",
            "SELECT event_date, battery_state, count(*) AS n_rows FROM silver WHERE is_wifi "
            "GROUP BY event_date, battery_state",
        ),
    }


def stream_queries() -> dict[str, str]:
    message = (
        "CAST(to_json({'source': source, 'stream_id': stream_id, 'event_type': event_type, 'event_ts': event_ts, "
        "'entity_id': entity_id, 'payload_json': payload_json, 'ingest_batch_id': ingest_batch_id, "
        "'ingest_ts': ingest_ts}) AS VARCHAR)"
    )
    found = {
        "envelope_build": with_("envelopes", "SELECT * FROM envelopes"),
        "kafka_kv": with_("envelopes", f"SELECT stream_id || ':' || entity_id AS key, {message} AS value FROM envelopes"),
        "quarantine": """SELECT 'raw-events' AS topic, CAST(0 AS BIGINT) AS partition, event_id AS "offset",
  CASE event_type WHEN 'error' THEN CASE event_id % 4 WHEN 0 THEN 'not json ' || event_id
      WHEN 1 THEN '{"source":"a"} ' || event_id
      WHEN 2 THEN '{"source":"a"}{"id":' || event_id || '}'
      ELSE '{' || chr(39) || 'source' || chr(39) || ':' || chr(39) || 'a' || event_id || chr(39) || '}' END
    ELSE '[' || CAST(event_id AS VARCHAR) || ']' END AS message
FROM events WHERE event_type IN ('error', 'signup')""",
        "route_tablet": with_("queue", "SELECT * FROM queue"),
        "bronze_upsert": with_(
            "queue",
            "SELECT stream_id, kafka_offset AS row_index, tablet_index, source, event_type, event_ts, entity_id, "
            f"payload_json, epoch_us(TIMESTAMP '{LOADED_AT}') AS queue_timestamp, "
            "'2024-02-01T00:05:00Z' AS processed_at, batch_id FROM queue",
        ),
        "bronze_partition": with_(
            "queue", "SELECT stream_id, count(*) AS n_rows FROM queue WHERE tablet_index = 0 GROUP BY stream_id"
        ),
        "payload_posts": "SELECT doc_id AS post_id, n_chars AS user_id, source AS title, text AS body, "
        + tail("posts", 0, "doc_id")
        + " FROM documents",
        "payload_comments": "SELECT conv_id * 1000 + turn AS comment_id, conv_id AS post_id, role AS name, "
        "role || '@example.org' AS email, text AS body, "
        + tail("comments", 1, "(conv_id * 1000 + turn)")
        + " FROM conversations",
        "payload_todos": "SELECT event_id AS todo_id, user_id, event_type AS title, value > 50 AS completed, "
        + tail("todos", 2, "event_id")
        + " FROM events",
        "stream_available_now": with_("items", fan_out("id")),
        "bronze_partitions": with_("items", fan_out("((id % 3) << 48) + id // 3")),
        "stream_runs": with_(
            "items",
            "SELECT table_name AS task_id, 'success' AS status, CAST(0 AS BIGINT) AS rc, CAST(2 AS BIGINT) AS n_runs, "
            f"count(*) AS n_rows FROM ({fan_out('id')}) GROUP BY table_name",
        ),
        "stream_batches": """SELECT query_name, CAST(CASE query_name WHEN 'raw' THEN messages WHEN 'bronze' THEN good ELSE 0 END AS BIGINT)
  AS rows_in, CAST(query_name = 'bad' AS BIGINT) AS n_failed, CAST(query_name = 'bad' AS BIGINT) AS n_errors,
  CAST(CASE WHEN query_name = 'raw' THEN messages END AS BIGINT) AS n_written
FROM (SELECT 2 * count(*) AS messages, 2 * count(*) FILTER (event_type NOT IN ('error', 'signup')) AS good FROM events),
  (VALUES ('raw'), ('bronze'), ('bad')) AS names(query_name)""",
        "stream_replayed": "SELECT 'raw-events' AS topic, CAST(0 AS BIGINT) AS partition, 2 * count(*) AS n_rows, "
        "CAST(2 * sum(event_id) AS BIGINT) AS sum_offset FROM events",
    }
    same = {
        "bronze_compacted": "bronze_upsert",
        "bronze_buckets": "bronze_upsert",
        "stream_deduplicated": "bronze_upsert",
        "silver_from_changes": "bronze_partitions",
    }
    return {**found, **{name: found[other] for name, other in same.items()}}


def fan_out(row_index: str) -> str:
    tables = {"s0": "streaming_posts", "s1": "streaming_comments", "s2": "streaming_todos"}
    names = " ".join(f"WHEN '{stream}' THEN '{name}'" for stream, name in tables.items())
    return (
        f"SELECT CASE stream {names} END AS table_name, id AS item_id, \"userId\" AS owner_id, title AS label, "
        "stream AS stream_id, event_ts, CAST(\"userId\" AS VARCHAR) AS entity_id, "
        "CAST(CASE stream WHEN 's1' THEN 1 WHEN 's2' THEN 2 ELSE 0 END AS BIGINT) AS tablet_index, "
        f"{row_index} AS row_index FROM items WHERE title NOT IN ('error', 'signup')"
    )


def ledger_queries() -> dict[str, str]:
    iso = "'%Y-%m-%dT%H:%M:%SZ'"
    span = "CASE WHEN finished IS NOT NULL THEN greatest(epoch(finished) - epoch(started), 0.0) END"
    return {
        "ledger_new_files": """WITH listing AS (
  SELECT url || '#' || CAST(page_id AS VARCHAR) AS path, CAST(strlen(html) AS BIGINT) AS size FROM pages
)
SELECT path, sha256(concat_ws('|', path, CAST(size AS VARCHAR), '0')) AS etag, size,
  row_number() OVER (ORDER BY path) - 1 AS part_index
FROM listing WHERE size >= 2000""",
        "ledger_update": "SELECT 'orders/' || CAST(o_orderkey AS VARCHAR) AS path, "
        "sha256(CAST(o_orderkey AS VARCHAR)) AS etag, o_custkey AS size, o_orderkey AS part_index, "
        f"'batch-1' AS batch_id, '{NOW}' AS loaded_at FROM orders WHERE o_orderstatus = 'F'",
        "dense_numbers": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS position "
        "FROM orders",
        "schema_evolve": "SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_language, CAST(NULL AS BIGINT) AS "
        "c_visits, c_mktsegment FROM customer",
        "schema_versions": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN o_custkey + 1099511627776 ELSE o_custkey END "
        "AS customer, o_orderstatus AS status, CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS o_orderpriority "
        "FROM orders",
        "schema_conform": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
        "run_durations": with_("runs", f"SELECT run_id, load_status, {span} AS duration_sec FROM runs"),
        "run_rollup": with_(
            "runs",
            f"""SELECT batch_id, strftime(min(started), {iso}) AS started_at, strftime(max(finished), {iso}) AS finished_at,
  CASE WHEN max(finished) IS NOT NULL THEN greatest(epoch(max(finished)) - epoch(min(started)), 0.0) END AS duration_sec,
  CASE WHEN count(*) FILTER (WHERE load_status = 'FAILED') = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
  count(*) AS total_items,
  count(*) FILTER (WHERE load_status = 'SUCCESS') AS success_items,
  count(*) FILTER (WHERE load_status = 'FAILED') AS failed_items,
  CAST(0 AS BIGINT) AS skipped_items,
  CASE WHEN count(*) FILTER (WHERE load_status = 'FAILED') > 0
    THEN count(*) FILTER (WHERE load_status = 'FAILED') || ' of ' || count(*) || ' files failed' END AS error
FROM runs GROUP BY batch_id""",
        ),
        "last_success": with_(
            "runs",
            f"""SELECT mart, batch_id, run_id, finished_at FROM (
  SELECT mart, batch_id, run_id,
    strftime(finished, {iso}) || lpad(CAST(run_id AS VARCHAR), 12, '0') AS finished_at
  FROM runs WHERE load_status = 'SUCCESS'
) QUALIFY row_number() OVER (PARTITION BY mart ORDER BY finished_at DESC) = 1""",
        ),
        "latest_turn": "SELECT conv_id, turn, role, text FROM conversations "
        "QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1",
    }


def plan_queries() -> dict[str, str]:
    columns = "fact_uid, source_id, event_date"
    fact = fact_sql("parts")
    lineage = ("_source_file", "_file_hash", "_loaded_at", "_batch_id", "_part_index")
    return {
        "ingest_in_parts": with_(
            "parts",
            f"SELECT CAST(source_id % 3 AS VARCHAR) AS part, event_date, count(*) AS n_facts, "
            f"CAST(sum(source_id) AS BIGINT) AS sum_id FROM (SELECT {columns} FROM ({fact})) GROUP BY ALL",
        ),
        "facts_compacted": with_(
            "parts",
            f"SELECT *, CAST(1 AS BIGINT) AS n_folders, CAST(sum(n_facts) OVER (PARTITION BY event_date) AS BIGINT) AS n_before "
            f"FROM (SELECT CAST(source_id % 3 AS VARCHAR) AS part, event_date, count(*) AS n_facts, "
            f"CAST(sum(source_id) AS BIGINT) AS sum_id FROM (SELECT {columns} FROM ({fact})) GROUP BY ALL)",
        ),
        "versions_replaced": """SELECT reader, value, n_orders FROM (VALUES ('newest'), ('late writer')) AS readers(reader),
  (SELECT o_orderpriority AS value, count(*) AS n_orders FROM orders GROUP BY 1)
UNION ALL SELECT 'pinned', o_orderstatus, count(*) FROM orders GROUP BY 2""",
        "bad_pages": with_(
            "raw",
            """SELECT CAST(id % 4 AS VARCHAR) AS part, CASE id % 4 WHEN 0 THEN 'FAILED' ELSE 'SUCCESS' END AS load_status,
  CASE id % 4 WHEN 0 THEN 0 ELSE count(*) END AS fact_rows, CASE id % 4 WHEN 0 THEN NULL ELSE count(*) END AS n_facts, per_job
FROM raw CROSS JOIN (VALUES (1), (4)) AS jobs(per_job) GROUP BY id % 4, per_job""",
        ),
        "bad_types": with_(
            "raw",
            """SELECT CAST(id % 3 AS VARCHAR) AS part, CASE id % 3 WHEN 1 THEN 'FAILED' ELSE 'SUCCESS' END AS load_status,
  CASE id % 3 WHEN 1 THEN 0 ELSE count(*) END AS fact_rows, CASE id % 3 WHEN 1 THEN NULL ELSE count(*) END AS n_facts
FROM raw GROUP BY id % 3""",
        ),
        "sql_preview": with_(
            "silver",
            "SELECT source_id, event_date, battery_state FROM silver WHERE source_id % 3 <> 2 ORDER BY source_id DESC LIMIT 20",
        ),
        "processing_times": """SELECT o_orderstatus, count(*) AS n_orders, count(*) AS n_texts, count(*) AS n_recent,
  CAST(1 AS BIGINT) AS n_moments FROM orders GROUP BY o_orderstatus""",
        "file_outcomes": with_(
            "raw",
            """SELECT CAST(id % 3 AS VARCHAR) AS part, CASE WHEN bad = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS load_status,
  source_rows, CASE WHEN bad = 0 THEN source_rows ELSE 0 END AS fact_rows, device_count,
  CASE WHEN bad > 0 THEN bad || ' rows without device, id or time' END AS error, CAST(CASE WHEN bad = 0 THEN 0 ELSE 1 END AS BIGINT) AS rc
FROM (
  SELECT id % 3 AS id, count(*) AS source_rows, count(*) FILTER (WHERE id % 3 = 2 AND battery_state = 'Full') AS bad,
    count(DISTINCT CASE WHEN NOT (id % 3 = 2 AND coalesce(battery_state, '') = 'Full') THEN device_id END) AS device_count
  FROM raw GROUP BY id % 3
)""",
        ),
        "raw_types": with_("parts", f"SELECT * EXCLUDE ({', '.join(lineage)}) FROM ({fact})"),
        "auto_mode": with_(
            "raw",
            """SELECT * FROM (
  SELECT 's1' AS batch_id, 'SUCCESS' AS load_status, count(*) FILTER (WHERE id % 3 <> 2) AS rows_silver_out,
    CAST(0 AS BIGINT) AS n_duplicates, 'catchup' AS mode FROM raw
  UNION ALL SELECT 's2', 'SUCCESS', count(*) FILTER (WHERE id % 3 = 2),
    count(*) FILTER (WHERE id % 3 = 2 AND battery_state = 'Full'), 'catchup' FROM raw
  UNION ALL SELECT 's3', 'SUCCESS', 0, count(*) FILTER (WHERE battery_state = 'Full'), 'increment' FROM raw
  UNION ALL SELECT 's4', 'SUCCESS', 0, count(*) FILTER (WHERE battery_state = 'Full'), 'increment' FROM raw
)""",
        ),
        "lake_gold": with_(
            "silver",
            "SELECT date_local, country_code, max(country_name) AS country_name, count(*) AS n_events, "
            "count(DISTINCT device_id) AS n_devices, 'gold-1' AS _gold_batch_id FROM silver GROUP BY date_local, country_code",
        ),
        "mart_runs": with_(
            "silver",
            """SELECT mart, batch_id, 'SUCCESS' AS load_status, rows_silver_in,
  CASE mart WHEN 'country_overview' THEN countries ELSE devices END AS rows_gold_out, CAST(0 AS BIGINT) AS rc
FROM (SELECT count(*) AS rows_silver_in, count(DISTINCT country_code) AS countries, count(DISTINCT device_id) AS devices FROM silver)
CROSS JOIN (VALUES ('country_overview', 'g1'), ('country_overview', 'g2'), ('device_lifecycle', 'g1')) AS runs(mart, batch_id)""",
        ),
    }


def all_queries() -> dict[str, str]:
    return {
        **plan_queries(),
        **expression_queries(),
        **bronze_queries(),
        **silver_queries(),
        **mart_queries(),
        **stream_queries(),
        **ledger_queries(),
    }
