
from __future__ import annotations

import datetime as dt
import uuid
import warnings
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import oracle_queries
from medallion import schemas
from medallion.functions import (
    calendar_parts,
    domain_flags,
    event_time,
    guarded_ratio,
    is_one,
    normalize_code,
    normalize_key,
    parse_event_ts,
    stable_uuid,
    tri_bool,
)
from medallion.operators import audit, dims, enrich, facts, increment
from medallion.operators.conform import conform, evolve, null_counts
from medallion.operators.dedup import fact_dedup, latest_by
from medallion.operators.indexing import dense_index
from medallion.operators.joins import MAX_BROADCAST_BYTES, lookup_join, salted_join
from medallion.operators.marts import MARTS, MartSpec, aggregate, build_mart, stamped
from medallion.plans import key_filters
from medallion.plans.bronze import ingest_files, stream_files
from medallion.plans.gold import refresh_mart
from medallion.plans.lake import ATTEMPT, SILVER_LEDGER, Lake, merge_days, read_facts, read_silver_rows, register_lake, write_rows
from medallion.plans.silver import refresh_silver
from medallion.plans.stream_silver import rebuild_all, refresh_from_changes
from medallion.session import configure, scratch_path, short_methods
from medallion.sources import buckets, contracts, files, samples, versions
from medallion.sources.reference import read_reference, replace_reference
from medallion.sources.tables import append, read_table, register_views, write_once
from medallion.sources.versions import file_system
from medallion.streaming import envelope, layers, records
from medallion.streaming import queries as streams

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"
LOADED_AT = "2024-02-01 00:00:00"
FIRST_NOON = "2024-01-01 12:00:00"
BUILT_AT = "2024-02-02 00:00:00"
GOLD_AT = "2024-02-03 00:00:00"
FIXED_NOW = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
NOW = "2024-02-01T00:00:00Z"
SILVER_BATCH = "silver-1"
GOLD_BATCH = "gold-1"
# Averages are rounded to 6 digits; the shift lets exact halves fall the same way in every engine.
ROUND_DIGITS = 6
ROUND_SHIFT = 1e-9

_queries: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    _queries[function.__name__] = run
    return function


def rounded(df: DataFrame) -> DataFrame:
    doubles = [field.name for field in df.schema.fields if isinstance(field.dataType, T.DoubleType)]
    return df.withColumns({name: F.round(F.col(name) + F.lit(ROUND_SHIFT), ROUND_DIGITS) for name in doubles})


# Inputs shared by several queries ---------------------------------------------------------------------------


def raw_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.with_parts(samples.telemetry(spark, sf_dir))


def raw_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_parts(spark, sf_dir)
    return raw.unionByName(samples.late_copies(raw))


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.silver_from_raw(
        raw_parts(spark, sf_dir), samples.country_reference(spark, sf_dir), SILVER_BATCH, BUILT_AT
    )


def existing_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What silver holds after the first two of the three files."""
    seen = raw_parts(spark, sf_dir).where(F.col("_part_index") < samples.PART_COUNT - 1)
    return enrich.silver_from_raw(seen, samples.country_reference(spark, sf_dir), SILVER_BATCH, BUILT_AT)


def stored_bronze(spark: SparkSession, sf_dir: str, copies: bool = False) -> DataFrame:
    """Bronze facts as the table a silver job would read."""
    short_methods(spark)
    raw = raw_with_copies(spark, sf_dir) if copies else raw_parts(spark, sf_dir)
    return write_once(facts.build_fact(raw), scratch_path(spark, "fact"), ["event_date"])


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_once(existing_silver(spark, sf_dir), scratch_path(spark, "silver"), ["event_date"])


def stored_dimensions(spark: SparkSession, sf_dir: str, random_ids: bool = False) -> tuple[DataFrame, DataFrame]:
    raw = samples.telemetry(spark, sf_dir)
    categories = dims.new_category_rows(dims.category_values(raw), None, LOADED_AT, random_ids)
    devices = dims.new_device_rows(dims.device_values(raw), None, LOADED_AT, random_ids)
    return (
        write_once(categories, scratch_path(spark, "dims"), ["dim_name"]),
        write_once(devices, scratch_path(spark, "devices")),
    )


def known_dimensions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Dimension rows of an earlier load: the categories of the first file, the devices seen by FIRST_NOON."""
    raw = raw_parts(spark, sf_dir)
    first_file, early = raw.where(F.col("_part_index") == 0), raw.where(F.col("timestamp") < FIRST_NOON)
    return (
        dims.new_category_rows(dims.category_values(first_file), None, LOADED_AT),
        dims.new_device_rows(dims.device_values(early), None, LOADED_AT),
    )


# Expressions ------------------------------------------------------------------------------------------------


@query
def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_time(samples.telemetry(spark, sf_dir)).select("id", "event_ts_str", "event_date")


@query
def normalize_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = samples.telemetry(spark, sf_dir)
    return raw.select("id", *[normalize_key(spec.source).alias(spec.name) for spec in dims.CATEGORY_DIMS])


@query
def tri_bools(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = samples.telemetry(spark, sf_dir)
    return raw.select(
        "id", is_one("screen_on").alias("screen_on"), *[tri_bool(name).alias(name) for name in schemas.FLAG_COLUMNS]
    )


@query
def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = event_time(samples.telemetry(spark, sf_dir))
    return timed.withColumns(calendar_parts(parse_event_ts())).select(
        "id", F.col("event_date").alias("date_local"), "hour_of_day", "day_of_week"
    )


@query
def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = event_time(samples.telemetry(spark, sf_dir))
    return timed.withColumns(domain_flags(parse_event_ts())).select(
        "id", "is_night", "is_charging", "is_wifi", "battery_low"
    )


@query
def usage_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = samples.telemetry(spark, sf_dir)
    memory = F.col("memory_active") + F.col("memory_inactive") + F.col("memory_free") + F.col("memory_user")
    return raw.select(
        "id",
        guarded_ratio(F.col("memory_active") + F.col("memory_user"), memory).alias("memory_used_pct"),
        guarded_ratio(F.col("total") - F.col("free"), F.col("total")).alias("storage_used_pct"),
    )


@query
def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = event_time(samples.telemetry(spark, sf_dir))
    return timed.select(
        "id",
        stable_uuid(facts.FACT_NAMESPACE, "id", "device_id", "event_ts_str").alias("fact_uid"),
        dims.device_stable_uid().alias("device_uid"),
        stable_uuid("dim_battery_state", "battery_state").alias("battery_state_uid"),
    )


# Dimensions -------------------------------------------------------------------------------------------------


@query
def dim_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.category_values(samples.telemetry(spark, sf_dir))


@query
def dim_device_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.device_values(samples.telemetry(spark, sf_dir))


@query
def dim_only_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, _ = known_dimensions(spark, sf_dir)
    return dims.new_category_rows(dims.category_values(samples.telemetry(spark, sf_dir)), known, LOADED_AT)


@query
def dim_device_only_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, known = known_dimensions(spark, sf_dir)
    return dims.new_device_rows(dims.device_values(samples.telemetry(spark, sf_dir)), known, LOADED_AT)


@query
def dim_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads that both made rows for the same values collapse to one id per value."""
    rows = dims.new_category_rows(dims.category_values(samples.telemetry(spark, sf_dir)), None, LOADED_AT)
    again = rows.withColumn("uid", F.concat(F.lit("~"), "uid"))
    return dims.category_mapping(rows.unionByName(again))


@query
def dim_device_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dims.new_device_rows(dims.device_values(samples.telemetry(spark, sf_dir)), None, LOADED_AT)
    again = rows.withColumn("device_uid", F.concat(F.lit("~"), "device_uid"))
    return dims.device_mapping(rows.unionByName(again))


@query
def dim_random_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random ids: one per value, no id twice. The ids themselves differ from run to run."""
    categories, devices = stored_dimensions(spark, sf_dir, random_ids=True)
    keys = categories.select("dim_name", "raw_value", "uid").unionByName(
        devices.select(
            F.lit("device").alias("dim_name"),
            F.col("device_id").cast("string").alias("raw_value"),
            F.col("device_uid").alias("uid"),
        )
    )
    shared = keys.groupBy("uid").agg(F.count("*").alias("n_values"))
    return keys.join(shared, "uid").groupBy("dim_name", "raw_value").agg(
        F.count("*").alias("n_ids"), F.max("n_values").alias("n_values"), F.max(F.length("uid")).cast("long").alias("width")
    )


# Facts ------------------------------------------------------------------------------------------------------


@query
def fact_stable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.build_fact(raw_parts(spark, sf_dir))


@query
def fact_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories looked up, device ids computed: the default load."""
    categories, _ = stored_dimensions(spark, sf_dir)
    return facts.build_fact(raw_parts(spark, sf_dir), facts.load_lookups(categories))


@query
def fact_lookup_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimensions with ids made elsewhere, three of them as if too big to broadcast: every id comes from the tables."""
    categories, devices = stored_dimensions(spark, sf_dir)
    mark = F.lit("own-")
    lookups = facts.load_lookups(
        categories.withColumn("uid", F.concat(mark, "uid")), devices.withColumn("device_uid", F.concat(mark, "device_uid"))
    )
    big = dict.fromkeys(("device", "country", "wifi_status"), MAX_BROADCAST_BYTES + 1)
    lookups = replace(lookups, sizes={**lookups.sizes, **big})
    source = facts.fact_source(raw_parts(spark, sf_dir))
    keyed = facts.require_all_keys(facts.with_looked_up_keys(source, lookups))
    return conform(
        keyed.withColumns({name: F.regexp_extract(name, "^own-(.*)$", 1) for name in facts.fact_keys()}), schemas.FACT
    )


@query
def fact_lookup_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts and devices bucketed alike, so that device ids made elsewhere come without a shuffle of facts."""
    categories, devices = stored_dimensions(spark, sf_dir)
    own = devices.withColumn("device_uid", F.concat(F.lit("own-"), "device_uid"))
    name = f"lookup_{uuid.uuid4().hex}"
    layout = buckets.Layout(name, scratch_path(spark, name), "device_id", buckets=8)
    source = facts.with_bucketed_devices(facts.fact_source(raw_parts(spark, sf_dir)), own, layout)
    keyed = facts.require_all_keys(facts.with_looked_up_keys(source, facts.load_lookups(categories)))
    return conform(keyed.withColumn("device_uid", F.regexp_extract("device_uid", "^own-(.*)$", 1)), schemas.FACT)


@query
def fact_random_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts keyed with random ids, decoded again: the natural values must come back."""
    categories, devices = stored_dimensions(spark, sf_dir, random_ids=True)
    fact = facts.build_fact(raw_parts(spark, sf_dir), facts.load_lookups(categories, devices))
    wide = enrich.decode(fact, enrich.load_decoders(categories, devices))
    return wide.select("fact_uid", "device_id", *enrich.DECODED.values())


@query
def null_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL keys per column when the dimensions were loaded from the first file only."""
    known, known_devices = known_dimensions(spark, sf_dir)
    known = write_once(known, scratch_path(spark, "dims"), ["dim_name"])
    known_devices = write_once(known_devices, scratch_path(spark, "devices"))
    lookups = facts.load_lookups(known, known_devices)
    keyed = facts.with_looked_up_keys(facts.fact_source(raw_parts(spark, sf_dir)), lookups)
    return null_counts(keyed, facts.fact_keys())


@query
def table_source_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = samples.telemetry(spark, sf_dir)
    stamped_rows = files.stamp_table_source(raw, "staging", samples.BATCH_ID, LOADED_AT, raw.count())
    return facts.build_fact(stamped_rows).select("fact_uid", *facts.LINEAGE)


# Run plans --------------------------------------------------------------------------------------------------


def write_raw_files(spark: SparkSession, raw: DataFrame, root: str, parts: int = samples.PART_COUNT) -> None:
    """Raw telemetry as files below ``root``, one folder and file per part. Parts are written beside each other."""

    def write(part: int) -> None:
        write_one_file(raw.where(F.col("id") % parts == part), f"{root}/day={part} [a] {{b}}")

    with ThreadPoolExecutor(parts) as pool:
        list(pool.map(write, range(parts)))


def write_one_file(raw: DataFrame, path: str) -> None:
    """Rows as one more file of a folder: all tasks make them, one writes them."""
    raw.repartition(1).write.mode("append").parquet(path)


def file_part() -> F.Column:
    """The part that a file was written for."""
    return F.regexp_extract("_source_file", "day(?:=|%3D)([0-9])", 1)


def empty_lake(spark: SparkSession, sf_dir: str) -> Lake:
    lake = Lake(scratch_path(spark, "lake"))
    samples.country_reference(spark, sf_dir).write.parquet(lake.reference)
    return lake


def lake_in_parts(spark: SparkSession, sf_dir: str) -> Lake:
    """Events as files, loaded by several jobs and calls of one batch id and by two streams."""
    root, lake = scratch_path(spark, "raw"), empty_lake(spark, sf_dir)
    raw = samples.telemetry(spark, sf_dir)
    write_raw_files(spark, raw.where("id % 2 = 0"), f"{root}/one")
    ingest_files(spark, f"{root}/one", lake, "batch", FIXED_NOW, files_per_job=2)
    write_raw_files(spark, raw.where("id % 4 = 1"), f"{root}/one")
    ingest_files(spark, f"{root}/one", lake, "batch", FIXED_NOW)
    for rest in (0, 1):
        write_raw_files(spark, raw.where(f"id % 8 = {4 * rest + 3}"), f"{root}/stream{rest}")
        stream_files(spark, f"{root}/stream{rest}", lake, f"{root}/cp{rest}").awaitTermination()
    return lake


def facts_by_part(facts_read: DataFrame) -> DataFrame:
    return facts_read.groupBy(file_part().alias("part"), "event_date").agg(
        F.count("*").alias("n_facts"), F.sum("source_id").alias("sum_id")
    )


@query
def ingest_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All facts of all files, whichever job, call or stream loaded them."""
    return facts_by_part(read_facts(spark, lake_in_parts(spark, sf_dir)))


@query
def facts_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same facts after merging, with as many folders as a day then has; a reader of the version before still
    sees its rows."""
    lake = lake_in_parts(spark, sf_dir)
    before = read_facts(spark, lake)
    merge_days(spark, lake)
    after = read_facts(spark, lake)
    folder = F.regexp_extract(F.input_file_name(), "_attempt=([^/]+)/", 1)
    folders = after.select("event_date", folder.alias("folder")).groupBy("event_date").agg(F.countDistinct("folder").alias("n_folders"))
    kept = before.groupBy("event_date").agg(F.count("*").alias("n_before"))
    return facts_by_part(after).join(folders, "event_date").join(kept, "event_date")


@query
def versions_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table is replaced twice while it is read, and two writers want one version: what the readers see."""
    path = scratch_path(spark, "versions")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")

    def counted(column: str) -> DataFrame:
        return orders.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_orders"))

    versions.replace_rows(counted("o_orderstatus"), path)
    with versions.pinned(spark, path) as first:
        for column in ("o_orderpriority", "o_orderstatus", "o_orderpriority"):
            versions.replace_rows(counted(column).withColumn("value", F.col("value").cast("string")), path)
        newest = versions.latest(spark, path)
        entry = versions.write_attempt(counted("o_custkey").withColumn("value", F.lit("lost")), path)
        late = versions.Version(newest.number, (entry,), newest.schema)
        seen = {"pinned": first, "newest": newest, "late writer": newest if not versions.publish(spark, path, late) else late}
        parts = [versions.rows_of(spark, path, version).withColumn("reader", F.lit(reader)) for reader, version in seen.items()]
        return write_once(parts[0].unionByName(parts[1]).unionByName(parts[2]), scratch_path(spark, "seen"))


def file_of(spark: SparkSession, folder: str) -> str:
    """A parquet file of a folder."""
    return files.list_files(spark, folder).orderBy("path").first()["place"]


def damage_pages(spark: SparkSession, place: str) -> None:
    """Overwrite the pages of a parquet file; its footer stays sound."""
    jvm = spark._jvm
    store, path = file_system(spark, place)
    stream = store.open(path)
    content = bytearray(jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    stream.close()
    footer = int.from_bytes(content[-8:-4], "little") + 8
    content[4 : len(content) - footer] = b"\xff" * (len(content) - footer - 4)
    out = store.create(path, True)
    out.write(content)
    out.close()


def load_outcomes(spark: SparkSession, lake: Lake) -> DataFrame:
    loads = read_table(spark, lake.audit("file_loads"), schemas.FILE_LOADS)
    return loads.withColumnRenamed("file_key", "_source_file").select(file_part().alias("part"), "load_status", "fact_rows")


@query
def bad_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four files, one a job or all in one, of which the first has a sound footer and damaged pages: it fails alone."""
    raw, outcomes = samples.telemetry(spark, sf_dir), []
    for per_job in (1, 4):
        root, lake = scratch_path(spark, "raw"), empty_lake(spark, sf_dir)
        write_raw_files(spark, raw, root, parts=4)
        damage_pages(spark, file_of(spark, versions.escaped(f"{root}/day=0 [a] {{b}}")))
        ingest_files(spark, root, lake, "batch", FIXED_NOW, files_per_job=per_job)
        facts_read = read_facts(spark, lake).groupBy(file_part().alias("part")).agg(F.count("*").alias("n_facts"))
        outcomes.append(load_outcomes(spark, lake).join(facts_read, "part", "left").withColumn("per_job", F.lit(per_job)))
    return outcomes[0].unionByName(outcomes[1])


@query
def bad_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three files, one of which holds an array where the contract has a number: it fails alone."""
    root, lake = scratch_path(spark, "raw"), empty_lake(spark, sf_dir)
    raw = samples.telemetry(spark, sf_dir)
    write_raw_files(spark, raw.where("id % 3 <> 1"), root)
    bad = raw.where("id % 3 = 1").withColumn("battery_level", F.array(F.lit(1)))
    write_one_file(bad, f"{root}/bad/day=1")
    ingest_files(spark, root, lake, "batch", FIXED_NOW)
    facts_read = read_facts(spark, lake).groupBy(file_part().alias("part")).agg(F.count("*").alias("n_facts"))
    return load_outcomes(spark, lake).where("NOT (part = '1' AND fact_rows = 0 AND load_status = 'SUCCESS')").join(facts_read, "part", "left")


@query
def file_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three files of which the last has rows without a device: it fails alone, the others are loaded."""
    root, lake = scratch_path(spark, "raw"), empty_lake(spark, sf_dir)
    raw = samples.telemetry(spark, sf_dir)
    no_device = (F.col("id") % samples.PART_COUNT == samples.PART_COUNT - 1) & F.col("battery_state").eqNullSafe("Full")
    write_raw_files(spark, raw.withColumn("device_id", F.when(~no_device, F.col("device_id"))), root)
    ingest_files(spark, root, lake, "batch", FIXED_NOW)
    loads = read_table(spark, lake.audit("file_loads"), schemas.FILE_LOADS)
    return loads.withColumnRenamed("file_key", "_source_file").select(
        file_part().alias("part"), "load_status", "source_rows", "fact_rows", "device_count", "error", "rc"
    )


@query
def raw_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with times as text, a category as number and a measure as double: the same facts."""
    root, lake = scratch_path(spark, "raw"), empty_lake(spark, sf_dir)
    raw = samples.telemetry(spark, sf_dir)
    typed = raw.withColumns(
        {
            "timestamp": F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
            "id": F.col("id").cast("int"),
            "memory_active": F.col("memory_active").cast("double"),
            "device_id": F.col("device_id").cast("string"),
        }
    )
    write_raw_files(spark, typed.where("id % 2 = 0"), f"{root}/typed")
    write_raw_files(spark, raw.where("id % 2 = 1"), f"{root}/plain")
    ingest_files(spark, root, lake, samples.BATCH_ID, FIXED_NOW)
    return read_facts(spark, lake).drop(*facts.LINEAGE)


def loaded_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake with the events of three files in bronze, two of them in silver, and a file that repeats events."""
    root, lake = scratch_path(spark, "raw"), empty_lake(spark, sf_dir)
    raw = samples.telemetry(spark, sf_dir)
    last = F.col("id") % samples.PART_COUNT == samples.PART_COUNT - 1
    write_raw_files(spark, raw.where(~last), f"{root}/first")
    ingest_files(spark, f"{root}/first", lake, "b1", FIXED_NOW)
    refresh_silver(spark, lake, "s1", FIXED_NOW)
    write_one_file(raw.where(last), f"{root}/second/new")
    write_one_file(raw.where(F.col("battery_state") == "Full"), f"{root}/second/again")
    ingest_files(spark, f"{root}/second", lake, "b2", FIXED_NOW)
    return lake


@query
def auto_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs in automatic mode after a file of duplicates: one catches up, the others look at late rows."""
    lake = loaded_lake(spark, sf_dir)
    for run in ("s2", "s3", "s4"):
        refresh_silver(spark, lake, run, FIXED_NOW)
    runs = read_table(spark, lake.audit("layer_runs"), schemas.LAYER_RUNS)
    return runs.select(
        "batch_id",
        "load_status",
        "rows_silver_out",
        (F.col("rows_bronze_in") - F.col("rows_after_dedup")).alias("n_duplicates"),
        F.regexp_extract("message", "'mode': '([a-z]+)'", 1).alias("mode"),
    )


@query
def lake_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From files to a mart through the run plans; what the mart's table holds."""
    lake = loaded_lake(spark, sf_dir)
    refresh_silver(spark, lake, "s2", FIXED_NOW, files_per_job=1)
    refresh_mart(spark, lake, "daily_country_stats", "old", FIXED_NOW)
    refresh_mart(spark, lake, "daily_country_stats", GOLD_BATCH, FIXED_NOW)
    mart = read_table(spark, lake.gold("daily_country_stats"), MARTS["daily_country_stats"].schema)
    return mart.select("date_local", "country_code", "country_name", "n_events", "n_devices", "_gold_batch_id")


@query
def mart_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run records of two marts, one of which is refreshed twice."""
    lake = loaded_lake(spark, sf_dir)
    refresh_silver(spark, lake, "s2", FIXED_NOW)
    for mart, run in (("country_overview", "g1"), ("country_overview", "g2"), ("device_lifecycle", "g1")):
        refresh_mart(spark, lake, mart, run, FIXED_NOW)
    runs = read_table(spark, lake.audit("mart_runs"), schemas.MART_RUNS)
    return runs.select("mart", "batch_id", "load_status", "rows_silver_in", "rows_gold_out", "rc")


@query
def mart_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart merged from day states, refreshed before and after late rows came for the same days."""
    lake = loaded_lake(spark, sf_dir)
    refresh_mart(spark, lake, "country_overview", "old", FIXED_NOW, by_days=True)
    refresh_silver(spark, lake, "s2", FIXED_NOW)
    refresh_mart(spark, lake, "country_overview", GOLD_BATCH, FIXED_NOW, by_days=True)
    mart = read_table(spark, lake.gold("country_overview"), MARTS["country_overview"].schema)
    return rounded(mart.withColumn("_gold_built_at", F.lit(GOLD_AT)))


# Silver -----------------------------------------------------------------------------------------------------


@query
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    short_methods(spark)
    return fact_dedup(facts.build_fact(raw_with_copies(spark, sf_dir)))


@query
def missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return increment.missing_files(stored_bronze(spark, sf_dir, copies=True), stored_silver(spark, sf_dir))


@query
def file_catchup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze, silver = stored_bronze(spark, sf_dir, copies=True), stored_silver(spark, sf_dir)
    return increment.new_facts(bronze, silver, mode="catchup")


@query
def increment_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze, silver = stored_bronze(spark, sf_dir, copies=True), stored_silver(spark, sf_dir)
    return increment.new_facts(bronze, silver, mode="increment")


@query
def unseen_by_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows by filters of silver's keys. Silver lies in two attempts, of which one has filters."""
    bronze, silver = stored_bronze(spark, sf_dir, copies=True), existing_silver(spark, sf_dir)
    lake = Lake(scratch_path(spark, "lake"))
    for rest in (0, 1):
        write_rows(silver.where(F.col("source_id") % 2 == rest), lake.silver, f"a{rest}")
        entry = {**dict.fromkeys(SILVER_LEDGER.names), ATTEMPT: f"a{rest}"}
        append(spark.createDataFrame([entry], SILVER_LEDGER), lake.silver_ledger)
        if rest == 0:
            key_filters.refresh_key_filters(spark, lake)
    newest = increment.newest_load(read_silver_rows(spark, lake), "_bronze_loaded_at")
    selected = increment.overlap_selection(bronze, newest)
    return key_filters.unseen_by_filters(spark, lake, fact_dedup(selected), selected)


@query
def silver_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver through the star: facts decoded with the dimension tables."""
    decoders = enrich.load_decoders(*stored_dimensions(spark, sf_dir))
    fact = facts.build_fact(raw_parts(spark, sf_dir))
    return enrich.build_silver(fact, decoders, samples.country_reference(spark, sf_dir), SILVER_BATCH, BUILT_AT)


@query
def silver_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_rows(spark, sf_dir)


@query
def silver_restored_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.restore_nulls(silver_rows(spark, sf_dir)).select("fact_uid", *enrich.DECODED.values())


@query
def country_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their nation's reference row; the reference covers only part of the nations."""
    customers = samples.with_home(spark, sf_dir, samples.sample_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer")), "customer")
    coded = customers.select("customer", F.concat(F.lit(" "), F.lower("n_name")).alias("country_code"))
    reference = samples.country_reference(spark, sf_dir).where(F.col("region") != "EUROPE")
    return enrich.enrich_country(coded, reference)


@query
def reference_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The country reference after two full replacements."""
    path, reference = scratch_path(spark, "reference"), samples.country_reference(spark, sf_dir)
    replace_reference(reference.withColumn("country_name", F.lower("country_name")), path)
    replace_reference(reference, path)
    return read_reference(spark, path)


@query
def salted_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join used when a looked-up table is too big to broadcast."""
    events = samples.sample_table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    users = samples.sample_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment"
    )
    return salted_join(events, users, "user_id", "left")


@query
def checked_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of known customers, broadcast only after the customer keys were measured."""
    events = samples.sample_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    customers = samples.sample_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return lookup_join(events, customers, "user_id", "left_semi")


# Gold -------------------------------------------------------------------------------------------------------


def _mart_query(name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(build_mart(silver_rows(spark, sf_dir), MARTS[name], GOLD_BATCH, GOLD_AT))

    run.__name__ = name
    query(run)


for _name in MARTS:
    _mart_query(_name)

ORDERS_DAILY_NATION = MartSpec(
    name="orders_daily_nation",
    grain=("order_date", "nation"),
    schema=stamped(
        schemas.table(
            string="order_date! nation",
            long="n_orders! n_customers! n_urgent",
            double="avg_price min_price max_price urgent_rate",
        )
    ),
    count="n_orders",
    distinct={"n_customers": "o_custkey"},
    averages={"avg_price": "o_totalprice"},
    minima={"min_price": "o_totalprice"},
    maxima={"max_price": "o_totalprice"},
    flags={"n_urgent": "is_urgent"},
    ratios={"urgent_rate": ("n_urgent", "n_orders")},
)
SUPPLIER_OVERVIEW = MartSpec(
    name="supplier_overview",
    grain=("l_suppkey",),
    schema=stamped(
        schemas.table(
            long="l_suppkey! n_lines! n_orders n_parts",
            string="first_shipped last_shipped",
            double="avg_quantity avg_discount",
            long__2="n_returned",
            double__2="return_rate lines_per_order",
        )
    ),
    count="n_lines",
    distinct={"n_orders": "l_orderkey", "n_parts": "l_partkey"},
    averages={"avg_quantity": "l_quantity", "avg_discount": "l_discount"},
    flags={"n_returned": "is_returned"},
    first_days={"first_shipped": "ship_date"},
    last_days={"last_shipped": "ship_date"},
    ratios={"return_rate": ("n_returned", "n_lines"), "lines_per_order": ("n_lines", "n_orders")},
)


@query
def orders_daily_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = samples.sample_table(spark, sf_dir, "orders")
    placed = samples.with_home(spark, sf_dir, orders, "o_custkey").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.col("n_name").alias("nation"),
        "o_custkey",
        "o_totalprice",
        (F.col("o_orderpriority") == "1-URGENT").alias("is_urgent"),
    )
    return rounded(build_mart(placed, ORDERS_DAILY_NATION, GOLD_BATCH, GOLD_AT))


@query
def supplier_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = samples.sample_table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        "l_orderkey",
        "l_partkey",
        "l_quantity",
        "l_discount",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"),
        (F.col("l_returnflag") == "R").alias("is_returned"),
    )
    return rounded(build_mart(lines, SUPPLIER_OVERVIEW, GOLD_BATCH, GOLD_AT))


@query
def mart_without_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily mart over a silver table from before the country names were added."""
    old = silver_rows(spark, sf_dir).drop(*schemas.COUNTRY_COLUMNS.names)
    return aggregate(old, MARTS["daily_country_stats"]).select(
        "date_local", "country_code", "country_name", "n_events", "n_devices"
    )


@query
def sql_layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain SQL over a stored layer."""
    path = scratch_path(spark, "silver")
    write_once(silver_rows(spark, sf_dir), path, ["event_date"])
    register_views(spark, {"silver_telemetry": path}, {"silver_telemetry": schemas.SILVER})
    return spark.sql(
        "SELECT event_date, battery_state, count(*) AS n_rows FROM silver_telemetry "
        "WHERE is_wifi GROUP BY event_date, battery_state"
    )


@query
def sql_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A preview of a lake's views by SQL with a limit, the latest events first."""
    lake = loaded_lake(spark, sf_dir)
    register_lake(spark, lake)
    return spark.sql(
        "SELECT s.source_id, s.event_date, d.raw_value AS battery_state FROM silver_telemetry s "
        "JOIN dim_battery_state d ON d.raw_value = s.battery_state ORDER BY s.source_id DESC LIMIT 20"
    )


@query
def processing_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column of the processing time: UTC text of microseconds, one moment a query, not in the future."""
    stamped_rows = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("at", streams.now_text())
    moment = F.to_timestamp("at")
    return stamped_rows.groupBy("o_orderstatus").agg(
        F.count("*").alias("n_orders"),
        F.count_if(F.col("at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}(Z|[+]00:00)$")).alias("n_texts"),
        F.count_if((moment <= F.current_timestamp()) & (moment > F.current_timestamp() - F.expr("INTERVAL 1 DAY"))).alias("n_recent"),
        F.countDistinct("at").alias("n_moments"),
    )


# Streams ----------------------------------------------------------------------------------------------------


def event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = samples.event_items(spark, sf_dir)
    return envelope.build_envelopes(
        items,
        source="jsonplaceholder_todos",
        stream_id=F.col("_stream"),
        event_type="todo_event",
        entity="userId",
        batch_id="poll-1",
        now=NOW,
        payload=envelope.payload_text(["id", "userId", "title", "body"]),
        event_ts=F.col("_ts"),
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a topic; error events are broken text, signup events are JSON but no object."""
    items = samples.event_items(spark, sf_dir)
    body = envelope.payload_text(["id", "userId", "title", "completed"])
    good = F.to_json(
        F.struct(
            F.lit("jsonplaceholder_todos").alias("source"),
            F.col("_stream").alias("stream_id"),
            F.lit("todo_event").alias("event_type"),
            F.col("_ts").alias("event_ts"),
            F.col("userId").alias("entity_id"),
            body.alias("payload_json"),
        )
    )
    number = F.col("id").cast("string")
    # No JSON at all, text or a second object behind the first, single quotes.
    broken = F.element_at(
        F.array(
            F.concat(F.lit("not json "), number),
            F.concat(F.lit('{"source":"a"} '), number),
            F.concat(F.lit('{"source":"a"}{"id":'), number, F.lit("}")),
            F.concat(F.lit("{'source':'a"), number, F.lit("'}")),
        ),
        (F.col("id") % 4 + 1).cast("int"),
    )
    value = (
        F.when(F.col("title") == "error", broken)
        .when(F.col("title") == "signup", F.concat(F.lit("["), F.col("id").cast("string"), F.lit("]")))
        .otherwise(good)
    )
    return samples.as_topic(items.withColumn("value", value), "id", LOADED_AT)


def queue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event through envelope, message, parsing and routing."""
    items = samples.event_items(spark, sf_dir)
    value = envelope.payload_text(["source", "stream_id", "event_type", "event_ts", "entity_id", "payload_json"])
    messages = items.select(
        "id",
        F.lit("jsonplaceholder_todos").alias("source"),
        F.col("_stream").alias("stream_id"),
        F.lit("todo_event").alias("event_type"),
        F.col("_ts").alias("event_ts"),
        F.col("userId").alias("entity_id"),
        envelope.payload_text(["id", "userId", "title", "completed"]).alias("payload_json"),
    ).withColumn("value", value)
    parsed = envelope.parse_messages(samples.as_topic(messages, "id", LOADED_AT))
    return envelope.raw_rows(envelope.accepted(parsed), F.lit("poll-1"), F.lit(NOW))


@query
def envelope_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_envelopes(spark, sf_dir)


@query
def kafka_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.kafka_messages(event_envelopes(spark, sf_dir))


@query
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.rejected(envelope.parse_messages(event_messages(spark, sf_dir)))


@query
def route_tablet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue_rows(spark, sf_dir)


@query
def bronze_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue rows delivered twice; the later processing wins, one row per key remains."""
    queue = queue_rows(spark, sf_dir)
    first = layers.bronze_rows(queue, F.lit(NOW))
    again = layers.bronze_rows(queue, F.lit("2024-02-01T00:05:00Z"))
    return layers.collapse(first.unionByName(again))


@query
def bronze_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = layers.bronze_rows(queue_rows(spark, sf_dir), F.lit(NOW)).where(F.col("tablet_index") == 0)
    return rows.groupBy("stream_id").agg(F.count("*").alias("n_rows"))


def _payload_bronze(items: DataFrame, spec: layers.PayloadSpec, stream_id: str) -> DataFrame:
    """The items as bronze rows of their source, with the whole item as JSON payload."""
    events = envelope.build_envelopes(items, spec.source, stream_id, "sample_event", "id", "poll-1", NOW)
    return layers.bronze_rows(
        events.select(
            "source", "stream_id", "event_type", "event_ts", "entity_id", "payload_json",
            F.lit(samples.TOPIC).alias("kafka_topic"),
            F.lit(0).cast("long").alias("kafka_partition"),
            F.col("entity_id").cast("long").alias("kafka_offset"),
            F.lit(NOW).alias("ingested_at"),
            F.col("ingest_batch_id").alias("batch_id"),
            envelope.route(F.col("stream_id")).alias("tablet_index"),
        ),
        F.lit(NOW),
    )


@query
def payload_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents travel as JSON and come back typed."""
    items = samples.sample_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("n_chars").alias("userId"),
        F.col("source").alias("title"),
        F.col("text").alias("body"),
    )
    spec = layers.PAYLOADS["streaming_posts"]
    return layers.payload_rows(_payload_bronze(items, spec, "s0"), spec, F.lit(NOW))


@query
def payload_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = samples.sample_table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.col("conv_id").alias("postId"),
        F.col("role").alias("name"),
        F.concat(F.col("role"), F.lit("@example.org")).alias("email"),
        F.col("text").alias("body"),
    )
    spec = layers.PAYLOADS["streaming_comments"]
    return layers.payload_rows(_payload_bronze(items, spec, "s1"), spec, F.lit(NOW))


@query
def payload_todos(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = samples.event_items(spark, sf_dir).select("id", "userId", "title", "completed")
    spec = layers.PAYLOADS["streaming_todos"]
    return layers.payload_rows(_payload_bronze(items, spec, "s2"), spec, F.lit(NOW))


SOURCE_OF_STREAM = {
    stream: spec.source
    for spec in layers.PAYLOADS.values()
    for stream, index in envelope.STREAM_PARTITIONS.items()
    if index == spec.tablet_index
}


def fan_out_messages(spark: SparkSession, sf_dir: str, partitions: int = 1) -> DataFrame:
    """The events as a topic whose streams carry the three sources; see ``event_messages`` for the broken ones."""
    items = samples.event_items(spark, sf_dir).where(~F.col("title").isin("error", "signup"))
    source = F.lit(None)
    for stream, name in SOURCE_OF_STREAM.items():
        source = F.when(F.col("_stream") == stream, F.lit(name)).otherwise(source)
    payload = F.struct(
        "id", "userId", F.col("userId").alias("postId"), "title", F.col("title").alias("name"), "body", "completed"
    )
    value = F.to_json(
        F.struct(
            source.alias("source"),
            F.col("_stream").alias("stream_id"),
            F.lit("sample_event").alias("event_type"),
            F.col("_ts").alias("event_ts"),
            F.col("userId").alias("entity_id"),
            F.to_json(payload, {"ignoreNullFields": "false"}).alias("payload_json"),
        )
    )
    good = samples.as_topic(items.withColumn("value", value), "id", LOADED_AT)
    kinds = samples.event_items(spark, sf_dir).where(F.col("title").isin("error", "signup"))
    broken = event_messages(spark, sf_dir).join(kinds.select(F.col("id").alias("offset")), "offset", "left_semi")
    number = F.pmod("offset", F.lit(partitions)).cast("long")
    return good.unionByName(broken).withColumns(
        {"partition": number, "offset": F.floor(F.col("offset") / partitions).cast("long")}
    )


def write_topic(spark: SparkSession, sf_dir: str, path: str, partitions: int = 1) -> DataFrame:
    """The messages as files, every one delivered twice, and the stream that reads them. They are made once: the second
    delivery copies the first."""
    messages = fan_out_messages(spark, sf_dir, partitions)
    messages.write.parquet(path)
    spark.read.schema(messages.schema).parquet(path).write.mode("append").parquet(path)
    return spark.readStream.schema(messages.schema).parquet(path)


def silver_items(read: Callable[[layers.PayloadSpec], DataFrame]) -> DataFrame:
    """The three typed silver tables in one shape."""
    parts = []
    for name, spec in layers.PAYLOADS.items():
        item, owner, label = list(spec.fields)[:3]
        parts.append(
            read(spec).select(
                F.lit(name).alias("table_name"),
                F.col(item).alias("item_id"),
                F.col(owner).alias("owner_id"),
                F.col(label).alias("label"),
                "stream_id",
                "event_ts",
                "entity_id",
                "tablet_index",
                "row_index",
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def stream_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic files, delivered twice, through all three streaming queries; broken messages are set aside."""
    root = scratch_path(spark, "stream")
    topic = write_topic(spark, sf_dir, f"{root}/topic")
    streams.topic_to_raw(topic, f"{root}/raw", f"{root}/rejects", f"{root}/cp_raw").awaitTermination()
    queue = streams.read_queue(spark, f"{root}/raw")
    streams.raw_to_bronze(queue, f"{root}/bronze", f"{root}/cp_bronze").awaitTermination()
    bronze = streams.stream_bronze(spark, f"{root}/bronze")
    paths = {name: f"{root}/{name}" for name in layers.PAYLOADS}
    streams.bronze_to_silver(bronze, paths, f"{root}/cp_silver").awaitTermination()
    return silver_items(lambda spec: streams.read_silver(spark, paths[spec.name], spec))


@query
def bronze_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic of three partitions through one query and table per queue partition, then the periodic rebuild."""
    root = scratch_path(spark, "stream")
    topic = write_topic(spark, sf_dir, f"{root}/topic", partitions=3)
    streams.topic_to_raw(topic, f"{root}/raw", f"{root}/rejects", f"{root}/cp_raw").awaitTermination()
    running = streams.start_isolated(spark, f"{root}/raw", f"{root}/bronze", f"{root}/cp")
    for one in running.values():
        one.awaitTermination()
    tables = [streams.bronze_table(f"{root}/bronze", index) for index in running]
    rebuild_all(spark, tables, f"{root}/silver", f"{root}/runs")
    return silver_items(lambda spec: read_table(spark, f"{root}/silver/{spec.name}", spec.schema))


@query
def silver_from_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the messages, then all of them, through one query and table per queue partition; the silver tables
    follow the changes of each compaction."""
    root = scratch_path(spark, "stream")
    messages = write_once(fan_out_messages(spark, sf_dir, partitions=3), scratch_path(spark, "messages"))
    tables = [streams.bronze_table(f"{root}/bronze", index) for index in sorted(set(envelope.STREAM_PARTITIONS.values()))]
    for delivery in (messages.where(F.col("offset") % 2 == 0), messages):
        delivery.write.mode("append").parquet(f"{root}/topic")
        topic = spark.readStream.schema(messages.schema).parquet(f"{root}/topic")
        streams.topic_to_raw(topic, f"{root}/raw", f"{root}/rejects", f"{root}/cp_raw").awaitTermination()
        for one in streams.start_isolated(spark, f"{root}/raw", f"{root}/bronze", f"{root}/cp").values():
            one.awaitTermination()
        for table in tables:
            streams.compact(spark, table, range_bits=10)
        refresh_from_changes(spark, tables, f"{root}/silver", f"{root}/runs")
    return silver_items(lambda spec: read_table(spark, f"{root}/silver/{spec.name}", spec.schema))


@query
def stream_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run records of a periodic rebuild, with the rows that each table holds afterwards."""
    root = scratch_path(spark, "stream")
    topic = write_topic(spark, sf_dir, f"{root}/topic")
    streams.topic_to_raw(topic, f"{root}/raw", f"{root}/rejects", f"{root}/cp_raw").awaitTermination()
    streams.raw_to_bronze(streams.read_queue(spark, f"{root}/raw"), f"{root}/bronze", f"{root}/cp").awaitTermination()
    for _ in range(2):
        rebuild_all(spark, f"{root}/bronze", f"{root}/silver", f"{root}/runs")
    runs = read_table(spark, f"{root}/runs", schemas.STREAMING_SILVER_RUNS)
    held = silver_items(lambda spec: read_table(spark, f"{root}/silver/{spec.name}", spec.schema))
    rows = held.groupBy(F.col("table_name").alias("task_id")).agg(F.count("*").alias("n_rows"))
    counted = runs.groupBy("task_id", "status", "rc").agg(F.count("*").alias("n_runs"))
    return counted.join(rows, "task_id")


@query
def stream_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue rows delivered twice, the second time after a restart of the stream: as stored, without a collapse."""
    root, queue = scratch_path(spark, "stream"), queue_rows(spark, sf_dir)
    for delivery in (0, 1):
        streams.write_epoch(queue, f"{root}/raw", "q", delivery, ["tablet_index"])
        stream = streams.read_queue(spark, f"{root}/raw")
        streams.raw_to_bronze(stream, f"{root}/bronze", f"{root}/cp", once_within="2 hours").awaitTermination()
    stored = spark.read.schema(streams.STORED_BRONZE).parquet(f"{root}/bronze").select(*schemas.BRONZE_STREAM.names)
    return stored.withColumn("processed_at", F.lit("2024-02-01T00:05:00Z"))


@query
def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the batches of three queries, of which one fails: rows by query, beside the rows they wrote."""
    root = scratch_path(spark, "stream")
    topic = write_topic(spark, sf_dir, f"{root}/topic")

    def fail(batch: DataFrame, identity: str, epoch: int) -> None:
        raise RuntimeError("no batch passes")

    with records.recorded_batches(spark, f"{root}/batches"):
        streams.topic_to_raw(topic, f"{root}/raw", f"{root}/rejects", f"{root}/cp_raw", name="raw").awaitTermination()
        queue = streams.read_queue(spark, f"{root}/raw", max_files=2)
        streams.raw_to_bronze(queue, f"{root}/bronze", f"{root}/cp", name="bronze").awaitTermination()
        try:
            streams.run_stream(topic, fail, f"{root}/cp_bad", name="bad").awaitTermination()
        except StreamingQueryException:
            pass
    batches = read_table(spark, f"{root}/batches", schemas.STREAM_BATCHES)
    written = [spark.read.parquet(f"{root}/{place}").select(F.lit("raw").alias("query_name")) for place in ("raw", "rejects")]
    stored = written[0].unionByName(written[1]).groupBy("query_name").agg(F.count("*").alias("n_written"))
    found = batches.groupBy("query_name").agg(
        F.coalesce(F.sum("rows_in"), F.lit(0)).alias("rows_in"),
        F.count_if(F.col("status") == records.FAILED).alias("n_failed"),
        F.count_if(F.contains(F.col("message"), F.lit("no batch passes"))).alias("n_errors"),
    )
    return found.join(stored, "query_name", "left")


@query
def stream_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A micro-batch that fails behind its write is run again and replaces what it wrote: offsets move last."""
    root = scratch_path(spark, "stream")
    topic = write_topic(spark, sf_dir, f"{root}/topic")

    def write(batch: DataFrame, identity: str, epoch: int) -> None:
        streams.write_epoch(batch.select("topic", "partition", "offset"), f"{root}/out", identity, epoch)

    def write_and_fail(batch: DataFrame, identity: str, epoch: int) -> None:
        write(batch, identity, epoch)
        raise RuntimeError("lost behind the write")

    try:
        streams.run_stream(topic, write_and_fail, f"{root}/cp").awaitTermination()
    except StreamingQueryException:
        pass
    streams.run_stream(topic, write, f"{root}/cp").awaitTermination()
    rows = spark.read.parquet(f"{root}/out")
    return rows.groupBy("topic", "partition").agg(F.count("*").alias("n_rows"), F.sum("offset").alias("sum_offset"))


@query
def bronze_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows stored, compacted, and delivered once more by another query."""
    path = scratch_path(spark, "bronze")
    queue = queue_rows(spark, sf_dir)
    first = layers.topic_bronze_rows(queue, F.lit(NOW))
    again = layers.topic_bronze_rows(queue, F.lit("2024-02-01T00:05:00Z"))
    streams.write_epoch(first, path, "one", 0, ["tablet_index"])
    streams.compact(spark, path)
    streams.drop_merged(spark, path)
    streams.write_epoch(again, path, "two", 0, ["tablet_index"])
    return streams.read_bronze(spark, path)


@query
def bronze_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept in ranges of message numbers: delivered again partly before and partly after a compaction, and once
    more in the older version, which loses."""
    path = scratch_path(spark, "bronze")
    queue = write_once(queue_rows(spark, sf_dir), scratch_path(spark, "queue"))
    first = layers.topic_bronze_rows(queue, F.lit(NOW))
    again = layers.topic_bronze_rows(queue, F.lit("2024-02-01T00:05:00Z"))
    even = F.col("row_index") % 2 == 0
    for epoch, rows in enumerate((first, again.where(even))):
        streams.write_epoch(rows, path, "one", epoch, ["tablet_index"])
        streams.compact(spark, path, range_bits=10)
        streams.drop_merged(spark, path)
    streams.write_epoch(again.where(~even), path, "two", 0, ["tablet_index"])
    streams.write_epoch(first, path, "three", 0, ["tablet_index"])
    return streams.read_bronze(spark, path)


# Ledger, schema, audit --------------------------------------------------------------------------------------


@query
def ledger_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a file listing. Short pages are in the ledger; long ones are there in an older version."""
    listing = samples.sample_table(spark, sf_dir, "pages").select(
        F.concat_ws("#", F.col("url"), F.col("page_id").cast("string")).alias("path"),
        F.octet_length("html").cast("long").alias("size"),
        F.lit(0).alias("_modified"),
    )
    known = listing.withColumn("size", F.when(F.col("size") < 2000, F.col("size")).otherwise(F.col("size") - 1))
    tagged = listing.select("path", files.file_tag("path", "size", "_modified").alias("etag"), "size")
    ledger = known.select(files.file_tag("path", "size", "_modified").alias("etag"))
    return files.new_files(tagged, ledger)


@query
def ledger_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only what was loaded with success enters the ledger."""
    results = samples.sample_table(spark, sf_dir, "orders").select(
        F.concat(F.lit("orders/"), F.col("o_orderkey").cast("string")).alias("path"),
        F.sha2(F.col("o_orderkey").cast("string"), 256).alias("etag"),
        F.col("o_custkey").alias("size"),
        F.col("o_orderkey").alias("part_index"),
        F.lit("batch-1").alias("batch_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("load_status"),
    )
    return files.ledger_rows(results, NOW)


@query
def dense_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = samples.sample_table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    return dense_index(orders, ["o_orderdate", "o_orderkey"], "position").select("o_orderkey", "position")


@query
def schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = samples.sample_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return evolve(customers, schemas.table(string="c_mktsegment c_language", long="c_visits"), after="c_name")


@query
def schema_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three generations of one table, each written by the contract of its time, read by today's."""
    path, orders = scratch_path(spark, "contracts"), samples.sample_table(spark, sf_dir, "orders")
    orders = orders.withColumns({"customer": F.col("o_custkey").cast("int"), "status": F.col("o_orderstatus")})
    contracts.create(spark, path, schemas.table(long="o_orderkey", int="customer", string="o_orderstatus o_clerk_note"))
    contracts.append_rows(orders.where("o_orderkey % 3 = 0").withColumn("o_clerk_note", F.lit("old")), path)
    contracts.rename(spark, path, "o_orderstatus", "status")
    contracts.widen(spark, path, "customer", T.LongType())
    contracts.drop(spark, path, "o_clerk_note")
    contracts.append_rows(orders.where("o_orderkey % 3 = 1").withColumn("customer", F.col("o_custkey") + (1 << 40)), path)
    contracts.add(spark, path, "o_orderpriority", T.StringType())
    contracts.append_rows(orders.where("o_orderkey % 3 = 2"), path)
    return contracts.read_rows(spark, path)


@query
def schema_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = samples.sample_table(spark, sf_dir, "orders").withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
    return conform(orders, schemas.table(long="o_orderkey! o_custkey!", string="o_orderstatus", double="o_totalprice"))


def _order_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as load records: the customer is the batch, the priority the mart."""
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    started = F.col("o_orderdate").cast("timestamp")
    hours = F.col("o_orderkey") % 7 - 2
    return samples.sample_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_custkey").cast("string").alias("batch_id"),
        F.col("o_orderpriority").alias("mart"),
        F.when(F.col("o_orderstatus") == "F", F.lit(0)).otherwise(F.lit(1)).cast("long").alias("rc"),
        F.date_format(started, iso).alias("started_at"),
        F.when(
            F.col("o_orderstatus") != "P",
            F.date_format(F.timestamp_seconds(F.unix_timestamp(started) + hours * 3600), iso),
        ).alias("finished_at"),
    ).withColumn("load_status", audit.status_of("rc"))


@query
def run_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_runs(spark, sf_dir).select(
        "run_id", "load_status", audit.duration_seconds("started_at", "finished_at").alias("duration_sec")
    )


@query
def run_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.run_rollup(_order_runs(spark, sf_dir))


@query
def last_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _order_runs(spark, sf_dir).withColumn("finished_at", F.concat("finished_at", F.lpad("run_id", 12, "0")))
    return audit.last_success(runs).select("mart", "batch_id", "run_id", "finished_at")


@query
def file_load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per loaded file with its rows."""
    counts = audit.file_row_counts(facts.build_fact(raw_with_copies(spark, sf_dir)))
    items = counts.select(
        F.col("_source_file").alias("file_key"),
        F.col("_part_index").alias("part_index"),
        F.col("n_rows").alias("rows_inserted"),
        F.col("n_rows").alias("fact_rows"),
        F.lit(samples.BATCH_ID).alias("batch_id"),
        F.lit("2024-02-01T00:00:00Z").alias("started_at"),
        F.lit("2024-02-01T00:01:30Z").alias("finished_at"),
        F.lit(audit.SUCCESS).alias("load_status"),
    )
    return audit.file_loads(items, NOW).select(
        "event_at", "batch_id", "file_key", "part_index", "rows_inserted", "fact_rows", "duration_sec", "load_status"
    )


@query
def latest_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last turn of every conversation, whole text."""
    return latest_by(samples.sample_table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"])


@query
def country_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = samples.telemetry(spark, sf_dir)
    return raw.select("id", normalize_code("country_code").alias("country_code")).groupBy("country_code").agg(
        F.count("*").alias("n_events")
    )


# Contract ---------------------------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """The daily country mart over the small sample."""
    return _queries["daily_country_stats"](spark, SMOKE_DIR)


def _corpus_modules() -> tuple[list[dict[str, Query]], list[dict[str, str]]]:
    """The queries and the SQL for text corpora, where those folders and what they need are installed. What is
    missing is said as a warning; the other queries work without."""
    missing: list[str] = []
    found: list[dict[str, Query]] = []
    sql: list[dict[str, str]] = []
    try:
        from medallion.llm import queries as corpus
    except ImportError as error:
        missing.append(str(error))
    else:
        found.append(corpus.queries())
        sql.append(corpus.oracle_sql())
    try:
        import corpus_pipeline
    except ImportError as error:
        missing.append(str(error))
    else:
        found.append({"pipeline": lambda spark, sf_dir: corpus_pipeline.run(configure(spark), sf_dir)})
        if corpus_pipeline.ORACLE_SQL:
            sql.append({"pipeline": corpus_pipeline.ORACLE_SQL})
    for what in missing:
        warnings.warn(f"no corpus queries: {what}", stacklevel=3)
    return found, sql


def queries() -> dict[str, Query]:
    return dict(_queries) | {name: function for part in _corpus_modules()[0] for name, function in part.items()}


def oracle_sql() -> dict[str, str]:
    return oracle_queries.all_queries() | {name: sql for part in _corpus_modules()[1] for name, sql in part.items()}
