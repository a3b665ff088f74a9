"""The telemetry fact table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.functions import event_time, is_one, normalize_key, stable_uuid, tri_bool
from medallion.operators.conform import conform, require_columns
from medallion.operators.dims import (
    CATEGORY_DIMS,
    DimSpec,
    category_mapping,
    device_key,
    device_mapping,
    device_stable_uid,
)
from medallion.operators.joins import (
    MAX_BROADCAST_BYTES,
    broadcastable,
    measured_bytes,
    measured_bytes_by,
    salted_join,
)
from medallion.schemas import FACT, FLAG_COLUMNS
from medallion.session import scratch_path
from medallion.sources.buckets import Layout, joined, lay_out
from medallion.sources.tables import write_once

FACT_NAMESPACE = "fact_telemetry"
LINEAGE = ("_source_file", "_file_hash", "_loaded_at", "_batch_id", "_part_index")


@dataclass(frozen=True)
class Lookups:
    """Natural value -> uid frames, one per dimension, with their measured sizes. A size chooses the join, never
    the id. Give no ``devices`` only where the device table holds every device with its computed id: the ids are then
    computed in place."""

    categories: Mapping[str, DataFrame]
    sizes: Mapping[str, int]
    devices: DataFrame | None = None


def load_lookups(
    dims: DataFrame, devices: DataFrame | None = None, specs: Sequence[DimSpec] = CATEGORY_DIMS
) -> Lookups:
    """Mappings from dimension tables, measured so that each join can be chosen.

    The collapsed mapping is written down once, so that the eleven broadcasts are plain scans of it.
    """
    mapping = write_once(category_mapping(dims), scratch_path(dims.sparkSession, "mapping"), ["dim_name"])
    categories = {
        spec.name: mapping.where(F.col("dim_name") == spec.name).select(
            F.col("raw_value").alias(f"_{spec.name}"), F.col("uid").alias(spec.uid)
        )
        for spec in specs
    }
    sizes = {**dict.fromkeys(categories, 0), **measured_bytes_by(mapping, "dim_name")}
    if devices is None:
        return Lookups(categories, sizes)
    device_map = device_mapping(devices)
    return Lookups(categories, {**sizes, "device": measured_bytes(device_map)}, device_map)


def fact_source(raw: DataFrame) -> DataFrame:
    """Raw telemetry with event time, fact id and typed flags; needs the lineage columns."""
    require_columns(raw, LINEAGE, "raw telemetry")
    flags = {name: tri_bool(name) for name in FLAG_COLUMNS}
    return event_time(raw).withColumns(
        {
            "source_id": F.col("id").try_cast("long"),
            "fact_uid": stable_uuid(FACT_NAMESPACE, "id", "device_id", "event_ts_str"),
            "screen_on": is_one("screen_on"),
            **flags,
        }
    )


def fact_keys(specs: Sequence[DimSpec] = CATEGORY_DIMS) -> list[str]:
    return ["device_uid", *[spec.uid for spec in specs]]


def with_stable_keys(source: DataFrame, specs: Sequence[DimSpec] = CATEGORY_DIMS) -> DataFrame:
    """Surrogate keys computed in place: no lookup, no join, no shuffle."""
    return source.withColumns({"device_uid": device_stable_uid(), **{spec.uid: spec.stable_uid() for spec in specs}})


def with_looked_up_keys(
    source: DataFrame,
    lookups: Lookups,
    specs: Sequence[DimSpec] = CATEGORY_DIMS,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Surrogate keys read from the dimension tables; see ``Lookups`` for the device. Device ids that the source has
    already (``with_bucketed_devices``) stay."""
    small = broadcastable(lookups.sizes, max_broadcast_bytes)
    keyed = source.withColumns({f"_{spec.name}": normalize_key(spec.source) for spec in specs})
    if lookups.devices is not None:
        keyed = keyed.withColumn("device_id", device_key())
    elif "device_uid" not in source.columns:
        keyed = keyed.withColumn("device_uid", device_stable_uid())
    # Hot keys are looked for in the source, not in what the joins before have made.
    natural = keyed.select("device_id", *[f"_{spec.name}" for spec in specs])
    if lookups.devices is not None:
        keyed = _looked_up(keyed, lookups.devices, "device_id", "device" in small, natural)
    for spec in specs:
        keyed = _looked_up(keyed, lookups.categories[spec.name], f"_{spec.name}", spec.name in small, natural)
    return keyed.drop(*[f"_{spec.name}" for spec in specs])


def with_bucketed_devices(source: DataFrame, devices: DataFrame, layout: Layout) -> DataFrame:
    """The source with device ids from a table of any size, for loads that are looked up more than once: both are laid
    out by device, after which a lookup shuffles neither."""
    keyed = source.withColumn("device_id", device_key())
    lay_out(keyed, device_mapping(devices), layout)
    return joined(source.sparkSession, layout)


def _looked_up(df: DataFrame, mapping: DataFrame, on: str, small: bool, keys_from: DataFrame) -> DataFrame:
    return df.join(F.broadcast(mapping), on, "left") if small else salted_join(df, mapping, on, "left", keys_from=keys_from)


def build_fact(raw: DataFrame, lookups: Lookups | None = None) -> DataFrame:
    """The fact rows of a raw batch, with keys looked up, or all computed when no lookups are given.

    A row whose device or category has no key fails the write; there is no separate check pass.
    """
    source = fact_source(raw)
    keyed = with_stable_keys(source) if lookups is None else with_looked_up_keys(source, lookups)
    return conform(require_all_keys(keyed), FACT, what="fact_telemetry")


def require_all_keys(keyed: DataFrame) -> DataFrame:
    """Every surrogate key is required after the lookup, also those the table contract lets be NULL."""
    checks = {name: F.expr(f"coalesce({name}, raise_error('fact lookup gave a NULL {name}'))") for name in fact_keys()}
    return keyed.withColumns(checks)


def lacks_keys() -> F.Column:
    """Raw rows that can't become facts: no device, no id, or no event time."""
    return device_key().isNull() | F.col("id").try_cast("long").isNull() | F.col("timestamp").isNull()


def split_unkeyed(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that can become facts, rows that can't) for callers that would rather set bad rows aside than fail."""
    return raw.where(~lacks_keys()), raw.where(lacks_keys())
