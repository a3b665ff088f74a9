"""Gold marts, declared as data and compiled to one aggregation each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions import event_date_of, flag_count, guarded_ratio, parse_event_ts
from medallion.functions.derive import SECOND_FORMAT
from medallion.operators.conform import conform, require_columns
from medallion.schemas import COUNTRY_OVERVIEW, DAILY_COUNTRY_STATS, DEVICE_LIFECYCLE, GOLD_STAMP, HOURLY_BATTERY_HEALTH

DAY_SECONDS = 86400.0


@dataclass(frozen=True)
class MartSpec:
    """An aggregate table. Each mapping goes from output column to input column.

    ``first_days``/``last_days`` and ``first_seconds``/``last_seconds`` are minima and maxima of fixed-width
    date and time text. They are aggregated as dates and timestamps: text buffers rule out hash aggregation.
    ``ratios`` are computed from two output columns after the aggregation.
    """

    name: str
    grain: tuple[str, ...]
    schema: T.StructType
    count: str = "n_events"
    distinct: Mapping[str, str] = field(default_factory=dict)
    averages: Mapping[str, str] = field(default_factory=dict)
    minima: Mapping[str, str] = field(default_factory=dict)
    maxima: Mapping[str, str] = field(default_factory=dict)
    flags: Mapping[str, str] = field(default_factory=dict)
    first_days: Mapping[str, str] = field(default_factory=dict)
    last_days: Mapping[str, str] = field(default_factory=dict)
    first_seconds: Mapping[str, str] = field(default_factory=dict)
    last_seconds: Mapping[str, str] = field(default_factory=dict)
    spans_in_days: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    ratios: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    defaults: Mapping[str, str] = field(default_factory=dict)

    def inputs(self) -> list[str]:
        maps = (self.distinct, self.averages, self.minima, self.maxima, self.flags, self.first_days, self.last_days)
        names = [*self.grain, *[name for part in maps for name in part.values()]]
        names += [*self.first_seconds.values(), *self.last_seconds.values()]
        return list(dict.fromkeys(names))


def _extremes(spec: MartSpec) -> dict[str, tuple[Column, bool]]:
    """Output column -> (input expression, whether the minimum is wanted)."""
    wanted = {name: (F.col(source), True) for name, source in spec.minima.items()}
    wanted |= {name: (F.col(source), False) for name, source in spec.maxima.items()}
    wanted |= {name: (event_date_of(source), True) for name, source in spec.first_days.items()}
    wanted |= {name: (event_date_of(source), False) for name, source in spec.last_days.items()}
    wanted |= {name: (parse_event_ts(source), True) for name, source in spec.first_seconds.items()}
    wanted |= {name: (parse_event_ts(source), False) for name, source in spec.last_seconds.items()}
    return wanted


def _single_pass(df: DataFrame, spec: MartSpec, relative_error: float | None = None) -> DataFrame:
    """One aggregation. With one distinct column Spark first groups by (grain, column), so a hot group is split.
    Approximate distinct counts need no such grouping: each is a sketch that is merged like a sum."""
    outputs = [F.count("*").alias(spec.count)]
    outputs += [
        (
            F.count_distinct(F.col(source))
            if relative_error is None
            else F.approx_count_distinct(source, relative_error)
        ).alias(name)
        for name, source in spec.distinct.items()
    ]
    outputs += [F.avg(source).alias(name) for name, source in spec.averages.items()]
    outputs += [flag_count(source).alias(name) for name, source in spec.flags.items()]
    outputs += [
        (F.min(value) if smallest else F.max(value)).alias(name)
        for name, (value, smallest) in _extremes(spec).items()
    ]
    return df.groupBy(*spec.grain).agg(*outputs)


def partial_rows(df: DataFrame, spec: MartSpec, by: Sequence[str] = ()) -> DataFrame:
    """Sums, counts and extremes per grain, distinct columns and the columns in ``by``: what ``rolled_up`` merges. Rows
    of different parts of the input can be merged together."""
    df = _with_defaults(df, spec)
    keys = list(dict.fromkeys([*by, *spec.grain, *spec.distinct.values()]))
    partial = [F.count("*").alias("_n")]
    for name, source in spec.averages.items():
        partial += [F.sum(source).alias(f"_sum_{name}"), F.count(source).alias(f"_count_{name}")]
    partial += [flag_count(source).alias(name) for name, source in spec.flags.items()]
    partial += [
        (F.min(value) if smallest else F.max(value)).alias(name) for name, (value, smallest) in _extremes(spec).items()
    ]
    return df.groupBy(*keys).agg(*partial)


def rolled_up(fine: DataFrame, spec: MartSpec) -> DataFrame:
    """One row per grain from rows of ``partial_rows``.

    Several distinct counts make Spark copy every input row once per count. Here only the far fewer rows of
    the first level are copied, and its fine grain spreads a hot group over many tasks.
    """
    extremes = _extremes(spec)
    outputs = [F.sum("_n").alias(spec.count)]
    outputs += [F.count_distinct(F.col(source)).alias(name) for name, source in spec.distinct.items()]
    outputs += [
        guarded_ratio(F.sum(f"_sum_{name}"), F.sum(f"_count_{name}")).alias(name) for name in spec.averages
    ]
    outputs += [F.sum(name).alias(name) for name in spec.flags]
    outputs += [(F.min(name) if smallest else F.max(name)).alias(name) for name, (_, smallest) in extremes.items()]
    return fine.groupBy(*spec.grain).agg(*outputs)


def _with_defaults(df: DataFrame, spec: MartSpec) -> DataFrame:
    for name, source in spec.defaults.items():
        if name not in df.columns:
            df = df.withColumn(name, F.col(source))
    require_columns(df, spec.inputs(), f"input of {spec.name}")
    return df


def aggregate(df: DataFrame, spec: MartSpec, relative_error: float | None = None) -> DataFrame:
    """The mart's rows, without the gold stamp. Distinct counts are exact unless a relative error is allowed."""
    df = _with_defaults(df, spec)
    exact_and_several = relative_error is None and len(spec.distinct) > 1
    return _derived(rolled_up(partial_rows(df, spec), spec) if exact_and_several else _single_pass(df, spec, relative_error), spec)


def _derived(rows: DataFrame, spec: MartSpec) -> DataFrame:
    spans = {
        name: (F.unix_timestamp(last) - F.unix_timestamp(first)) / F.lit(DAY_SECONDS)
        for name, (first, last) in spec.spans_in_days.items()
    }
    ratios = {name: guarded_ratio(F.col(top), F.col(bottom)) for name, (top, bottom) in spec.ratios.items()}
    derived = {**spans, **ratios}
    rows = rows.withColumns(derived) if derived else rows
    texts = {name: F.date_format(name, SECOND_FORMAT) for name in [*spec.first_seconds, *spec.last_seconds]}
    return rows.withColumns(texts) if texts else rows


def build_mart(
    df: DataFrame, spec: MartSpec, batch_id: str, built_at: str, relative_error: float | None = None
) -> DataFrame:
    """The mart in its table contract, stamped with batch and build time."""
    return _stamped(aggregate(df, spec, relative_error), spec, batch_id, built_at)


def mart_from_states(states: DataFrame, spec: MartSpec, batch_id: str, built_at: str) -> DataFrame:
    """The mart from stored rows of ``partial_rows``, with exact distinct counts."""
    return _stamped(_derived(rolled_up(states, spec), spec), spec, batch_id, built_at)


def _stamped(rows: DataFrame, spec: MartSpec, batch_id: str, built_at: str) -> DataFrame:
    marks = {"_gold_batch_id": F.lit(batch_id), "_gold_built_at": F.lit(built_at)}
    return conform(rows.withColumns(marks), spec.schema, what=spec.name)


_RATES = {
    "charging_rate": ("n_charging_events", "n_events"),
    "low_battery_rate": ("n_low_battery_events", "n_events"),
    "wifi_rate": ("n_wifi_events", "n_events"),
}
_USAGE = {"avg_memory_used_pct": "memory_used_pct", "avg_storage_used_pct": "storage_used_pct"}
_CLIMATE = {"avg_battery_level": "battery_level", "avg_temperature": "temperature"}
_CHARGE_FLAGS = {"n_charging_events": "is_charging", "n_low_battery_events": "battery_low"}

MARTS = {
    spec.name: spec
    for spec in (
        MartSpec(
            name="daily_country_stats",
            grain=("date_local", "country_code", "country_name"),
            schema=DAILY_COUNTRY_STATS,
            distinct={"n_devices": "device_id"},
            averages={**_CLIMATE, "avg_voltage": "voltage", **_USAGE},
            flags={**_CHARGE_FLAGS, "n_wifi_events": "is_wifi", "n_night_events": "is_night"},
            ratios=_RATES,
            defaults={"country_name": "country_code"},
        ),
        MartSpec(
            name="country_overview",
            grain=("country_code",),
            schema=COUNTRY_OVERVIEW,
            distinct={"n_devices": "device_id", "n_active_days": "date_local"},
            averages={**_CLIMATE, **_USAGE},
            flags={**_CHARGE_FLAGS, "n_wifi_events": "is_wifi"},
            first_days={"first_date": "date_local"},
            last_days={"last_date": "date_local"},
            ratios={**_RATES, "events_per_device": ("n_events", "n_devices")},
        ),
        MartSpec(
            name="device_lifecycle",
            grain=("device_id", "country_code"),
            schema=DEVICE_LIFECYCLE,
            distinct={"n_active_days": "date_local"},
            averages={**_CLIMATE, **_USAGE},
            minima={"min_battery_level": "battery_level"},
            flags={**_CHARGE_FLAGS, "n_wifi_events": "is_wifi"},
            first_seconds={"first_seen": "event_ts_str"},
            last_seconds={"last_seen": "event_ts_str"},
            spans_in_days={"lifetime_days": ("first_seen", "last_seen")},
            ratios={"events_per_active_day": ("n_events", "n_active_days")},
        ),
        MartSpec(
            name="hourly_battery_health",
            grain=("date_local", "hour_of_day", "country_code"),
            schema=HOURLY_BATTERY_HEALTH,
            distinct={"n_devices": "device_id"},
            averages={**_CLIMATE, "avg_voltage": "voltage"},
            maxima={"max_temperature": "temperature"},
            flags={**_CHARGE_FLAGS, "n_night_events": "is_night"},
        ),
    )
}


def mart_spec(name: str) -> MartSpec:
    if name not in MARTS:
        raise ValueError(f"unknown mart {name}; known: {sorted(MARTS)}")
    return MARTS[name]


def stamped(*parts: T.StructType) -> T.StructType:
    """A mart schema with the gold stamp appended, for marts of one's own."""
    return T.StructType([f for part in (*parts, GOLD_STAMP) for f in part.fields])
