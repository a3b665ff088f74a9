"""Derived columns. Everything is a built-in expression, so it stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
SECOND_LENGTH = 19
DAY_FORMAT = "yyyy-MM-dd"

# Fixed values of the telemetry domain.
CHARGING_STATES = ("Charging", "Full")
WIFI_NETWORK = "WIFI"
NIGHT_HOURS = (0, 5)
LOW_BATTERY = 20.0


def event_second(column: str = "timestamp") -> Column:
    """Event time cut to the second; NULL when the value is no timestamp."""
    return F.date_trunc("second", F.col(column).try_cast("timestamp"))


def event_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Add ``event_ts_str`` and ``event_date`` as fixed-width text."""
    moment = F.col(column).try_cast("timestamp")
    return df.withColumns(
        {
            "event_ts_str": F.date_format(moment, SECOND_FORMAT),
            "event_date": F.date_format(moment, DAY_FORMAT),
        }
    )


def parse_event_ts(column: str = "event_ts_str") -> Column:
    """Timestamp of fixed-width text. The cast is several times faster than parsing by pattern."""
    return F.when(F.length(column) == SECOND_LENGTH, F.col(column).try_cast("timestamp"))


def event_date_of(column: str) -> Column:
    return F.col(column).try_cast("date")


def tri_bool(column: str) -> Column:
    """NULL stays NULL, zero is false, anything else (NaN included) is true."""
    return F.col(column) != F.lit(0.0)


def is_one(column: str) -> Column:
    return F.col(column) == F.lit(1)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator where the denominator is positive, else NULL."""
    return F.when(denominator > 0, numerator / denominator)


def flag_count(flag: str | Column) -> Column:
    """How often a three-valued flag is true; 0, never NULL, when it never is."""
    return F.count_if(F.col(flag) if isinstance(flag, str) else flag)


def calendar_parts(event_ts: Column) -> dict[str, Column]:
    """Hour 0-23 and day of week 1 (Sunday) to 7."""
    return {
        "hour_of_day": F.hour(event_ts).cast("long"),
        "day_of_week": F.dayofweek(event_ts).cast("long"),
    }


def domain_flags(event_ts: Column) -> dict[str, Column]:
    return {
        "is_night": F.hour(event_ts).between(*NIGHT_HOURS),
        "is_charging": F.col("battery_state").isin(*CHARGING_STATES),
        "is_wifi": F.col("network_type") == F.lit(WIFI_NETWORK),
        "battery_low": F.col("battery_level") < F.lit(LOW_BATTERY),
    }
