from medallion.functions.derive import (
    calendar_parts,
    domain_flags,
    event_date_of,
    event_second,
    event_time,
    flag_count,
    guarded_ratio,
    is_one,
    parse_event_ts,
    tri_bool,
)
from medallion.functions.keys import NULL_SENTINEL, normalize_code, normalize_key, random_uuid, stable_uuid

__all__ = [
    "NULL_SENTINEL",
    "calendar_parts",
    "domain_flags",
    "event_date_of",
    "event_second",
    "event_time",
    "flag_count",
    "guarded_ratio",
    "is_one",
    "normalize_code",
    "normalize_key",
    "parse_event_ts",
    "random_uuid",
    "stable_uuid",
    "tri_bool",
]
