from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from medallion.functions import (
    calendar_parts,
    domain_flags,
    event_time,
    flag_count,
    guarded_ratio,
    is_one,
    normalize_key,
    parse_event_ts,
    stable_uuid,
    tri_bool,
)


def test_normalize_key_keeps_blanks_and_case(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), (" WIFI ",), ("wifi",)], "v string")
    got = [row[0] for row in df.select(normalize_key("v")).collect()]
    assert got == ["__null__", "", "", "WIFI", "wifi"]


def expected_uuid(*parts: str) -> str:
    digest = hashlib.sha256("|".join(parts).encode()).hexdigest()
    return f"{digest[:8]}-{digest[8:12]}-5{digest[13:16]}-8{digest[16:19]}-{digest[19:31]}"


def test_stable_uuid_matches_plain_python(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (" a ", None)], "s string, n long")
    got = [row[0] for row in df.select(stable_uuid("ns", "s", "n")).collect()]
    assert got == [
        expected_uuid("ns", "a", "1"),
        expected_uuid("ns", "__null__", "2"),
        expected_uuid("ns", " a ", "__null__"),
    ]
    strict = [row[0] for row in df.select(stable_uuid("ns", "n", null_gives_null=True)).collect()]
    assert strict == [expected_uuid("ns", "1"), expected_uuid("ns", "2"), None]


def test_flags_are_three_valued(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (-1.0,), (None,)], "v double")
    assert [row[0] for row in df.select(tri_bool("v")).collect()] == [False, True, True, None]
    assert [row[0] for row in df.select(is_one("v")).collect()] == [False, True, False, None]
    counted = df.select(tri_bool("v").alias("f")).agg(flag_count("f")).first()[0]
    assert counted == 2
    assert df.where("v > 5").select(tri_bool("v").alias("f")).agg(flag_count("f")).first()[0] == 0


def test_event_time_cuts_to_seconds_and_survives_bad_text(spark):
    df = spark.createDataFrame([("2024-01-07 05:59:59.9",), ("nonsense",), (None,)], "timestamp string")
    got = event_time(df).select("event_ts_str", "event_date").collect()
    assert [tuple(row) for row in got] == [("2024-01-07 05:59:59", "2024-01-07"), (None, None), (None, None)]


def test_calendar_and_domain_flags_at_their_edges(spark):
    rows = [
        ("2024-01-07 00:00:00", "Charging", "WIFI", 19.999),  # a Sunday
        ("2024-01-06 05:59:59", "Full", "wifi", 20.0),  # a Saturday
        ("2024-01-06 06:00:00", "__null__", "__null__", None),
        ("bad", None, None, 5.0),
    ]
    df = spark.createDataFrame(
        rows, "event_ts_str string, battery_state string, network_type string, battery_level double"
    )
    moment = parse_event_ts()
    got = df.withColumns({**calendar_parts(moment), **domain_flags(moment)}).select(
        "hour_of_day", "day_of_week", "is_night", "is_charging", "is_wifi", "battery_low"
    )
    assert [tuple(row) for row in got.collect()] == [
        (0, 1, True, True, True, True),
        (5, 7, True, True, False, False),
        (6, 7, False, False, False, None),
        (None, None, None, None, None, True),
    ]


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, -1.0), (None, 2.0), (1.0, None)], "a double, b double")
    got = [row[0] for row in df.select(guarded_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [0.5, None, None, None, None]


def test_parse_event_ts_is_utc(spark):
    df = spark.createDataFrame([("2024-03-31 02:30:00",)], "event_ts_str string")
    micros = df.select(F.unix_micros(parse_event_ts())).first()[0]
    assert micros == int(dt.datetime(2024, 3, 31, 2, 30, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
