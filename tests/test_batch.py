from __future__ import annotations

import dataclasses
import datetime as dt
import itertools

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from medallion import schemas
from medallion.operators import dims, enrich, facts, increment
from medallion.operators.conform import conform, evolve, null_counts
from medallion.operators.marts import MARTS, _single_pass, aggregate, build_mart, mart_spec, partial_rows, rolled_up
from medallion.sources import files

BASE = dt.datetime(2024, 1, 1)
REFERENCE = [("DE", "Germany", "DEU", "Europe"), (" fr ", "France", "FRA", "Europe")]


def raw_rows(spark, rows):
    """Telemetry with the given (id, device_id, country, minutes after the base time, battery level)."""
    values = []
    for identity, device, country, minutes, level in rows:
        values.append((identity, device, BASE + dt.timedelta(minutes=minutes), country, level))
    df = spark.createDataFrame(
        values, "id long, device_id long, timestamp timestamp, country_code string, battery_level double"
    )
    raw = conform(evolve(df, schemas.RAW_TELEMETRY), schemas.RAW_TELEMETRY, enforce_required=False)
    others = [spec.source for spec in dims.CATEGORY_DIMS if spec.name != "country"]
    return raw.withColumns({name: F.concat(F.lit(f" {name}_"), (F.col("id") % 2).cast("string")) for name in others})


def stamped(df, part=0, hash_="h0", loaded="2024-02-01 00:00:00", batch="b1"):
    lineage = {"_source_file": F.lit(hash_), "_file_hash": F.lit(hash_)}
    return files.stamp_batch(df.withColumns(lineage), batch, loaded, part)


@pytest.fixture(scope="module")
def reference(spark):
    df = spark.createDataFrame(REFERENCE, "country_code string, country_name string, alpha3_code string, region string")
    return evolve(df, schemas.COUNTRY_REFERENCE)


ROWS = [(1, 10, "de", 0, 50.0), (2, 10, " DE", 1, 10.0), (3, 11, None, 2, 20.0), (4, 12, "xx", 3000, None)]


def test_dimension_rows_are_appended_once(spark):
    raw = raw_rows(spark, ROWS)
    first = dims.new_category_rows(dims.category_values(raw), None, "t1")
    assert first.count() == first.select("dim_name", "raw_value").distinct().count()
    assert dims.new_category_rows(dims.category_values(raw), first, "t2").count() == 0
    more = raw.unionByName(raw_rows(spark, [(5, 13, "it", 0, 1.0)]))
    added = dims.new_category_rows(dims.category_values(more), first, "t2").collect()
    assert [(row["dim_name"], row["raw_value"]) for row in added] == [("country", "it")]
    seen = {row["raw_value"]: row["first_seen"] for row in first.where("dim_name = 'country'").collect()}
    assert seen == {
        "de": "2024-01-01 00:00:00",
        "DE": "2024-01-01 00:01:00",
        "__null__": "2024-01-01 00:02:00",
        "xx": "2024-01-03 02:00:00",
    }


def test_device_dimension_skips_missing_devices(spark):
    raw = raw_rows(spark, [*ROWS, (9, None, "de", 5, 1.0)])
    rows = dims.new_device_rows(dims.device_values(raw), None, "t1")
    assert {row["device_id"] for row in rows.collect()} == {10, 11, 12}
    assert dims.new_device_rows(dims.device_values(raw), rows, "t2").count() == 0


def test_dimension_values_aggregate_by_hash(spark):
    plan = plan_of(dims.category_values(raw_rows(spark, ROWS)))
    assert "HashAggregate" in plan and "SortAggregate" not in plan and plan.count("Exchange") == 1


def test_looked_up_and_computed_keys_agree(spark):
    raw = stamped(raw_rows(spark, ROWS))
    categories = dims.new_category_rows(dims.category_values(raw), None, "t1")
    devices = dims.new_device_rows(dims.device_values(raw), None, "t1")
    computed = facts.build_fact(raw).collect()
    for lookups in (facts.load_lookups(categories), facts.load_lookups(categories, devices)):
        assert sorted(facts.build_fact(raw, lookups).collect()) == sorted(computed)


def test_missing_keys_fail_the_load(spark):
    bad = stamped(raw_rows(spark, [*ROWS, (9, None, "de", 5, 1.0)]))
    with pytest.raises(Exception, match="NULL device_uid"):
        facts.build_fact(bad).collect()
    good, aside = facts.split_unkeyed(bad)
    assert facts.build_fact(good).count() == 4 and aside.count() == 1

    raw = stamped(raw_rows(spark, ROWS))
    partial = dims.new_category_rows(dims.category_values(raw), None, "t1").where("raw_value <> 'xx'")
    with pytest.raises(Exception, match="NULL country_uid"):
        facts.build_fact(raw, facts.load_lookups(partial)).collect()
    keyed = facts.with_looked_up_keys(facts.fact_source(raw), facts.load_lookups(partial))
    assert {r[0]: r[1] for r in null_counts(keyed, ["country_uid", "device_uid"]).collect()} == {
        "country_uid": 1,
        "device_uid": 0,
    }


def test_lookups_join_without_shuffling_the_facts(spark):
    raw = stamped(raw_rows(spark, ROWS))
    categories = dims.new_category_rows(dims.category_values(raw), None, "t1")
    plan = plan_of(facts.build_fact(raw, facts.load_lookups(categories)))
    assert plan.count("BroadcastHashJoin") == len(dims.CATEGORY_DIMS)
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_dimensions_too_big_to_broadcast_give_the_same_rows(spark):
    raw = stamped(raw_rows(spark, ROWS * 3))
    categories = dims.new_category_rows(dims.category_values(raw), None, "t1")
    devices = dims.new_device_rows(dims.device_values(raw), None, "t1")
    fact = facts.build_fact(raw)
    huge = {"country": 1 << 40, "device": 1 << 40}

    decoders = enrich.load_decoders(categories, devices)
    salted = dataclasses.replace(decoders, sizes={**decoders.sizes, **huge})
    wide = enrich.decode(fact, salted, keys_from=fact)
    assert plan_of(wide).count("SortMergeJoin") >= 2
    names = enrich.decode(fact, decoders).columns
    assert sorted(wide.select(*names).collect()) == sorted(enrich.decode(fact, decoders).collect())

    lookups = facts.load_lookups(categories)
    salted = dataclasses.replace(lookups, sizes={**lookups.sizes, "country": 1 << 40})
    plan = plan_of(facts.build_fact(raw, salted))
    assert "SortMergeJoin" in plan
    assert sorted(facts.build_fact(raw, salted).collect()) == sorted(fact.collect())


def silver_of(spark, raw, reference):
    return enrich.silver_from_raw(raw, reference, "s1", "2024-02-02 00:00:00")


def test_star_and_direct_silver_agree(spark, reference):
    raw = stamped(raw_rows(spark, ROWS))
    categories = dims.new_category_rows(dims.category_values(raw), None, "t1", random_ids=False)
    devices = dims.new_device_rows(dims.device_values(raw), None, "t1")
    decoders = enrich.load_decoders(categories, devices)
    star = enrich.build_silver(facts.build_fact(raw), decoders, reference, "s1", "2024-02-02 00:00:00")
    direct = silver_of(spark, raw, reference)
    assert star.columns == schemas.SILVER.names
    assert sorted(star.collect(), key=str) == sorted(direct.collect(), key=str)
    names = {row["source_id"]: (row["country_code"], row["country_name"]) for row in direct.collect()}
    assert names == {1: ("DE", "Germany"), 2: ("DE", "Germany"), 3: ("__NULL__", "__NULL__"), 4: ("XX", "XX")}
    restored = {r["source_id"]: r["country_code"] for r in enrich.restore_nulls(direct).collect()}
    assert restored[3] is None and restored[4] == "XX"


def two_loads(spark):
    """File h0, then file h1 which repeats one event of h0 and holds another event twice."""
    first = stamped(raw_rows(spark, ROWS))
    repeat = raw_rows(spark, [(1, 10, "de", 0, 99.0), (5, 13, "fr", 10, 30.0), (5, 13, "fr", 10, 31.0)])
    return first, stamped(repeat, 1, "h1", "2024-02-01 09:00:00", "b2")


@pytest.mark.parametrize("mode", ["catchup", "increment", "auto"])
def test_every_mode_adds_each_key_once(spark, reference, mode):
    first, second = two_loads(spark)
    silver = silver_of(spark, first, reference)
    bronze = facts.build_fact(first.unionByName(second))
    fresh = increment.new_facts(bronze, silver, mode).collect()
    assert [row["source_id"] for row in fresh] == [5]
    assert increment.new_facts(bronze, None, mode).count() == 5


def test_modes(spark, reference):
    first, second = two_loads(spark)
    bronze, silver = facts.build_fact(first), silver_of(spark, first, reference)
    assert increment.select_bronze(bronze, None)[0] == "catchup"
    assert increment.select_bronze(bronze, silver)[0] == "increment"
    both = facts.build_fact(first.unionByName(second))
    mode, selected = increment.select_bronze(both, silver)
    assert mode == "catchup" and {r["_file_hash"] for r in selected.collect()} == {"h1"}
    with pytest.raises(ValueError):
        increment.select_bronze(bronze, silver, "sometimes")


def test_watermark_reaches_the_scan(spark, reference, tmp_path):
    first, second = two_loads(spark)
    facts.build_fact(first.unionByName(second)).write.parquet(str(tmp_path / "fact"))
    bronze = spark.read.parquet(str(tmp_path / "fact"))
    silver = silver_of(spark, second, reference)
    newest = increment.newest_load(silver, "_bronze_loaded_at")
    selected = increment.overlap_selection(bronze, newest, overlap_hours=2)
    assert {row["_file_hash"] for row in selected.collect()} == {"h1"}
    assert "GreaterThanOrEqual(_loaded_at,2024-02-01 07:00:00)" in plan_of(selected)
    assert increment.overlap_selection(bronze, newest, overlap_hours=9).count() == 7
    assert increment.newest_load(None) is None and increment.overlap_selection(bronze, None) is bronze


@pytest.fixture(scope="module")
def silver(spark, reference):
    rows = [
        (i, i % 7, ["de", "fr", None][i % 3], 97 * i, None if i % 11 == 0 else float(i % 100)) for i in range(400)
    ]
    raw = raw_rows(spark, rows).withColumns({"battery_state": F.lit("Full"), "network_type": F.lit(" WIFI")})
    return silver_of(spark, stamped(raw), reference).persist()


def test_mart_registry():
    assert set(MARTS) == {"daily_country_stats", "country_overview", "device_lifecycle", "hourly_battery_health"}
    with pytest.raises(ValueError, match="unknown mart"):
        mart_spec("weekly")


def test_marts_add_up(silver):
    built = {name: build_mart(silver, spec, "g", "t").collect() for name, spec in MARTS.items()}
    for rows in built.values():
        assert sum(row["n_events"] for row in rows) == 400
    overview = {row["country_code"]: row for row in built["country_overview"]}
    for code, row in overview.items():
        daily = [r for r in built["daily_country_stats"] if r["country_code"] == code]
        assert sum(r["n_events"] for r in daily) == row["n_events"]
        assert len({r["date_local"] for r in daily}) == row["n_active_days"]
        assert (min(r["date_local"] for r in daily), max(r["date_local"] for r in daily)) == (
            row["first_date"],
            row["last_date"],
        )
        assert row["charging_rate"] == 1.0 and row["wifi_rate"] == 1.0


def test_two_levels_give_what_one_pass_gives(silver):
    for spec in MARTS.values():
        keys = list(spec.grain)
        one = {tuple(r[k] for k in keys): r.asDict() for r in _single_pass(silver, spec).collect()}
        two = {tuple(r[k] for k in keys): r.asDict() for r in rolled_up(partial_rows(silver, spec), spec).collect()}
        assert one.keys() == two.keys()
        for key, row in one.items():
            for name, value in row.items():
                other = two[key][name]
                assert other == (pytest.approx(value) if isinstance(value, float) else value), (spec.name, name)


def test_approximate_distinct_counts_are_close(silver):
    spec = MARTS["country_overview"]
    exact = {r["country_code"]: r for r in aggregate(silver, spec).collect()}
    for row in aggregate(silver, spec, relative_error=0.01).collect():
        assert row["n_events"] == exact[row["country_code"]]["n_events"]
        assert row["n_devices"] == pytest.approx(exact[row["country_code"]]["n_devices"], rel=0.1)


def test_marts_use_hash_aggregation_only(spark, silver, tmp_path):
    silver.write.parquet(str(tmp_path / "silver"))
    stored = spark.read.parquet(str(tmp_path / "silver"))
    for spec in MARTS.values():
        plan = plan_of(build_mart(stored, spec, "g", "t"))
        assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_lifetime_and_missing_names(spark, silver):
    device = aggregate(silver.where("device_id = 0"), MARTS["device_lifecycle"]).first()
    moments = [r[0] for r in silver.where("device_id = 0").select("event_ts_str").collect()]
    assert device["first_seen"] <= device["last_seen"] and device["first_seen"] >= min(moments)
    total = aggregate(silver, MARTS["device_lifecycle"]).where("country_code = 'DE' AND device_id = 0").first()
    span = [r[0] for r in silver.where("device_id = 0 AND country_code = 'DE'").select("event_ts_str").collect()]
    want = dt.datetime.fromisoformat(max(span)) - dt.datetime.fromisoformat(min(span))
    assert total["lifetime_days"] == pytest.approx(want.total_seconds() / 86400)
    plain = silver.drop("country_name")
    assert {r["country_name"] for r in aggregate(plain, MARTS["daily_country_stats"]).collect()} == {
        "DE",
        "FR",
        "__NULL__",
    }


def test_conform_and_evolve(spark):
    df = spark.createDataFrame([("1", "x"), ("bad", "y")], "n string, v string")
    schema = schemas.table(long="n", string="v!")
    assert [tuple(r) for r in conform(df, schema).collect()] == [(1, "x"), (None, "y")]
    with pytest.raises(Exception, match="required but NULL"):
        conform(df, schemas.table(long="n!", string="v")).collect()
    with pytest.raises(ValueError, match="lacks columns"):
        conform(df, schemas.table(long="m"))
    grown = evolve(df, schemas.table(string="a b"), after="n")
    assert grown.columns == ["n", "a", "b", "v"] and evolve(grown, schemas.table(string="a b")) is grown
    assert evolve(df, schemas.table(string="z"), after="nowhere").columns == ["n", "v", "z"]


def test_contracts_have_the_agreed_widths():
    widths = {
        "FACT": 45,
        "SILVER": 59,
        "DAILY_COUNTRY_STATS": 19,
        "COUNTRY_OVERVIEW": 19,
        "DEVICE_LIFECYCLE": 18,
        "HOURLY_BATTERY_HEALTH": 14,
        "FILE_LOADS": 27,
        "LAYER_RUNS": 19,
        "MART_RUNS": 19,
        "DAG_RUNS": 16,
        "STREAMING_POSTS": 15,
        "STREAMING_COMMENTS": 16,
        "STREAMING_TODOS": 15,
    }
    assert {name: len(getattr(schemas, name).fields) for name in widths} == widths
    for name in itertools.chain(widths):
        names = getattr(schemas, name).names
        assert len(names) == len(set(names))
