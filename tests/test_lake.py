from __future__ import annotations

import datetime as dt

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from test_batch import raw_rows, stamped

from medallion import schemas
from medallion.operators import audit, facts
from medallion.operators.dedup import fact_dedup
from medallion.operators.marts import MARTS
from medallion.plans import bronze
from medallion.plans.bronze import ingest_files, ingest_table, stream_files
from medallion.plans.gold import refresh_mart, refresh_marts, refresh_states
from medallion.plans.lake import Lake, merge_days, read_facts, read_silver_rows, register_lake
from medallion.plans.silver import refresh_silver
from medallion.session import INITIAL_PARTITIONS, MANY_PARTITIONS, configure
from medallion.sources import files, versions
from medallion.sources.reference import read_reference, read_reference_csv, replace_reference
from medallion.sources.files import counted_casts
from medallion.sources.tables import optional_table, read_table, replace_table

DAY = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


@pytest.fixture()
def lake(spark, tmp_path):
    csv = tmp_path / "countries.csv"
    csv.write_text("country_code,country_name,alpha3_code,region\nde,Germany,DEU,Europe\nCI,Côte d'Ivoire,CIV,Africa\n")
    made = Lake(str(tmp_path / "lake"))
    replace_reference(read_reference_csv(spark, str(csv)), made.reference)
    return made


def add_file(spark, folder, rows):
    raw_rows(spark, rows).coalesce(1).write.mode("append").parquet(str(folder))


def test_rows_of_one_row_group_become_facts_in_many_tasks(spark, lake, tmp_path, monkeypatch):
    folder, tasks, plain = tmp_path / "raw", [], bronze.write_facts
    add_file(spark, folder, [(n, n % 3, "de", n, 50.0) for n in range(9)])
    monkeypatch.setattr(files, "ROWS_PER_TASK", 2)
    monkeypatch.setattr(bronze, "write_facts", lambda s, raw, *more: tasks.append(raw.rdd.getNumPartitions()) or plain(s, raw, *more))
    assert ingest_files(spark, str(folder), lake, "b1", DAY).n_facts == 9
    assert tasks == [5] and sorted(r["source_id"] for r in read_facts(spark, lake).collect()) == list(range(9))


def test_deduplicated_facts_start_with_many_partitions(spark):
    fact = facts.build_fact(stamped(raw_rows(spark, [(1, 10, "de", 0, 50.0), (1, 10, "de", 0, 60.0), (2, 10, "de", 1, 5.0)])))
    try:
        newest = fact_dedup(fact)
        assert f"{MANY_PARTITIONS})" in plan_of(newest) and newest.count() == 2
    finally:
        configure(spark)
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None


def test_files_to_gold_and_again(spark, lake, tmp_path):
    folder = tmp_path / "raw"
    add_file(spark, folder, [(1, 10, "de", 0, 50.0), (2, 11, " ci", 1, 10.0)])
    add_file(spark, folder, [(3, 10, "de", 1500, 70.0)])

    loaded = ingest_files(spark, str(folder), lake, "b1", DAY)
    assert (loaded.n_files, loaded.n_facts, loaded.n_new_devices) == (2, 3, 2)
    assert ingest_files(spark, str(folder), lake, "b2", DAY) is None
    parts = read_facts(spark, lake).select("_part_index", "_file_hash").distinct().collect()
    assert sorted(r[0] for r in parts) == [0, 1]

    first = refresh_silver(spark, lake, "s1", DAY)
    assert (first.mode, first.n_selected, first.n_silver) == ("catchup", 3, 3)
    again = refresh_silver(spark, lake, "s2", DAY)
    assert (again.mode, again.n_silver) == ("increment", 0)

    # A later file repeats an event and brings a new one.
    add_file(spark, folder, [(3, 10, "de", 1500, 99.0), (4, 12, "xx", 1600, 5.0)])
    more = ingest_files(spark, str(folder), lake, "b3", DAY + dt.timedelta(hours=5))
    assert (more.n_files, more.n_facts, more.n_new_devices) == (1, 2, 1)
    third = refresh_silver(spark, lake, "s3", DAY + dt.timedelta(hours=6))
    assert (third.mode, third.n_selected, third.n_silver) == ("catchup", 2, 1)
    silver = read_silver_rows(spark, lake)
    assert silver.count() == silver.select("fact_uid").distinct().count() == 4
    names = {r["source_id"]: r["country_name"] for r in silver.collect()}
    assert names == {1: "Germany", 2: "Côte d'Ivoire", 3: "Germany", 4: "XX"}

    counts = refresh_marts(spark, lake, "g1", now=DAY)
    assert set(counts) == set(MARTS) and counts["country_overview"] == 3
    assert refresh_mart(spark, lake, "country_overview", "g2", DAY) == 3
    gold = read_table(spark, lake.gold("country_overview"), MARTS["country_overview"].schema)
    assert {r["_gold_batch_id"] for r in gold.collect()} == {"g2"}
    with pytest.raises(ValueError):
        refresh_mart(spark, lake, "nothing", "g3")

    views = register_lake(spark, lake)
    assert {"dim_country", "silver_telemetry", "gold_daily_country_stats"} <= set(views)
    total = spark.sql("SELECT sum(n_events) FROM gold_daily_country_stats").first()[0]
    assert total == 4
    codes = {r[0] for r in spark.sql("SELECT raw_value FROM dim_country").collect()}
    assert codes == {"de", "ci", "xx"}

    loads = read_table(spark, lake.audit("file_loads"), schemas.FILE_LOADS).collect()
    assert sorted(r["fact_rows"] for r in loads) == [1, 2, 2]
    runs = read_table(spark, lake.audit("dag_runs"), schemas.DAG_RUNS).collect()
    assert sorted((r["status"], r["total_items"]) for r in runs) == [("SUCCESS", 1), ("SUCCESS", 2)]
    marts = read_table(spark, lake.audit("mart_runs"), schemas.MART_RUNS)
    assert marts.count() == 5 and audit.last_success(marts).count() == 4
    layer = read_table(spark, lake.audit("layer_runs"), schemas.LAYER_RUNS)
    assert [r["rows_silver_out"] for r in layer.orderBy("batch_id").collect()] == [3, 0, 1]


def loads_of(spark, lake):
    return {r["file_key"]: r for r in read_table(spark, lake.audit("file_loads"), schemas.FILE_LOADS).collect()}


def test_one_bad_file_leaves_the_others_loaded(spark, lake, tmp_path):
    folder = tmp_path / "raw"
    add_file(spark, folder, [(1, 10, "de", 0, 50.0), (2, None, "de", 1, 10.0)])
    add_file(spark, folder, [(3, 11, "de", 2, 50.0), (4, 12, "de", 3, 50.0), (5, 12, "de", 4, 50.0)])
    raw_rows(spark, [(9, 9, "de", 5, 1.0)]).drop("battery_state", "battery_level").coalesce(1).write.mode("append").parquet(str(folder))
    (folder / "broken.parquet").write_text("no parquet")
    done = ingest_files(spark, str(folder), lake, "b1", DAY)
    assert (done.n_files, done.n_facts, len(done.failed)) == (1, 3, 3)
    assert sorted(r["source_id"] for r in read_facts(spark, lake).collect()) == [3, 4, 5]
    found = sorted((r["load_status"], r["rc"], r["source_rows"], r["device_count"]) for r in loads_of(spark, lake).values() if r["source_rows"])
    assert found == [("FAILED", 1, 2, 1), ("SUCCESS", 0, 3, 2)]
    errors = " | ".join(r["error"] for r in loads_of(spark, lake).values() if r["error"])
    assert "1 rows without device" in errors and "lacks columns ['battery_state', 'battery_level']" in errors and "broken" in errors
    assert [r["id"] for r in read_table(spark, lake.rejects).collect()] == [2]
    run = read_table(spark, lake.audit("dag_runs"), schemas.DAG_RUNS).first()
    assert (run["status"], run["error"]) == ("FAILED", "3 of 4 files failed")
    # The bad files are offered again, the good one isn't.
    again = ingest_files(spark, str(folder), lake, "b2", DAY)
    assert (again.n_files, len(again.failed)) == (0, 3) and read_facts(spark, lake).count() == 3


def test_jobs_of_bounded_size_lose_nothing(spark, lake, tmp_path):
    folder = tmp_path / "raw"
    for i in range(3):
        add_file(spark, folder, [(i, 10 + i, "de", i, 1.0)])
    done = ingest_files(spark, str(folder), lake, "b", DAY, random_ids=True, files_per_job=2)
    assert (done.n_files, done.n_facts) == (3, 3) and ingest_files(spark, str(folder), lake, "b", DAY) is None
    fact = read_facts(spark, lake)
    devices = read_table(spark, lake.devices, schemas.DEVICE_DIM)
    assert fact.count() == 3 and fact.join(devices, "device_uid").count() == 3
    # The same batch id again adds files, and their devices get the ids that the table holds.
    add_file(spark, folder, [(7, 10, "de", 7, 1.0)])
    assert ingest_files(spark, str(folder), lake, "b", DAY).n_facts == 1
    assert read_facts(spark, lake).count() == 4
    first = refresh_silver(spark, lake, "s", DAY, files_per_job=3)
    assert (first.mode, first.n_silver) == ("catchup", 4)
    assert {r["device_id"] for r in read_silver_rows(spark, lake).collect()} == {10, 11, 12}


def test_a_file_of_duplicates_is_taken_in_once(spark, lake, tmp_path):
    folder = tmp_path / "raw"
    add_file(spark, folder, [(1, 10, "de", 0, 50.0)])
    ingest_files(spark, str(folder), lake, "b1", DAY)
    refresh_silver(spark, lake, "s1", DAY)
    add_file(spark, folder, [(1, 10, "de", 0, 50.0)])
    ingest_files(spark, str(folder), lake, "b2", DAY)
    runs = [refresh_silver(spark, lake, f"s{k}", DAY) for k in (2, 3, 4)]
    assert [(r.mode, r.n_silver) for r in runs] == [("catchup", 0), ("increment", 0), ("increment", 0)]
    assert read_silver_rows(spark, lake).count() == 1


def test_attempts_that_were_cut_short_do_not_count(spark, lake, tmp_path, monkeypatch):
    from medallion.plans import bronze, silver

    folder = tmp_path / "raw"
    add_file(spark, folder, [(1, 10, "de", 0, 50.0)])

    def crash(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(bronze, "commit", crash)
        with pytest.raises(RuntimeError):
            ingest_files(spark, str(folder), lake, "b", DAY)
    assert read_facts(spark, lake).count() == 0
    ingest_files(spark, str(folder), lake, "b", DAY)
    assert read_facts(spark, lake).count() == 1
    with monkeypatch.context() as patch:
        patch.setattr(silver.audit, "counted", crash)
        with pytest.raises(RuntimeError):
            refresh_silver(spark, lake, "s", DAY)
    assert refresh_silver(spark, lake, "s", DAY).mode == "increment"
    assert read_silver_rows(spark, lake).count() == 1


def test_odd_names_and_types(spark, lake, tmp_path):
    folder = tmp_path / "raw"
    add_file(spark, folder / "x", [(1, 10, "de", 0, 50.0)])
    raw = raw_rows(spark, [(2, 11, "5", 1, 10.0)])
    raw.withColumns({"timestamp": F.col("timestamp").cast("string"), "charger": F.lit(3), "memory_active": F.lit(2.5)}).coalesce(1).write.parquet(str(folder / "y"))
    raw_rows(spark, [(3, 12, "de", 2, 10.0)]).withColumn("battery_level", F.lit("full")).coalesce(1).write.parquet(str(folder / "z"))
    for name, new in (("x", "a b"), ("y", "part[1]"), ("z", "x{1}*%20")):
        file = next((folder / name).glob("part-*.parquet"))
        file.rename(folder / f"{new}.parquet")
    done = ingest_files(spark, str(folder), lake, "b", DAY)
    assert (done.n_files, done.n_facts, done.failed) == (3, 3, ())
    rows = {r["source_id"]: r for r in read_facts(spark, lake).collect()}
    assert rows[2]["memory_active"] == 2 and rows[2]["event_ts_str"] and rows[3]["battery_level"] is None
    assert sorted(filter(None, (r["message"] for r in loads_of(spark, lake).values()))) == ["1 values could not be cast"]
    assert ingest_files(spark, str(folder), lake, "b", DAY) is None


def test_casts_are_counted(spark):
    df = spark.createDataFrame([("1", 2.0, "x"), ("no", None, None)], "id string, device_id double, timestamp string")
    schema = schemas.table(long="id device_id", timestamp="timestamp")
    assert [tuple(r) for r in counted_casts(df, schema).collect()] == [(1, 2, None, 1), (None, None, None, 1)]


def test_table_source_run_twice_is_one_batch(spark, lake):
    raw = raw_rows(spark, [(1, 10, "de", 0, 50.0), (2, 11, "ci", 1, 10.0)])
    for _ in range(2):
        ingest_table(spark, raw, "staging", lake, "b1", "2024-02-01 00:00:00")
    assert read_facts(spark, lake).count() == 2
    assert read_table(spark, lake.devices, schemas.DEVICE_DIM).count() == 2
    assert refresh_silver(spark, lake, "s", DAY).n_silver == 2


def test_replace_keeps_the_old_table_when_the_build_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(3), path)
    replace_table(read_table(spark, path).where("id > 0"), path)
    assert read_table(spark, path).count() == 2
    broken = spark.range(5).select(F.raise_error(F.lit("boom")).cast("long").alias("id"))
    with pytest.raises(Exception, match="boom"):
        replace_table(broken, path)
    assert read_table(spark, path).count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    assert optional_table(spark, str(tmp_path / "none")) is None


def test_reference_keeps_non_ascii_and_fills_columns(spark, lake):
    rows = {r["country_code"]: r for r in read_reference(spark, lake.reference).collect()}
    assert rows["CI"]["country_name"] == "Côte d'Ivoire" and rows["de"]["sub_region"] is None


def test_durations_and_audit_rows(spark):
    df = spark.createDataFrame(
        [
            ("2024-01-01T00:00:00Z", "2024-01-01T00:01:30.500+00:00"),
            ("2024-01-01T01:00:00Z", "2024-01-01T00:00:00Z"),
            (None, "2024-01-01T00:00:00Z"),
            ("2024-01-01T00:00:00Z", "soon"),
        ],
        "a string, b string",
    )
    assert [r[0] for r in df.select(audit.duration_seconds("a", "b")).collect()] == [90.5, 0.0, None, None]
    with pytest.raises(ValueError, match="unknown audit fields"):
        audit.audit_frame(spark, [{"nope": 1}], schemas.MART_RUNS)
    assert audit.audit_frame(spark, [{"mart": "m"}], schemas.MART_RUNS).first()["mart"] == "m"


def test_a_failed_refresh_is_recorded(spark, lake):
    with pytest.raises(Exception):
        refresh_mart(spark, lake, "country_overview", "g1", DAY)
    row = read_table(spark, lake.audit("mart_runs"), schemas.MART_RUNS).first()
    assert (row["mart"], row["load_status"], row["rc"]) == ("country_overview", "FAILED", 1)
    assert "no silver table" in row["error"] and row["rows_gold_out"] is None


def test_streamed_files_equal_loaded_files(spark, lake, tmp_path):
    folder = tmp_path / "raw"
    other = Lake(str(tmp_path / "other"))
    for i in range(2):
        add_file(spark, folder, [(i, 10 + i, "de", i, 1.0)])
        stream_files(spark, str(folder), other, str(tmp_path / "cp")).awaitTermination()
    ingest_files(spark, str(folder), lake, "b", DAY)
    varying = ["_loaded_at", "_batch_id", "_part_index"]
    streamed = read_facts(spark, other)
    loaded = read_facts(spark, lake)
    assert sorted(streamed.drop(*varying).collect()) == sorted(loaded.drop(*varying).collect())
    assert len({r["_batch_id"] for r in streamed.collect()}) == 2
    assert read_table(spark, other.devices, schemas.DEVICE_DIM).count() == 2
    assert len(loads_of(spark, other)) == 2 and ingest_files(spark, str(folder), other, "b", DAY) is None


def test_two_streams_fill_one_lake(spark, lake, tmp_path):
    for k in range(2):
        add_file(spark, tmp_path / f"raw{k}", [(k, 10 + k, "de", k, 1.0)])
        stream_files(spark, str(tmp_path / f"raw{k}"), lake, str(tmp_path / f"cp{k}")).awaitTermination()
    assert read_facts(spark, lake).count() == 2


def test_marts_from_day_states(spark, lake, tmp_path):
    def same(*marts):
        for mart in marts or MARTS:
            schema = MARTS[mart].schema
            kept = [name for name in schema.names if not name.startswith("_gold")]
            built = []
            for by_days in (True, False):
                refresh_mart(spark, lake, mart, "g", DAY, by_days=by_days)
                built.append(sorted(read_table(spark, lake.gold(mart), schema).select(*kept).collect(), key=str))
            assert [len(row) for row in built[0]] == [len(row) for row in built[1]]
            for one, other in zip(*built, strict=True):
                assert list(one) == pytest.approx(list(other))

    def load(rows, k):
        add_file(spark, tmp_path / "raw", rows)
        ingest_files(spark, str(tmp_path / "raw"), lake, f"b{k}", DAY + dt.timedelta(hours=k))
        refresh_silver(spark, lake, f"s{k}", DAY + dt.timedelta(hours=k))

    with pytest.raises(FileNotFoundError):
        refresh_states(spark, lake, "country_overview")
    load([(1, 10, "de", 0, 50.0), (2, 11, " ci", 1, 10.0), (3, 10, "de", 3000, 70.0)], 1)
    same("daily_country_stats", "country_overview")
    assert refresh_states(spark, lake, "country_overview") == 0
    # Late rows for the first day alone: a device that the country has on another day, and a new one.
    load([(4, 10, "de", 2, 20.0), (5, 12, "de", 3, 30.0)], 2)
    assert refresh_states(spark, lake, "country_overview") == 4
    same("country_overview", "device_lifecycle", "hourly_battery_health")
    # Merged days are other folders with the same rows.
    merge_days(spark, lake)
    assert refresh_states(spark, lake, "country_overview") == 4
    same("country_overview")
    assert len(versions.latest(spark, lake.states("country_overview")).folders) == 2


def test_day_states_of_two_writers(spark, lake, tmp_path, monkeypatch):
    add_file(spark, tmp_path / "raw", [(1, 10, "de", 0, 50.0), (2, 11, " ci", 1, 10.0)])
    ingest_files(spark, str(tmp_path / "raw"), lake, "b1", DAY)
    refresh_silver(spark, lake, "s1", DAY)
    plain = versions.write_attempt

    def late(*args, **kwargs):
        monkeypatch.setattr(versions, "write_attempt", plain)
        entry = plain(*args, **kwargs)
        assert refresh_states(spark, lake, "country_overview") == 2
        return entry

    monkeypatch.setattr(versions, "write_attempt", late)
    assert refresh_states(spark, lake, "country_overview") == 0
    version = versions.latest(spark, lake.states("country_overview"))
    assert version.number == 1 and versions.rows_of(spark, lake.states("country_overview"), version).count() == 2
