"""The version log: readers, writers that meet, merging, and loads with bad files."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from test_batch import raw_rows

from medallion.plans.bronze import ingest_files
from medallion.plans.lake import Lake, merge_days, read_facts, read_silver_rows
from medallion.plans.silver import refresh_silver
from medallion.schemas import RAW_TELEMETRY
from medallion.sources import files, versions
from medallion.sources.reference import replace_reference
from medallion.sources.tables import optional_table, read_table, replace_table

DAY = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


@pytest.fixture()
def lake(spark, tmp_path):
    made = Lake(str(tmp_path / "lake"))
    replace_reference(spark.createDataFrame([("de", "Germany")], "country_code string, country_name string"), made.reference)
    return made


def add_file(spark, folder, rows):
    raw_rows(spark, rows).coalesce(1).write.mode("append").parquet(str(folder))


def ids(df):
    return sorted(row["id"] for row in df.collect())


def test_a_reader_keeps_its_version(spark, tmp_path):
    path = str(tmp_path / "t")
    assert optional_table(spark, path) is None
    replace_table(spark.range(3), path)
    old = read_table(spark, path)
    replace_table(spark.range(10, 15), path)
    assert ids(old) == [0, 1, 2] and ids(read_table(spark, path)) == [10, 11, 12, 13, 14]
    replace_table(read_table(spark, path).where("id > 13"), path)
    assert ids(read_table(spark, path)) == [14]
    # The third version has left nothing of the first.
    assert versions._numbers(spark, path) == [2, 3] and len(list((tmp_path / "t" / "_data").iterdir())) == 2


def test_pins_outlast_replacements(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(2), path)
    with versions.pinned(spark, path) as held:
        for n in (3, 4, 5, 6):
            replace_table(spark.range(n), path)
        assert held.number == 1 and ids(versions.rows_of(spark, path, held)) == [0, 1]
    assert versions.expire(spark, path) == 1 and versions._numbers(spark, path) == [4, 5]


def test_two_writers_and_failures(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(1), path)
    now = versions.latest(spark, path)
    entries = [versions.write_attempt(spark.range(n), path) for n in (2, 3)]
    drafts = [versions.Version(now.number + 1, (entry,), now.schema) for entry in entries]
    with ThreadPoolExecutor(2) as pool:
        won = list(pool.map(lambda draft: versions.publish(spark, path, draft), drafts * 4))
    assert sum(won) == 1
    assert ids(read_table(spark, path)) == list(range(2 + won.index(True) % 2))
    broken = spark.range(5).select(F.raise_error(F.lit("boom")).cast("long").alias("id"))
    before, data = versions.latest(spark, path), sorted(p.name for p in (tmp_path / "t" / "_data").iterdir())
    with pytest.raises(Exception, match="boom"):
        replace_table(broken, path)
    assert versions.latest(spark, path) == before and sorted(p.name for p in (tmp_path / "t" / "_data").iterdir()) == data
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: versions.add_entry(spark, path, versions.Entry(str(n), ()), spark.range(1).schema), range(8)))
    assert len(versions.latest(spark, path).entries) == 9  # no writer's entry was lost


def test_partitions_odd_values_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t [x] {y}")
    rows = spark.createDataFrame([(1, "a/b"), (2, None), (3, "c*=d")], "id long, kind string")
    replace_table(rows, path, ["kind"])
    assert sorted(map(tuple, read_table(spark, path, rows.schema).collect())) == [(1, "a/b"), (2, None), (3, "c*=d")]
    replace_table(rows.limit(0), path, ["kind"])
    assert read_table(spark, path).count() == 0 and read_table(spark, path).columns == ["id", "kind"]


def test_merged_days(spark, lake, tmp_path):
    folder = tmp_path / "raw"
    for k in range(3):
        add_file(spark, folder, [(k, 10 + k, "de", 0, 50.0), (k + 10, 10 + k, "de", 1500, 1.0)])
        ingest_files(spark, str(folder), lake, f"b{k}", DAY)
        refresh_silver(spark, lake, f"s{k}", DAY)
    lost = versions.write_attempt(read_facts(spark, lake), lake.fact, ["event_date"], "lost", final=False)
    versions.add_entry(spark, lake.fact, lost, read_facts(spark, lake).schema)
    facts, silver = (sorted(read(spark, lake).collect()) for read in (read_facts, read_silver_rows))
    reader = read_facts(spark, lake)
    days = len({row["event_date"] for row in facts})
    assert days > 1 and merge_days(spark, lake, at_once=1) == {lake.fact: days, lake.silver: days}
    assert sorted(read_facts(spark, lake).collect()) == facts and sorted(read_silver_rows(spark, lake).collect()) == silver
    final = [folder for entry in versions.latest(spark, lake.fact).entries if entry.final for folder in entry.folders]
    assert len(final) == days and merge_days(spark, lake) == {lake.fact: 0, lake.silver: 0}
    # The attempt that no ledger knows is neither read nor merged, and later files are added to what was merged.
    assert any(entry.attempt == "lost" for entry in versions.latest(spark, lake.fact).entries)
    add_file(spark, folder, [(30, 10, "de", 0, 50.0)])
    ingest_files(spark, str(folder), lake, "b9", DAY)
    assert refresh_silver(spark, lake, "s9", DAY).n_silver == 1 and read_facts(spark, lake).count() == len(facts) + 1
    assert refresh_silver(spark, lake, "s10", DAY).n_silver == 0
    del reader


def test_merging_twice_at_once_keeps_every_row_once(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(6).select("id", (F.col("id") % 2).cast("string").alias("event_date"))
    for _ in range(3):
        versions.add_entry(spark, path, versions.write_attempt(rows, path, ["event_date"]), rows.schema)

    def merge(_):
        return versions.merge_folders(spark, path, rows.schema, ["event_date"], lambda df: df.coalesce(1), lambda attempts: set())

    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(merge, range(2)))
    assert sorted(done) == [0, 2] and ids(read_table(spark, path, rows.schema)) == sorted(list(range(6)) * 3)


def test_an_idle_refresh_enters_nothing(spark, lake, tmp_path):
    add_file(spark, tmp_path / "raw", [(1, 10, "de", 0, 50.0)])
    ingest_files(spark, str(tmp_path / "raw"), lake, "b", DAY)
    for k in range(3):
        refresh_silver(spark, lake, f"s{k}", DAY)
    assert read_table(spark, lake.silver_ledger).count() == 1


def damage(folder, keep):
    """Overwrite the pages of the files that were added to ``folder`` since ``keep``."""
    for file in set(folder.glob("part-*.parquet")) - keep:
        content = bytearray(file.read_bytes())
        footer = int.from_bytes(content[-8:-4], "little") + 8
        content[4:-footer] = b"\xff" * (len(content) - footer - 4)
        file.write_bytes(content)
        (folder / f".{file.name}.crc").unlink()


@pytest.mark.parametrize("per_job", [1, 50])
def test_damaged_pages_and_types_fail_alone(spark, lake, tmp_path, per_job):
    folder = tmp_path / "raw"
    add_file(spark, folder, [(1, 10, "de", 0, 50.0)])
    damage(folder, set())
    for k in range(2, 6):
        add_file(spark, folder, [(k, 10 + k, "de", k, 50.0)])
    before = set(folder.glob("part-*.parquet"))
    add_file(spark, folder, [(7, 10, "de", 0, 50.0)])
    damage(folder, before)
    raw_rows(spark, [(8, 9, "de", 5, 1.0)]).withColumn("battery_level", F.array(F.lit(1))).coalesce(1).write.mode("append").parquet(str(folder))
    done = ingest_files(spark, str(folder), lake, "b1", DAY, files_per_job=per_job)
    assert (done.n_files, done.n_facts, len(done.failed)) == (4, 4, 3)
    again = ingest_files(spark, str(folder), lake, "b2", DAY, files_per_job=per_job)
    assert (again.n_files, len(again.failed)) == (0, 3)
    assert sorted(row["source_id"] for row in read_facts(spark, lake).collect()) == [2, 3, 4, 5]


def test_halving_scans_little(spark, tmp_path, monkeypatch):
    places, scans = {f"f{k:03}": str(k) for k in range(100)}, []

    class Rows:
        def __init__(self, bad):
            self.bad = bad
            self.write = self

        def format(self, _):
            return self

        mode = format

        def save(self):
            if self.bad:
                raise OSError("damaged")

    def scan(spark, some, schema):
        scans.append(len(some))
        return files.RawScan(Rows(bad & set(some)), {})

    monkeypatch.setattr(files, "scan_files", scan)
    for bad in (set(), {"f000"}, {"f057"}, {"f003", "f099"}, set(places)):
        scans.clear()
        assert set(files.unreadable(spark, places, RAW_TELEMETRY)) == bad
        if len(bad) == 1:
            assert len(scans) <= 15 and sum(scans) <= 4 * len(places)


def test_an_error_that_is_not_of_the_files_is_raised(spark, lake, tmp_path, monkeypatch):
    from medallion.plans import bronze

    add_file(spark, tmp_path / "raw", [(1, 10, "de", 0, 50.0)])
    monkeypatch.setattr(bronze, "ingest_frame", lambda *args: (_ for _ in ()).throw(RuntimeError("disk full")))
    with pytest.raises(RuntimeError, match="disk full"):
        ingest_files(spark, str(tmp_path / "raw"), lake, "b", DAY)
    assert read_facts(spark, lake) is None


def test_a_file_system_that_is_not_local(spark, tmp_path):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.versions.link./in", f"file://{tmp_path}")
    path = "viewfs://versions/in/t"
    replace_table(spark.range(3), path)
    now = versions.latest(spark, path)
    assert not versions.publish(spark, path, now) and versions.latest(spark, path) == now
    replace_table(read_table(spark, path).where("id > 0"), path)
    assert ids(read_table(spark, path)) == [1, 2] and versions._numbers(spark, path) == [1, 2]
