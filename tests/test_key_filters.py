"""Filters of keys against plain sets, and silver refreshed through them."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F
from test_batch import raw_rows, stamped
from test_versions import DAY, add_file, lake  # noqa: F401

from medallion.functions import stable_uuid
from medallion.operators import enrich, facts, key_filters
from medallion.operators.dedup import fact_dedup
from medallion.operators.key_filters import build_filters, maybe_held
from medallion.plans.bronze import ingest_files
from medallion.plans.key_filters import refresh_key_filters
from medallion.plans.lake import merge_days, read_silver_rows
from medallion.plans.silver import refresh_silver
from medallion.session import configure, short_methods
from medallion.sources import versions
from medallion.sources.tables import write_once


def row(identity):
    return (identity, 7, "de", 0, 0.5)


def keyed(spark, first, last, day="d1", group="g1"):
    return spark.range(first, last).select(
        F.lit(group).alias("folder"), F.lit(day).alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("key")
    )


@pytest.mark.parametrize("broadcast", [1 << 26, 0])
def test_filters_hold_every_key_and_few_others(spark, monkeypatch, broadcast):
    monkeypatch.setattr(key_filters, "KEYS_PER_BLOCK", 500)
    stored = keyed(spark, 0, 6000).unionByName(keyed(spark, 6000, 6010, group="g2")).unionByName(keyed(spark, 0, 10, "d2", "g3"))
    filters = build_filters(stored, ["folder", "day"], "key").cache()
    assert sorted(row[0] for row in filters.groupBy("folder").count().select("count").collect()) == [1, 1, 16]
    asked = keyed(spark, 5000, 20000).select("day", "key")
    found = maybe_held(asked, filters, ["folder", "day"], "day", "key", broadcast)
    exact = stored.join(asked, ["day", "key"], "left_semi").select("folder", "day", "key")
    assert exact.count() == 1010 and exact.exceptAll(found).isEmpty()
    assert found.count() <= 1015


def test_null_and_no_keys(spark):
    keys = spark.createDataFrame([("g", "d", None), ("g", "d", "")], "folder string, day string, key string")
    filters = build_filters(keys, ["folder", "day"], "key")
    assert maybe_held(keys.select("day", "key"), filters, ["folder", "day"], "day", "key").collect() == [("g", "d", "")]
    none = build_filters(keys.limit(0), ["folder", "day"], "key")
    assert none.isEmpty() and maybe_held(keys.select("day", "key"), none, ["folder", "day"], "day", "key").isEmpty()


def test_silver_by_filters(spark, tmp_path, lake):  # noqa: F811
    add_file(spark, tmp_path / "in", [row(1), row(2)])
    ingest_files(spark, str(tmp_path / "in"), lake, "b1", DAY)
    assert refresh_silver(spark, lake, "s1", DAY, by_filters=True).n_silver == 2
    add_file(spark, tmp_path / "in", [row(2), row(3)])
    ingest_files(spark, str(tmp_path / "in"), lake, "b2", DAY)
    again = refresh_silver(spark, lake, "s2", DAY, by_filters=True)
    assert (again.n_selected, again.n_silver) == (2, 1)
    idle = refresh_silver(spark, lake, "s3", DAY, mode="increment", by_filters=True)
    assert idle.n_selected == 4 and idle.n_silver == 0
    assert len(versions.latest(spark, lake.silver_keys).folders) == 2
    # Merged folders take their filters with them; until new ones are made their keys are read.
    merge_days(spark, lake)
    assert refresh_silver(spark, lake, "s4", DAY, mode="increment").n_silver == 0
    assert refresh_key_filters(spark, lake) == 1 and refresh_key_filters(spark, lake) == 0
    assert len(versions.latest(spark, lake.silver_keys).folders) == 1
    assert sorted(row[0] for row in read_silver_rows(spark, lake).select("source_id").collect()) == [1, 2, 3]


def test_code_of_wide_rows_is_kept_short(spark):
    limit, splits, writers = "spark.sql.codegen.hugeMethodLimit", "spark.sql.files.maxPartitionBytes", "spark.sql.maxConcurrentOutputFileWriters"
    raw = stamped(raw_rows(spark, [row(1), row(1), row(2)]))
    reference = spark.createDataFrame([], "country_code string, country_name string, alpha3_code string, region string, sub_region string")
    try:
        configure(spark)
        # Facts may be made by many lookups, which stay joined in one method.
        assert fact_dedup(facts.build_fact(raw)).count() == 2
        assert spark.conf.get(limit, None) is None and spark.conf.get(splits, None) is not None
        configure(spark)
        assert enrich.silver_from_raw(raw, reference, "s", "2024-01-01 00:00:00").count() == 3
        # The JVM never compiles a method of more than 8,000 bytes.
        assert int(spark.conf.get(limit)) <= 8000 and int(spark.conf.get(writers)) > 1
        assert spark.conf.get(splits, None) is None
        configure(spark)
        # What the user has chosen stays.
        spark.conf.set(splits, "7m")
        fact_dedup(raw.withColumn("fact_uid", F.lit("a")))
        assert spark.conf.get(splits) == "7m"
    finally:
        spark.conf.unset(splits)
        configure(spark)
    assert [spark.conf.get(name, None) for name in (limit, splits, writers)] == [None] * 3


def test_more_days_than_open_files(spark, tmp_path):
    """Days that a task has no open file for are written, too."""
    days = spark.range(0, 90, 1, 1).select("id", F.concat(F.lit("d"), F.col("id") % 30).alias("event_date"))
    short_methods(spark)
    try:
        written = write_once(days, str(tmp_path / "days"), ["event_date"])
        assert sorted(map(tuple, written.collect())) == [(n, f"d{n % 30}") for n in range(90)]
    finally:
        configure(spark)


def test_ids_are_cut_from_the_digest(spark):
    found = spark.createDataFrame([("ä", 1), (None, 2)], "a string, n int").select(
        stable_uuid("ns", "a", "n"), stable_uuid("ns", "a", "n", null_gives_null=True)
    )

    def cut(text):
        digest = hashlib.sha256(text.encode()).hexdigest()
        return f"{digest[:8]}-{digest[8:12]}-5{digest[13:16]}-8{digest[16:19]}-{digest[19:31]}"

    assert [tuple(r) for r in found.collect()] == [(cut("ns|ä|1"), cut("ns|ä|1")), (cut("ns|__null__|2"), None)]
    assert [field.dataType.simpleString() for field in found.schema] == ["string", "string"]
    # Characters of text would have to be counted for every piece.
    assert "substring(cast(sha2" in found._jdf.queryExecution().optimizedPlan().toString()
