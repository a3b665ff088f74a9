from __future__ import annotations

from collections import Counter

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from medallion.operators.dedup import latest_by
from medallion.operators.indexing import dense_index
from medallion.operators.joins import broadcastable, hot_keys, lookup_join, measured_bytes, measured_bytes_by, salted_join
from medallion.sources.files import spread


@pytest.fixture(scope="module")
def sides(spark):
    # A third of the left rows share one key, and these are identical copies; some keys are NULL or unknown.
    left = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 40).cast("string")))
        .alias("key"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("v"),
    )
    right = spark.createDataFrame([("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(30)], "key string, w int")
    return left.repartition(6), right


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(sides, how):
    left, right = sides
    want = left.join(right, "key", how)
    got = salted_join(left, right, "key", how, salts=8, share=0.05)
    assert got.columns == want.select(*got.columns).columns
    assert Counter(got.collect()) == Counter(want.select(*got.columns).collect())


def test_salted_join_spreads_the_hot_key(sides):
    left, right = sides
    spread = salted_join(left, right.dropDuplicates(["key"]), "key", "left", salts=8, share=0.05)
    assert "_salt" in plan_of(spread)
    assert {row[0] for row in hot_keys(left, "key", 0.05).collect()} == {"hot"}


def test_lookup_join_broadcasts_only_below_its_bound(sides):
    left, right = sides
    assert "BroadcastHashJoin" in plan_of(lookup_join(left, right, "key"))
    beyond = lookup_join(left, right, "key", max_broadcast_bytes=10)
    assert "SortMergeJoin" in plan_of(beyond)
    assert Counter(beyond.collect()) == Counter(left.join(right, "key", "left").collect())
    with pytest.raises(ValueError):
        lookup_join(left, right, "key", "full")


def test_measured_bytes_count_text(spark):
    df = spark.createDataFrame([("a", "x" * 100), ("a", "y"), ("b", None)], "k string, v string")
    assert measured_bytes(df) > 100
    sizes = measured_bytes_by(df, "k")
    assert sizes["a"] - sizes["b"] >= 101
    assert measured_bytes(df.where("k = 'z'")) == 0


def test_latest_by_is_deterministic_and_limits_before_the_shuffle(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), ("b", 0, "m")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    kept = {row["k"]: row["v"] for row in latest_by(df, ["k"], ["t"]).collect()}
    again = {row["k"]: row["v"] for row in latest_by(df.repartition(3), ["k"], ["t"]).collect()}
    assert kept == again and kept["a"] in ("y", "z") and kept["b"] == "m"
    plan = plan_of(latest_by(df, ["k"], ["t"]))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_dense_index_has_no_gaps(spark):
    df = spark.range(1000).select(F.concat(F.lit("p"), (F.col("id") * 7919 % 1000).cast("string")).alias("path"))
    rows = dense_index(df.repartition(7), ["path"], "n").collect()
    by_number = [row["path"] for row in sorted(rows, key=lambda row: row["n"])]
    assert [row["n"] for row in sorted(rows, key=lambda row: row["n"])] == list(range(1000))
    assert by_number == sorted(by_number)
    assert dense_index(df.where("path = ''"), ["path"], "n").count() == 0


def test_spread_leaves_scans_with_enough_splits_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == cores
    wide = spark.range(0, 100, 1, cores)
    assert spread(wide) is wide


def test_lookups_share_one_broadcast_budget():
    sizes = {"a": 40, "b": 30, "c": 50, "d": 0}
    assert broadcastable(sizes, 70) == {"d", "b", "a"}
    assert broadcastable(sizes, 69) == {"d", "b"} and broadcastable(sizes, -1) == set()
