"""Bucketed layouts and tables whose contract changes."""

from __future__ import annotations

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.sources import buckets, contracts, versions


def shuffles(df):
    return plan_of(df).count("Exchange hashpartitioning")


@pytest.fixture()
def layout(spark, tmp_path):
    made = buckets.Layout(f"t_{abs(hash(str(tmp_path)))}", str(tmp_path / "layout"), "k", buckets=4, salts=8)
    yield made
    buckets.drop_layout(spark, made)


def test_joins_without_a_shuffle(spark, layout):
    facts = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id")).alias("k")
    )
    dimension = spark.range(2000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    buckets.lay_out(facts, dimension, layout, share=0.1)
    for how in ("left", "inner", "left_semi", "left_anti"):
        found = buckets.joined(spark, layout, how)
        assert shuffles(found) == 0
        expected = facts.join(dimension, "k", how).select(*found.columns)
        assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    salts = {row[0]: row[1] for row in spark.table(layout.facts).where("k = 7 OR k IS NULL").groupBy("k").agg(F.countDistinct("_salt")).collect()}
    assert salts == {7: 8, None: 8}
    # What comes later goes by the same list, also where a key has become frequent since.
    buckets.add_dimension(spark.createDataFrame([(5000, "late")], "k long, v string"), layout)
    buckets.add_facts(spark.range(3000, 3500).select("id", F.lit(5000).cast("long").alias("k")), layout)
    late = buckets.joined(spark, layout)
    assert shuffles(late) == 0 and late.where("v = 'late'").count() == 500 and late.count() == 3500


def test_layouts_refuse_what_cannot_match(spark, layout):
    facts = spark.range(3).withColumnRenamed("id", "k")
    with pytest.raises(TypeError, match="bigint in facts and string"):
        buckets.lay_out(facts, spark.createDataFrame([("1", "a")], "k string, v string"), layout)
    with pytest.raises(ValueError, match="already has"):
        buckets.lay_out(facts.withColumn("_salt", F.lit(1)), facts, layout)
    buckets.lay_out(facts.limit(0), facts.limit(0).withColumn("v", F.lit("a")), layout)
    assert buckets.joined(spark, layout).count() == 0


ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("a", T.StringType())])


def test_generations_are_read_by_todays_contract(spark, tmp_path):
    path = str(tmp_path / "t")
    contracts.create(spark, path, ROW)
    assert contracts.read_rows(spark, path).columns == ["id", "n", "a"] and contracts.read_rows(spark, path).isEmpty()
    contracts.append_rows(spark.createDataFrame([(1, 5, "x")], ROW), path)
    old = contracts.read_rows(spark, path)
    contracts.rename(spark, path, "a", "b")
    contracts.widen(spark, path, "n", T.LongType())
    contracts.add(spark, path, "c", T.DoubleType())
    contracts.append_rows(spark.createDataFrame([(2, 1 << 40, "y", 0.5)], "id long, n long, b string, c double"), path)
    contracts.drop(spark, path, "n")
    contracts.append_rows(spark.createDataFrame([(3, "z", None)], "id long, b string, c double"), path)
    found = contracts.read_rows(spark, path)
    assert found.columns == ["id", "b", "c"]
    assert sorted(map(tuple, found.collect())) == [(1, "x", None), (2, "y", 0.5), (3, "z", None)]
    # Filters reach files of every generation and find their rows.
    assert found.where("b = 'x'").count() == 1 and found.where("c IS NULL").count() == 2
    assert "PushedFilters: [IsNotNull(b), EqualTo(b,x)]" in plan_of(found.where("b = 'x'"))
    assert [tuple(row) for row in old.collect()] == [(1, 5, "x")]
    assert [schema.names for schema in contracts.contracts(versions.latest(spark, path))][-1] == ["id", "b", "c"]


def test_names_and_types_are_kept_apart(spark, tmp_path):
    path = str(tmp_path / "t")
    contracts.create(spark, path, ROW)
    contracts.rename(spark, path, "a", "b")
    contracts.drop(spark, path, "n")
    for name in ("a", "N", "id"):
        with pytest.raises(ValueError, match="another field's name"):
            contracts.add(spark, path, name, T.StringType())
    with pytest.raises(ValueError, match="cannot be widened from bigint to int"):
        contracts.widen(spark, path, "id", T.IntegerType())
    with pytest.raises(ValueError, match="no field a"):
        contracts.drop(spark, path, "a")
    contracts.rename(spark, path, "b", "a")  # its own old name
    with pytest.raises(ValueError, match="there is a table"):
        contracts.create(spark, path, ROW)
    with pytest.raises(ValueError, match="not a table with contracts"):
        contracts.read_rows(spark, str(tmp_path / "none"))
