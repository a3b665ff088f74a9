"""Every registered query against its SQL, on the smallest sample."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import pytest
from conftest import plan_of

import __spark_entry__ as contract
import oracle_queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="module", autouse=True)
def compiled(spark):
    """The contract is checked with generated code, as on a cluster."""
    settings = {"spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        return "nan" if isinstance(value, float) and math.isnan(value) else value

    return [columns[i] for i in order], Counter(tuple(cell(row[i]) for i in order) for row in rows)


def test_flagship(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_its_sql():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(contract._queries) == set(oracle_queries.all_queries())


@pytest.mark.parametrize("name", sorted(oracle_queries.all_queries()))
def test_query_equals_sql(spark, db, name):
    df = contract.queries()[name](spark, SF_DIR)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    cursor = db.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert canonical(df.columns, df.collect()) == canonical(names, cursor.fetchall())
