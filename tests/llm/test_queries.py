"""The registered queries against their SQL, and the pipeline against its stages done one by one in Python."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from medallion.llm import queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    df = contract.queries()[name](spark, SF_DIR)
    found = db.execute(contract.oracle_sql()[name])
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in found.description], found.fetchall())


def test_all_are_registered():
    assert set(queries.queries()) | {"pipeline"} <= set(contract.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "simhash_near_dedup", "pii", "best_fit_packing",
    ]


def test_native_operators_run_no_python(spark):
    for name in ("op5_exact_dedup", "op6_chat_formatting", "op8_url_filters"):
        plan = contract.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop")), name


def test_pipeline_against_brute_force(spark):
    from test_packing import check_packing
    from test_simhash import brute_components, brute_fingerprint

    from medallion.llm import language, pii

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    filters = language.learn_from(docs)
    kept = {}
    for row in docs.collect():
        name, score = filters.predict(row["text"])
        if name != language.UNKNOWN and score >= language.MIN_SCORE:
            kept[row["doc_id"]] = row["text"]
    assert len(kept) > 0.95 * docs.count()
    first = {}
    for doc_id in sorted(kept):
        first.setdefault(" ".join(kept[doc_id].replace("\n", " ").split()), doc_id)
    single = {doc_id: kept[doc_id] for doc_id in first.values()}
    roots = brute_components({doc_id: brute_fingerprint(text) for doc_id, text in single.items()}, 2)
    single = {doc_id: text for doc_id, text in single.items() if roots[doc_id] == doc_id}
    left = {doc_id: pii.redacted(text, pii.Trees()) for doc_id, text in single.items()}
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert check_packing(found, left) <= 1.02
    assert hashlib.sha256(b"").hexdigest() and not math.isnan(len(found))


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumnsRenamed({"source": "lang_pred"})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns, name


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0, name
