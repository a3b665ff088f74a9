from __future__ import annotations

import random
import zlib
from pathlib import Path

import numpy as np
import pytest

from medallion.llm import language

WORDS = {"xx": "bakari molune taveso rikkoma", "yy": "schtrumpf glorwig knerz hasplund"}


def texts_of(lang, n, seed=0):
    rng = random.Random(f"{lang}{seed}")
    return [" ".join(rng.choices(WORDS[lang].split(), k=30)) for _ in range(n)]


def labelled(spark, n=60):
    rows = [(k, t, lang, "clash") for lang in WORDS for k, t in enumerate(texts_of(lang, n))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_edge_cases(spark):
    docs = labelled(spark)
    odd = [(1000, None, "xx"), (1001, "", "xx"), (1002, "123 !!", "xx"), (1003, "k", None), (None, "bakari molune", None),
           (1005, "knerz", "xx"), (1005, "knerz", "xx"), (1006, "glorwig knerz " * 30_000, "yy"), (1007, "日本", None)]
    rows = language.identify(docs.drop("score").unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string"))).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["lang_pred"], r["held_out"]))
        assert 0 <= r["score"] <= 1
        expected = False if r["doc_id"] is None else zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1
        assert r["held_out"] == expected
    assert len(rows) == 120 + len(odd)
    assert [by[k][0][0] for k in (1000, 1001, 1002)] == ["und"] * 3
    assert by[None][0][0] == "xx" and by[1005] == [("yy", by[1005][0][1])] * 2 and by[1006][0][0] == "yy"
    assert by[1003][0][0] in WORDS and by[1007][0][0] in WORDS
    kept = language.keep_known_languages(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(0, "words", None)], "doc_id long, text string, lang string")
    assert language.identify(docs).first()["lang_pred"] == "und"
    assert language.identify(docs.limit(0)).count() == 0 == language.keep_known_languages(docs.limit(0)).count()


def test_held_out_rows_teach_nothing(spark):
    ids = [k for k in range(300) if zlib.crc32(str(k).encode()) % 3 == 1]
    rows = [(k, t, "yy") for k, t in zip(ids, texts_of("yy", len(ids)))] + [(k, t, "xx") for k, t in enumerate(texts_of("xx", 300)) if k not in ids]
    filters = language.learn_from(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert filters.languages == ["xx"]


def test_false_positives_are_corrected():
    rng = np.random.default_rng(1)
    hashes = [rng.integers(0, 1 << 63, 2000, dtype=np.uint64) for _ in range(70)]
    filters = language.build([f"l{k}" for k in range(70)], hashes)
    assert len(filters.planes) == 2 and all(0 < share < 0.1 for share in filters.false_share)
    slots = language.slots_of(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64), filters.bits)
    seen = np.count_nonzero(filters.planes[0][slots[0]] & filters.planes[0][slots[1]] & np.uint64(1))
    assert abs(seen / 20_000 - filters.false_share[0]) < 0.01


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    if not Path(path).exists():
        pytest.skip("no test tables")
    docs = spark.read.parquet(path)
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows) > 100


@pytest.mark.parametrize("doc_id", [1, 2, 3, 5, 6, 8])
def test_an_id_that_a_third_of_the_rows_share(spark, doc_id):
    if zlib.crc32(str(doc_id).encode()) % 3 == 1:
        pytest.skip("held out")
    rows = [(doc_id, text, "xx") for text in texts_of("xx", 1_500)] + [(100 + k, text, "yy") for k, text in enumerate(texts_of("yy", 1_700))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = language.learn_from(docs, sample=200)
    assert sorted(filters.languages) == ["xx", "yy"]
    for name in ("xx", "yy"):
        assert all(filters.predict(text)[0] == name for text in texts_of(name, 5))
