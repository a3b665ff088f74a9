from __future__ import annotations

import random

import numpy as np
import pytest

from medallion.llm import substrings


def brute(texts, window):
    words = {k: (t or "").encode().split() for k, t in texts.items()}
    first = {}
    for k in sorted(words):
        for at in range(len(words[k]) - window + 1):
            first.setdefault(tuple(words[k][at : at + window]), k)
    found = {}
    for k, own in words.items():
        gone = {i for at in range(len(own) - window + 1) if first[tuple(own[at : at + window])] < k for i in range(at, at + window)}
        found[k] = len(own), len(gone), b" ".join(w for i, w in enumerate(own) if i not in gone).decode()
    return found


def planted(seed, window):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3 if seed % 2 else 400)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(window, 4 * window))] for _ in range(6)]
    texts = {}
    for k in range(40):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 5 * window))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(passages)
            cut = rng.randint(0, len(passage) // 2)
            at = rng.randint(0, len(words))
            words[at:at] = passage[cut : cut + rng.randint(window - 1, len(passage))]
        texts[k] = rng.choice([" ", "\n", " \t "]).join(words)
    return texts | {50: None, 51: "", 52: texts[3], 53: texts[3] + " tail", 54: "a " * 40, 55: "a " * 60}


@pytest.mark.parametrize("seed,window", [(0, 10), (1, 10), (2, 5), (3, 1), (4, 50), (5, 7)])
def test_against_brute_force(spark, seed, window):
    texts = planted(seed, window)
    docs = spark.createDataFrame([(k, t, "clash") for k, t in texts.items()], "doc_id long, text string, body string")
    rows = substrings.drop_repeats(docs, window).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in rows} == brute(texts, window)
    for r in rows:
        assert sum(gap["to"] - gap["from"] for gap in r["removed"]) == r["n_removed"]
        assert all(a["to"] < b["from"] for a, b in zip(r["removed"], r["removed"][1:]))


def test_null_and_repeated_ids(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(None, passage), (None, passage), (7, passage), (7, passage), (7, "other " + passage), (9, "new " + passage), (9, "short")]
    found = substrings.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in found) == [
        (0, 60, 0), (0, 60, 0), (7, 60, 0), (7, 60, 0), (7, 61, 0), (9, 1, 0), (9, 61, 60),
    ]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.drop_repeats(empty).count() == 0


def test_smallest_of():
    values = np.random.default_rng(1).integers(0, 1000, 200)
    for width in (1, 2, 3, 7, 16, 26, 200):
        expected = [values[k : k + width].min() for k in range(len(values) - width + 1)]
        assert substrings.smallest_of(values, width).tolist() == expected
