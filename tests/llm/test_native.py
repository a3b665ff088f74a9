"""Exact deduplication, chat formatting and URL filters on hand-made rows."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from medallion.llm import chat, exact, urls


def test_exact_groups(spark):
    texts = {5: "a  b", 2: "a\tb", 9: "a b ", 1: "a b", 7: None, 3: "", 4: " ", 8: "x" * 200_000, 6: "A b", 10: "a\u00a0b"}
    docs = spark.createDataFrame([(k, t, "clash") for k, t in texts.items()], "doc_id long, text string, hash string")
    found = {r["doc_id"]: r for r in exact.exact_groups(docs).collect()}
    body = {k: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for k, t in texts.items()}
    for k, row in found.items():
        same = [i for i in texts if body[i] == body[k]]
        assert (row["keep_id"], row["group_size"], row["kept"]) == (min(same), len(same), k == min(same))
        assert row["text_sha256"] == hashlib.sha256(body[k].encode()).hexdigest()
    assert {r["doc_id"] for r in exact.drop_exact_copies(docs).collect()} == {k for k, r in found.items() if r["kept"]}
    assert exact.drop_exact_copies(docs).columns == docs.columns
    assert exact.exact_groups(docs.limit(0)).count() == 0 == exact.drop_exact_copies(docs.limit(0)).count()


def test_colliding_hashes_keep_texts_apart(spark):
    texts = {k: f"text {k // 2}" for k in range(20)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for hashed in (lambda text: F.lit(b"same"), lambda text: F.substring(exact.hash128(text), 1, 0)):
        found = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact.exact_groups(docs, hashed=hashed).collect()}
        assert found == {k: (k - k % 2, 2) for k in texts}


def test_exact_null_and_repeated_ids(spark):
    rows = [(None, "only"), (None, "only"), (None, "both"), (3, "both"), (4, "twice"), (4, "twice"), (4, "other"), (1, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"], r["kept"]) for r in exact.exact_groups(docs).collect())
    assert found == sorted(
        [(0, 0, 2, True)] * 2 + [(0, 3, 2, False), (3, 3, 2, True)] + [(4, 4, 2, True)] * 2 + [(4, 1, 2, False), (1, 1, 2, True)]
    )
    left = sorted((r["doc_id"] or 0, r["text"]) for r in exact.drop_exact_copies(docs).collect())
    assert left == sorted([(0, "only")] * 2 + [(0, "both"), (3, "both"), (4, "twice"), (4, "twice"), (1, "other")])


def turns_of(*sides):
    return [(pair, side, turn, role, text) for pair, side, said in sides for turn, role, text in said]


TURNS = "pair_id long, side string, turn long, role string, text string"


def test_preference_turns(spark):
    common = [(0, "system", "be kind"), (1, "user", "hi")]
    rows = turns_of(
        (1, "chosen", [*common, (2, "assistant", "hello"), (3, "user", "same")]),
        (1, "rejected", [*common, (2, "assistant", "go"), (3, "user", "same")]),
        (2, "chosen", common),
        (2, "rejected", common),
        (3, "chosen", common),
        (4, "chosen", common),
        (4, "rejected", [*common, (2, "assistant", None)]),
        (5, "chosen", [(0, None, None)]),
        (5, "rejected", [(0, None, None), (0, None, None)]),
        (None, "chosen", common),
    ) + [(1, "other", 0, "x", "y"), (1, "chosen", None, "x", "y")]
    found = chat.preference_turns(spark.createDataFrame(rows, TURNS))
    parts = {}
    for r in sorted(found.collect(), key=lambda r: (r["pair_id"], r["part"], r["turn"])):
        parts.setdefault((r["pair_id"], r["part"]), []).append((r["turn"], r["role"], r["header"] + r["body"], r["trained"]))
    prompt = [(0, "system", "<|system|>\nbe kind<|end|>\n", False), (1, "user", "<|user|>\nhi<|end|>\n", False)]
    assert parts == {
        (1, "prompt"): prompt,
        (1, "chosen"): [(2, "assistant", "<|assistant|>\nhello<|end|>\n", True), (3, "user", "<|user|>\nsame<|end|>\n", False)],
        (1, "rejected"): [(2, "assistant", "<|assistant|>\ngo<|end|>\n", True), (3, "user", "<|user|>\nsame<|end|>\n", False)],
        (2, "prompt"): prompt,
        (4, "prompt"): prompt,
        (4, "rejected"): [(2, "assistant", "<|assistant|>\n<|end|>\n", True)],
        (5, "prompt"): [(0, "unknown", "<|unknown|>\n<|end|>\n", False)],
    }
    assert chat.preference_turns(spark.createDataFrame([], TURNS)).count() == 0


def fits(host, path, rule_host, rule_path):
    return (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path)


def judged(url, rules):
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (found[1], found[2]) if found else ("", "")
    host = host.translate({c: c + 32 for c in range(65, 91)})
    best = max(
        [(len(h + p), len(h), h + p, v) for h, p, v in rules if host and fits(host, path, h, p)], default=(0, 0, None, "allow")
    )
    return host, path, best[2], best[3]


@pytest.mark.parametrize("salts", [1, 7])
def test_urls_against_brute_force(spark, salts):
    rng = random.Random(salts)
    labels, paths = ["a", "b", "net", "ab", "", "é", "A", "a-b"], ["", "/", "/en/", "/en", "/en/x", "/é", "/zz?q", "#f", "/e\n"]
    rules = list({
        (h, p): (h, p, rng.choice(["allow", "block"]))
        for h, p in (
            (".".join(rng.choice(["a", "b", "net", "ab"]) for _ in range(rng.randint(1, 4))), rng.choice(["", "/", "/en", "/en/", "/e", "/é"]))
            for _ in range(60)
        )
    }.values())
    found_urls = [None, "", "no scheme", "://", "http://", "x://net", "a://b://net/en/"]
    for _ in range(400):
        host = ".".join(rng.choice(labels) for _ in range(rng.randint(1, 5)))
        found_urls.append(f"http://{host}{rng.choice(paths)}")
    rows = [(k if k % 50 else None, url, "clash") for k, url in enumerate(found_urls * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    table = spark.createDataFrame([*rules, ("", "/", "block"), (None, "/", "block")], "host string, path string, verdict string")
    found = urls.judge_urls(pages, table, salts=salts).collect()
    expected = [(page_id or -1, *judged(url, rules)) for page_id, url, _ in rows]
    key = lambda row: tuple(str(v) for v in row)
    assert sorted(((r["page_id"] or -1, r["host"], r["path"], r["rule"], r["verdict"]) for r in found), key=key) == sorted(expected, key=key)


def test_url_edge_cases(spark):
    pages = spark.createDataFrame([(1, "http://Sub.NET" + "/x" * 5000)], "page_id long, url string")
    rules = urls.fixed_rules(spark)
    assert urls.judge_urls(pages, rules).first()["rule"] == "net/"
    assert urls.judge_urls(pages.limit(0), rules).count() == 0
    assert urls.judge_urls(pages, rules.limit(0)).first()["verdict"] == "allow"
    both = spark.createDataFrame([("net", None, "allow"), ("NET", "", "block")], "host string, path string, verdict string")
    assert urls.judge_urls(pages, both).first()["verdict"] == "block"


def test_one_row_of_equal_texts_stays(spark):
    rows = [(None, "a b"), (3, "a  b"), (2, "a b"), (2, "a\tb"), (None, "c"), (None, "c"), (5, "d"), (5, "e"), (None, None), (7, "")]
    docs = spark.createDataFrame([(*row, k) for k, row in enumerate(rows)], "doc_id long, text string, row long")
    kept = exact.one_row_of_each_text(docs).collect()
    assert [*kept[0].asDict()] == ["doc_id", "text", "row"]
    assert sorted((r["doc_id"] or 0, " ".join((r["text"] or "").split())) for r in kept) == [(0, "c"), (2, "a b"), (5, "d"), (5, "e"), (7, "")]


def test_answer_pairs(spark):
    schema = "conv_id long, turn int, role string, text string, side string"
    rows = [
        (2, 0, "user", "hi", "x"), (2, 1, "assistant", "a", "x"), (2, 2, "user", "bye", "x"), (2, 3, "assistant", "b", "x"),
        (3, 0, "user", "so", "x"), (3, 1, "assistant", "c", "x"),
        (4, 0, "user", "alone", "x"), (4, 1, "assistant", None, "x"),
        (6, 0, "user", None, "x"), (6, 1, None, "d", "x"),
        (None, 0, "user", "no", "x"), (8, None, "user", "no", "x"), (3, 1, "assistant", "c", "x"),
        (8, 0, "assistant", "same", "x"), (9, 0, "assistant", "same", "x"), (10, 0, "assistant", "only", "x"),
    ]
    pairs = chat.answer_pairs(spark.createDataFrame(rows, schema))
    found = {(r["pair_id"], r["part"], r["turn"], r["body"], r["trained"]) for r in chat.preference_turns(pairs).collect()}

    def turn(pair, part, number, text, trained=False):
        return pair, part, number, f"{text}<|end|>\n", trained

    assert found == {
        turn(2, "prompt", 0, "hi"), turn(2, "prompt", 1, "a"), turn(2, "prompt", 2, "bye"),
        turn(2, "chosen", 3, "b", True), turn(2, "rejected", 3, "c", True),
        turn(3, "prompt", 0, "so"), turn(3, "chosen", 1, "c", True), turn(3, "rejected", 1, "b", True),
        # No neighbour: the answer stands alone. No answer: the sides are equal. One answer alone: no pair.
        turn(4, "prompt", 0, "alone"), turn(4, "chosen", 1, "", True),
        turn(6, "prompt", 0, ""), turn(6, "prompt", 1, "d"),
        turn(8, "prompt", 0, "same"), turn(9, "prompt", 0, "same"),
    }
    assert chat.answer_pairs(spark.createDataFrame([], schema)).count() == 0
