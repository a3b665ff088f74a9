from __future__ import annotations

import random
import re

import pytest
import xxhash

from medallion.llm import simhash
from medallion.llm.components import components


def brute_fingerprint(text, words=3):
    lower = (text or "").translate({code: code + 32 for code in range(65, 91)})
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not found:
        return 0
    shingles = [" ".join(found[k : k + words]) for k in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(marks, max_bits):
    """{id: smallest id reachable}"""
    root = {k: k for k in marks}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    ids = sorted(marks)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (marks[a] ^ marks[b]).bit_count() <= max_bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in ids}


def test_fingerprints(spark):
    texts = ["", None, "One", "One two", "One TWO three four", "é\x0bÀ b c d", "w " * 70_000, "a b c a b c a b c"]
    rows = [(k, t, "clash") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    found = {r["doc_id"]: r["fingerprint"] for r in simhash.fingerprints(docs).collect()}
    assert {k: v % (1 << 64) for k, v in found.items()} == {k: brute_fingerprint(t) for k, t in enumerate(texts)}


def crowd_of_marks(n):
    rng = random.Random(n)
    centres = [rng.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    marks = set(centres)
    while len(marks) < n:
        mark = rng.choice(centres if rng.random() < 0.5 else sorted(marks)[:60])
        for _ in range(rng.randint(1, 3)):
            mark ^= 1 << rng.choice([0, 1, 5, 31, 32, 40, 62, 63, rng.randrange(64)])
        marks.add(mark)
    return dict(enumerate(sorted(marks, key=lambda m: hash((m, 1)))))


@pytest.mark.parametrize("max_bits,crowd", [(0, 64), (1, 64), (2, 64), (2, 2), (2, 0), (3, 64), (1, 1)])
def test_links_lose_nothing(spark, max_bits, crowd):
    marks = crowd_of_marks(300 if max_bits < 3 else 120)
    signed = [(m - (1 << 64) if m >> 63 else m,) for m in marks.values()]
    links = simhash.segment_links(spark.createDataFrame(signed, "mark long"), max_bits, crowd)
    for a, b in links.collect():
        assert 0 < ((a ^ b) % (1 << 64)).bit_count() <= max_bits
    roots = {r["node"] % (1 << 64): r["root"] for r in components(links).collect()}
    expected = brute_components(marks, max_bits)
    groups = {}
    for k, mark in marks.items():
        groups.setdefault(roots.get(mark, ("alone", mark)), set()).add(expected[k])
    assert all(len(group) == 1 for group in groups.values()) and len(groups) == len(set(expected.values()))


def test_groups(spark):
    rng = random.Random(5)
    words = [f"word{k}" for k in range(400)]
    base = [rng.choice(words) for _ in range(900)]
    texts = {}
    for k in range(40):
        copy = list(base) if k % 2 else [rng.choice(words) for _ in range(300)]
        if k % 2:
            copy[rng.randrange(len(copy))] = "changed"
        texts[k] = " ".join(copy)
    texts |= {90: None, 91: "", 92: " \t"}
    docs = spark.createDataFrame([(k, t, "x") for k, t in texts.items()] + [(None, None, "x")], "doc_id long, text string, root string")
    expected = brute_components({k: brute_fingerprint(t) for k, t in texts.items()}, 2)
    found = {r["doc_id"]: r["component_id"] for r in simhash.simhash_groups(docs).collect()}
    assert found.pop(None) == 90 and found == expected
    assert len(set(expected.values())) < len(texts) - 5
    stay = {r["doc_id"] for r in simhash.keep_one_per_group(docs).collect()}
    assert stay == {k for k in texts if expected[k] == k} | {None}
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    links = [(k, k + 1) for k in range(200)] + [(1000, 1001), (1001, 1000), (5, 5)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({found[k] for k in range(201)}) == 1 and found[1000] == found[1001] != found[0]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_row_of_a_group_stays(spark):
    rows = [(None, "one two three four"), (3, "one two three four"), (3, "one two three four"), (None, "x y z"), (None, "X Y z"), (9, "quite another text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.one_row_of_each_group(docs).collect()
    assert sorted((r["doc_id"] or 0, r["text"].lower()) for r in kept) == [(0, "x y z"), (3, "one two three four"), (9, "quite another text")]
