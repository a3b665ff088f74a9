"""The prefix trie against a trie of nested dictionaries, in many blocks and rounds."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from medallion.llm import trie

SCHEMA = "conv_id long, turn int, role string, text string, name string"


def brute(rows):
    """Nodes by the contract: rows of (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        role, text = role or "", text or ""
        name = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, name, (role, text)))
    turns = {conv: [at[-1] for at in sorted(own)] for conv, own in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for conv, own in turns.items():
        taken = zlib.crc32(str(conv).encode()) % 9
        rebuilt = tuple(turns.get(conv - conv % 5, [])[:taken] + own[taken:])
        for depth in range(len(rebuilt) + 1):
            members[rebuilt[:depth]].append(conv)
        ends[rebuilt].append(conv)
    children, leaves, saved = Counter(), Counter(), Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += not children[node]
            saved[node[:depth]] += (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
    return Counter(
        (
            min(convs),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(convs),
            children[node],
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        )
        for node, convs in members.items()
    )


def found(spark, rows, fan=trie.FAN):
    frame = spark.createDataFrame([(*row, "clash") for row in rows], SCHEMA)
    return Counter(tuple(row) for row in trie.prefix_trie(trie.regrouped(trie.turn_lists(frame)), fan).collect())


def conversations(seed, n, words, most):
    draw = random.Random(seed)
    rows = []
    for conv in draw.sample(range(4 * n), n):
        rows += [(conv, turn, draw.choice(["user", None]), draw.choice(words)) for turn in range(draw.randint(1, most))]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "n", "most", "fan", "partitions"), [(1, 60, 4, 32, 1), (2, 150, 12, 2, 13), (3, 80, 30, 3, 7), (4, 200, 3, 2, 24)])
def test_against_brute_force(spark, seed, n, most, fan, partitions):
    rows = conversations(seed, n, ["", "a", "é" * 3, None], most)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(spark, rows, fan) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_copies_over_many_blocks(spark):
    rows = [(conv, turn, "user", "same") for conv in range(0, 4_000, 5) for turn in range(3)]
    rows += [(conv, 0, "user", "same") for conv in range(1, 900, 5)] + [(7, turn, "user", f"long {turn}") for turn in range(700)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(spark, rows, 2) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_edge_cases(spark):
    assert not found(spark, [])
    rows = [
        (None, 0, "user", "no conversation"),
        (5, None, None, None),
        (5, 1, "user", "x"),
        (5, 1, "user", "x"),
        (5, 1, "assistant", "tie"),
        (6, None, "", ""),
        (-7, 0, "user", "y" * 200_000),
        (9_223_372_036_854_775_807, 0, "user", "x"),
        (-9_223_372_036_854_775_808, 0, "user", ""),
    ]
    assert found(spark, rows) == brute(rows)


def test_ends_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 3)
    rows = [(conv, 0, "user", "one") for conv in range(40)]
    assert found(spark, rows, 2) == brute(rows)
