from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from medallion.llm import packing

FILE = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a", "b", "e", "é", "日", "\n", " ", "  ", "\t", "1", "23", "'s", "'", "!", "?!", " ", "\x1c", "\x85", "😀", "ing"]


def ids_of(text):
    return Tokenizer.from_file(FILE).encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def check_packing(rows, texts, capacity=packing.CAPACITY):
    """Every piece against the tokenizer, every sequence gapless; sequences as a multiple of the fewest possible."""
    tokenizer, pieces, places, total = Tokenizer.from_file(FILE), defaultdict(list), defaultdict(list), 0
    for row in rows:
        pieces[row["doc_id"]].append(row)
        places[row["sequence_id"]].append((row["offset"], row["length"]))
    assert set(pieces) == set(texts)
    for doc_id, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        start, total = 0, total + len(ids)
        for number, row in enumerate(sorted(pieces[doc_id], key=lambda r: r["piece"])):
            part = ids[start : start + row["length"]]
            assert (row["piece"], row["start"]) == (number, start)
            assert row["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            assert row["length"] == capacity or number == 0
            start += row["length"]
        assert start == len(ids)
    for places_of in places.values():
        end = 0
        for offset, length in sorted(places_of):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places) / -(-total // capacity)


def test_edge_cases(spark):
    texts = {1: None, 2: "", 3: "word " * 5000, 4: "a", 5: "\n \n", None: "no id", 7: "x<|endoftext|> y"}
    rows = [(k, t, "clash", 1) for k, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string, salt int")
    assert check_packing(packing.pack(docs, FILE, capacity=64).collect(), texts, 64) < 1.2
    assert packing.pack(docs.limit(0), FILE).count() == 0
    assert packing.pack(docs.unionByName(docs), FILE).count() == 2 * packing.pack(docs, FILE).count()


def test_sequences_hold_all_ids(spark):
    docs = spark.createDataFrame([(k, "some words " * k) for k in range(1, 60)], "doc_id long, text string")
    packed = packing.pack(docs, FILE, capacity=32, with_ids=True)
    whole = packing.sequences(packed).collect()
    got = sorted(np.frombuffer(b"".join(bytes(r["ids"]) for r in whole), "<u4").tolist())
    assert got == sorted(i for k in range(1, 60) for i in ids_of("some words " * k))
    assert max(len(r["ids"]) for r in whole) <= 32 * 4


def test_encoder_equals_the_library():
    encode, tokenizer = packing.file_encoder(FILE), Tokenizer.from_file(FILE)
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice([*ODD, "<|endoftext|>"]) for _ in range(rng.randint(0, 25)))
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [1, 7, 64, 1024])
def test_plan_places_every_piece_once(capacity):
    rng = random.Random(capacity)
    counts = {length: rng.randint(1, 300) for length in range(1, capacity + 1)}
    slots, used, filled = packing.best_fit_plan(counts, capacity), set(), 0
    assert len(slots) <= 4 * capacity + 4
    ranks = defaultdict(list)
    for length, low, high, each, first, place in slots:
        ranks[length].append((low, high))
        for rank in range(high - low):
            sequence, offset = first + rank // each, place + rank % each * length
            for token in range(offset, offset + length):
                assert token < capacity and (sequence, token) not in used
                used.add((sequence, token))
            filled = max(filled, sequence + 1)
    for length, spans in ranks.items():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] == counts[length]
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert filled <= 1.25 * -(-sum(k * n for k, n in counts.items()) // capacity)


def test_pieces_are_cut_from_the_end():
    whole = bytes(range(40))
    assert [(start, len(ids) // 4) for start, ids in packing.cut(whole, 4)] == [(0, 2), (2, 4), (6, 4)]
    assert [(start, len(ids) // 4) for start, ids in packing.cut(whole, 5)] == [(0, 5), (5, 5)]
    assert [(start, len(ids) // 4) for start, ids in packing.cut(whole, 10)] == [(0, 10)]


def test_pipeline_stage_holds_the_ids(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "some words to pack"), (2, "others")], "doc_id long, text string")
    packed = corpus_pipeline.best_fit_packing(spark, docs, "").collect()
    # Ids are little-endian 32-bit numbers; the last one is the end id.
    found = {r["doc_id"]: [int.from_bytes(r["ids"][k : k + 4], "little") for k in range(0, len(r["ids"]), 4)] for r in packed}
    assert found == {1: ids_of("some words to pack"), 2: ids_of("others")}
