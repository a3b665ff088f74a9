from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from medallion.llm import bpe

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ODD = ["a", "b", "é", "日", "\n", " ", "  ", "\t", "1", "'s", "'", "?!", " ", "\x1c", "\x85", "́", "😀", "ing", "the"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def transducer():
    return bpe.Transducer(bpe.read_ranks(RANKS))


def test_encoding_equals_the_library(library):
    encoder, rng = bpe.text_encoder(RANKS, PATTERN), random.Random(1)
    encoder.most = 50
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["", " ", "a" * 5000, "<|endoftext|>"]
    found = [ids for at in range(0, len(texts), 100) for ids in encoder.ids(texts[at : at + 100])]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [library.encode_ordinary(t) for t in texts]


def test_states_can_be_forgotten(library):
    small = bpe.Transducer(bpe.read_ranks(RANKS), most=5)
    for word in (" thinking", "unbelievable", " zzzzzzzz", "日本語"):
        assert small.encode(word.encode()) == library.encode_ordinary(word)


def test_every_token_encodes_to_itself(transducer):
    assert all(transducer.merged(token) == [rank] for token, rank in list(transducer.ranks.items())[::7])


def test_stable_pairs_by_definition(transducer):
    rng, ranks = random.Random(2), list(transducer.tokens)
    for _ in range(3000):
        a, b = rng.choice(ranks[:3000]), rng.choice(ranks)
        assert transducer.stable(a, b) == (transducer.merged(transducer.tokens[a] + transducer.tokens[b]) == [a, b])


def test_utf8_parts_are_held_back():
    rng = random.Random(3)
    for _ in range(3000):
        data = bytes(rng.choice([0x41, 0xC3, 0xA9, 0xE0, 0xA0, 0x80, 0xF0, 0x9F, 0x98, 0xED, 0xF4, 0x8F, 0xFF]) for _ in range(12))
        cut = rng.randint(0, 12)
        stream = bpe.Utf8Stream()
        assert stream.feed(data[:cut]) + stream.feed(data[cut:]) + stream.finish() == data.decode("utf-8", "replace")


def test_round_trip(spark, library):
    texts = {1: None, 2: "", 3: "éa 日本 😀 " * 3000, 4: " \n  x", None: "no id"}
    docs = spark.createDataFrame([(k, t, "clash") for k, t in texts.items()], "doc_id long, text string, ids string")
    rows = bpe.round_trip(docs.unionByName(docs), RANKS, PATTERN).collect()
    assert len(rows) == 2 * len(texts)
    for row in rows:
        text = texts[row["doc_id"]] or ""
        ids = library.encode_ordinary(text)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.round_trip(docs.limit(0), RANKS, PATTERN).count() == 0
