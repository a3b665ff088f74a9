"""Best-fit packing of documents into sequences of a fixed number of tokens.

A document is its token ids and an end id. Documents longer than a sequence are cut into pieces of full length,
the first of which may be shorter; all others are one piece. The plan is made from the histogram of piece lengths:
best fit in order of falling length, over counts instead of documents, gives a list of slots (so many pieces of one
length, so many to a sequence, from this sequence and place on). Each piece takes the slot of its rank within its
length. The plan's size depends on the sequence length alone, not on the corpus.

Defined results
* A NULL text is empty; an empty text is one piece that holds the end id.
* Ranks follow the id and the piece; rows that repeat an id are packed like any other row.
* An empty table gives an empty result. Columns other than the id and the text are never read.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.chunks import ID_BYTES, id_bytes, slices
from medallion.llm.common import stored, whole_text, worker_cache

CAPACITY = 1024
END_ID = 2
# Pieces of one length are ranked in so many groups, each by another task.
SALTS = 64
_AT_ONCE = 500
# Fixed value: how byte-level tokenizer files split text.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """Ranks of the tokens of a byte-level BPE tokenizer file, or None when its merges aren't in the order of ids."""
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    if model["type"] != "BPE" or not plain or spec["normalizer"]:
        return None
    # The alphabet of byte-level files: printable Latin-1 stands for itself, the rest follows from 256 on.
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    added = {token["content"] for token in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
    pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
    merged = [model["vocab"]["".join(pair)] for pair in pairs]
    return ranks if all(a < b for a, b in zip(merged, merged[1:])) else None


def file_encoder(path: str):
    """encode(texts) by a tokenizer file, with the ids that the tokenizers library gives.

    A byte-level BPE file is run by tiktoken over the file's own vocabulary, at four times the speed. Texts in which
    an added token is spelled out, and files of other kinds, go through tokenizers itself.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    ranks = byte_ranks(spec)
    added = [token["content"] for token in spec["added_tokens"]]
    if ranks is None:
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    encoding = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if any(token in text for token in added):
            return tokenizer.encode(text, add_special_tokens=False).ids
        return encoding.encode_ordinary(text)

    return encode


def cut(ids: bytes, capacity: int) -> list[tuple[int, bytes]]:
    """(start, ids) of the pieces, in tokens."""
    n = len(ids) // ID_BYTES
    starts = [0] if n <= capacity else [0, *range(n % capacity or capacity, n, capacity)]
    return [(a, ids[a * ID_BYTES : b * ID_BYTES]) for a, b in zip(starts, [*starts[1:], n], strict=True)]


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and the ids as little-endian 32-bit numbers if asked for."""
    if not 1 <= capacity:
        raise ValueError("a sequence holds at least one token")
    end = end_id.to_bytes(ID_BYTES, "little")

    def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_cache(f"pack:{tokenizer}", lambda: file_encoder(tokenizer))
        for batch in batches:
            for at, n in slices(batch.num_rows, _AT_ONCE):
                part = batch.slice(at, n)
                found = [
                    (row, piece, start, len(ids) // ID_BYTES, zlib.crc32(ids), ids)
                    for row, text in enumerate(part.column(1))
                    for piece, (start, ids) in enumerate(cut(id_bytes(encode(text.as_py())) + end, capacity))
                ]
                rows, *columns = zip(*found, strict=True)
                ids_of = part.column(0).take(pa.array(rows, pa.int64()))
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [ids_of, *arrays][: len(fields)], names=[field.name for field in fields]
                )

    rows = docs.select(F.col("doc_id"), whole_text().alias("text"))
    fields = [
        T.StructField("doc_id", rows.schema["doc_id"].dataType),
        T.StructField("piece", T.IntegerType()),
        *[T.StructField(name, T.LongType()) for name in ("start", "length", "ids_crc32")],
        *([T.StructField("ids", T.BinaryType())] if with_ids else []),
    ]
    return rows.mapInArrow(cut_batches, T.StructType(fields))


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, first rank, rank behind the last, pieces to a sequence, first sequence, offset).

    Sequences that have the same room left are ranges of numbers; a step fills a whole range, or as much of it as
    there are pieces. A length adds at most two ranges, so there are at most 2 * capacity, and a length uses each
    at most once: the plan is bounded by the capacity.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    slots, sequences = [], 0

    def give(left: int, first: int, n: int) -> None:
        if left and n:
            if left not in room:
                room[left] = []
                insort(rooms, left)
            room[left].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, rest = 0, counts[length]
        while rest:
            tightest = bisect_left(rooms, length)
            if tightest == len(rooms):
                new = -(-rest // (capacity // length))
                give(capacity, sequences, new)
                sequences += new
                continue
            left = rooms[tightest]
            first, n = room[left].pop()
            if not room[left]:
                del room[left], rooms[tightest]
            each = min(left // length, rest)
            filled = min(n, rest // each)
            slots.append((length, rank, rank + filled * each, each, first, capacity - left))
            give(left, first + filled, n - filled)
            give(left - each * length, first, filled)
            rank, rest = rank + filled * each, rest - filled * each
    return slots


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    salts: int = SALTS,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and the ids if asked for."""
    pieces = stored(pieces_of(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    return place(pieces, capacity, salts)


def place(pieces: DataFrame, capacity: int = CAPACITY, salts: int = SALTS) -> DataFrame:
    """Add sequence_id and offset to pieces, whose ``length`` is at most the capacity."""
    spark = pieces.sparkSession
    # Equal lengths are numbered salt by salt: a length that holds most pieces is ranked by many tasks.
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    counts = stored(pieces.groupBy("length", "salt").agg(F.count("*").alias("n")), "lengths")
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.createDataFrame(
        best_fit_plan(histogram, capacity),
        "length long, from_rank long, to_rank long, each long, first long, place long",
    )
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    in_salt = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.join(bases, ["length", "salt"]).withColumn("rank", F.col("base") + F.row_number().over(in_salt) - 1)
    at = F.col("rank") - F.col("from_rank")
    taken = ranked.join(
        F.broadcast(slots.withColumnRenamed("length", "slot_length")),
        (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank")),
    )
    return taken.select(
        *[c for c in pieces.columns if c != "salt"],
        (F.col("first") + F.floor(at / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("place") + F.pmod(at, F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences themselves, from a result with ids: sequence_id and ids. A group has at most as many
    bytes as a sequence."""
    joined = F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda piece: piece["ids"])
    # Bytes can be concatenated, but not by an aggregate: fold the sorted pieces.
    folded = F.aggregate(joined, F.lit(b""), lambda whole, ids: F.concat(whole, ids))
    return packed.groupBy("sequence_id").agg(folded.alias("ids"))
