"""SimHash near-deduplication.

A fingerprint has 64 bits; a bit is set when it is set in over half the XXH64 hashes of the document's word shingles,
repeats included. Fingerprints link when few bits differ, and links join documents into groups.

Links are found by multi-index hashing over different fingerprints. A fingerprint has two segments of 32 bits, each
with a table. When at most r bits differ, then at most r // 2 differ in the first segment, or at most r - 1 - r // 2
in the second. So all segment values within these small Hamming balls are looked up, and the matches are verified
over all bits. A ball is enumerated from one side of each possible pair only.

A segment value that very many different fingerprints share would give matches in the square of their number.
Fingerprints that look up such a value are linked exactly by another way: each is filed under every 64-bit value
within r / 2 bits of it. Two within r bits share such a value, and any two that share one are within r bits, so
linking all under a value to the smallest of them loses nothing. A value has at most as many as the ball is large.

Defined results
* A text without words, or NULL, has the fingerprint 0, which links like any other.
* ``component_id`` is the smallest id reachable, NULL ids left aside; it is NULL where there is none.
* Rows that repeat an id or a text share fingerprint and group. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.chunks import slices
from medallion.llm.common import stored, whole_text
from medallion.llm.components import components
from medallion.llm.exact import first_rows, numbered, only_rows

WORDS = 3
MAX_BITS = 2
SEED = 42
BITS, SEGMENT = 64, 32
# Segment values with more fingerprints than this are linked by whole balls.
CROWD = 64
_AT_ONCE = 500
_HASHES_AT_ONCE = 65_536


def fingerprint(text: bytes, words: int = WORDS) -> int:
    import numpy as np
    import xxhash

    found = text.lower().split()  # on bytes: A-Z and ASCII white space only
    if not found:
        return 0
    joined, width = b" ".join(found), min(words, len(found))
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = [0, *(ends[: len(found) - width] + 1).tolist()]
    ends = ends[width - 1 :].tolist()
    digest, n, counts = xxhash.xxh64_intdigest, len(ends), np.zeros(BITS, np.int64)
    for at, size in slices(n, _HASHES_AT_ONCE):
        spans = zip(starts[at : at + size], ends[at : at + size], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and fingerprint (a signed long of the same bits) of every whole text."""
    rows = docs.select(F.col("doc_id"), whole_text().cast("binary").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("fingerprint", T.LongType())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in slices(batch.num_rows, _AT_ONCE):
                part = batch.slice(at, n)
                marks = [fingerprint(text.as_py(), words) for text in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(marks, pa.int64())], names=schema.names)

    return rows.mapInArrow(mark, schema)


def ball(radius: int, bits: int) -> list[int]:
    """Masks of at most ``radius`` of ``bits`` bits, as signed longs."""
    masks = [sum(1 << bit for bit in chosen) for n in range(radius + 1) for chosen in combinations(range(bits), n)]
    return [mask - (1 << BITS) if mask >> (BITS - 1) else mask for mask in masks]


def longs(values: list[int]) -> Column:
    return F.array(*[F.lit(value).cast("long") for value in values])


def bits_apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def segment_links(marks: DataFrame, max_bits: int, crowd: int) -> DataFrame:
    """(a, b): the pairs of different ``marks`` (mark) that link, crowded ones by way of one of them."""
    if not 0 <= max_bits <= 3:
        raise ValueError("0 to 3 differing bits are supported")
    if max_bits == 0:
        return marks.select(F.col("mark").alias("a"), F.col("mark").alias("b")).limit(0)
    mark = F.col("mark")
    segments = (F.shiftrightunsigned(mark, SEGMENT), mark.bitwiseAND(F.lit((1 << SEGMENT) - 1)))
    radii = (max_bits // 2, max_bits - 1 - max_bits // 2)

    def looked_up(number: int) -> Column:
        segment, masks = segments[number], longs(ball(radii[number], SEGMENT))
        # Of a pair that a mask sets apart, the side without the mask's lowest bit looks the other one up.
        ours = F.filter(masks, lambda m: m.bitwiseAND(F.negate(m)).bitwiseAND(segment) == 0)
        return F.transform(
            ours,
            lambda m: F.struct(
                F.lit(number).alias("segment"), segment.bitwiseXOR(m).alias("value"), (m == 0).alias("same")
            ),
        )

    wanted = F.concat(*[looked_up(k) for k in range(2) if radii[k] >= 0])
    filed = F.array(*[F.struct(F.lit(k).alias("segment"), segments[k].alias("value")) for k in range(2)])
    probes = marks.select(F.explode(wanted).alias("p"), mark.alias("a")).select("p.*", "a")
    table = marks.select(F.explode(filed).alias("p"), mark.alias("b")).select("p.*", "b")
    crowded = stored(table.groupBy("segment", "value").agg(F.count("*").alias("n")).where(F.col("n") > crowd).drop("n"), "crowded")

    met = probes.join(table.join(crowded, ["segment", "value"], "left_anti"), ["segment", "value"])
    pairs = met.where((bits_apart("a", "b") <= max_bits) & (~F.col("same") | (F.col("a") < F.col("b")))).select("a", "b")
    if crowded.isEmpty():
        return pairs
    return pairs.unionByName(ball_links(probes.join(crowded, ["segment", "value"], "left_semi").select(F.col("a").alias("mark")).distinct(), max_bits))


def ball_links(marks: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): each mark with the smallest under each of the values that it is filed under."""
    around = F.transform(longs(ball(max_bits // 2, BITS)), lambda m: F.col("mark").bitwiseXOR(m))
    if max_bits % 2:  # one bit more may differ: it is left out of the value, each bit in turn
        without = longs([~(bit - (1 << BITS) if bit >> (BITS - 1) else bit) for bit in (1 << k for k in range(BITS))])
        around = F.flatten(
            F.transform(without, lambda kept: F.transform(around, lambda v: F.struct(kept.alias("kept"), v.bitwiseAND(kept).alias("v"))))
        )
    filed = marks.select("mark", F.explode(F.array_distinct(around)).alias("value"))
    together = filed.groupBy("value").agg(F.collect_list("mark").alias("marks")).where(F.size("marks") > 1)
    return together.select(F.explode("marks").alias("a"), F.array_min("marks").alias("b")).where("a <> b")


def simhash_groups(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, crowd: int = CROWD) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits) and component_id."""
    marked = stored(fingerprints(docs, words), "fingerprints")
    classes = stored(
        marked.groupBy(F.col("fingerprint").alias("mark")).agg(F.min("doc_id").alias("first")), "fingerprint-classes"
    )
    roots = components(segment_links(classes.select("mark"), max_bits, crowd))
    rooted = classes.join(roots, classes["mark"] == roots["node"], "left").select(
        "mark", "first", F.coalesce("root", "mark").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = rooted.join(smallest, "root").select(F.col("mark").alias("fingerprint"), "component_id")
    return marked.join(labels, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), BITS // 4, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_per_group(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` without the rows that are near copies of a row with a smaller id; its columns as they are. An id of
    which any row stays keeps all its rows, and rows without an id stay."""
    groups = simhash_groups(docs, words, max_bits).where("doc_id IS NOT NULL")
    stays = F.max((F.col("doc_id") == F.col("component_id")).cast("int"))
    dropped = groups.groupBy(F.col("doc_id").alias("id")).agg(stays.alias("stays")).where("stays = 0").select("id")
    whole = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"))
    return whole.join(dropped, "id", "left_anti").select("doc.*")


def one_row_of_each_group(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of every group of near copies, its columns as they are: the one with the smallest id. NULL ids come last;
    of rows that share an id, or have none, the one first stored stays."""
    rows = numbered(docs, "simhash-rows")
    # Rows take the place of ids here: each has a group of its own.
    marked = stored(fingerprints(rows.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text")), words), "row-fingerprints")
    classes = marked.select(F.col("fingerprint").alias("mark")).distinct()
    roots = components(segment_links(stored(classes, "marks"), max_bits, CROWD))
    ids = rows.select("row", F.col("doc.doc_id").alias("id"))
    grouped = marked.select(F.col("doc_id").alias("row"), "fingerprint").join(
        roots.select(F.col("node").alias("fingerprint"), "root"), "fingerprint", "left"
    )
    marks = grouped.select("row", F.coalesce("root", "fingerprint").alias("key")).join(ids, "row")
    return only_rows(rows, first_rows(marks))
