"""Substring deduplication: passages of a fixed number of words that an earlier document has, too, are removed.

Every window of that many words has a Rabin-Karp hash, from prefix sums of a polynomial over word hashes. A window's
anchor is the smallest hash of the windows of a fifth of its length inside it, so equal windows have equal anchors,
and neighbours mostly share theirs: consecutive windows with one anchor are a run. Spark counts in two steps.

* Runs are grouped by anchor and content. All but the smallest document of a group have every window of the run in a
  smaller document: these runs go whole.
* Where an anchor has runs of different content, their windows may still agree in part. For the smallest document of
  each such group the windows themselves are grouped by hash, and those that start in a smaller document go.

So windows are shuffled only around passages that do repeat, and a passage that a third of all documents share is
merged to one row a task before the shuffle. Overlapping windows merge into maximal intervals, judged on the input.
Content is compared by 96 bits of hash.

Defined results
* A NULL text has no words. Texts shorter than a window lose nothing. White space is ASCII white space.
* Only a smaller id makes a window go; repeats inside a document, and in rows with the same id, stay. Rows with a
  NULL id are neither smaller nor larger than others: they lose nothing and make nothing go.
* An empty table gives an empty result. Columns other than the id and the text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.chunks import slices
from medallion.llm.common import BLANKS, stored, whole_text

WINDOW = 50
ANCHOR_PARTS = 5
_AT_ONCE = 500
# Odd multipliers of the polynomials modulo 2 ** 64.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_MIX = 0xFF51AFD7ED558CCD


def word_hashes(texts: list[list[bytes]]) -> list[Any]:
    """Two 64-bit hashes of each word of each text, as arrays of two columns."""
    import numpy as np
    import xxhash

    numbers: dict[bytes, int] = {}
    codes = [np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), np.int64, len(words)) for words in texts]
    table = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, numbers)), "<u8").reshape(-1, 2)
    return [table[code] if len(code) else np.zeros((0, 2), np.uint64) for code in codes]


class Rolling:
    """Rabin-Karp hashes of any spans of one text's words."""

    def __init__(self, words: Any) -> None:
        import numpy as np

        self.prefixes, self.inverses = [], []
        with np.errstate(over="ignore"):
            for column, base in enumerate(_BASES):
                n = len(words) + 1
                powers = np.full(n, base, np.uint64)
                powers[0] = 1
                powers = np.cumprod(powers, dtype=np.uint64)
                inverse = np.full(n, pow(base, -1, 1 << 64), np.uint64)
                inverse[0] = 1
                sums = np.zeros(n, np.uint64)
                np.cumsum(words[:, column] * powers[:-1], out=sums[1:])
                self.prefixes.append(sums)
                self.inverses.append(np.cumprod(inverse, dtype=np.uint64))

    def hashes(self, starts: Any, ends: Any, column: int = 0) -> Any:
        import numpy as np

        sums = self.prefixes[column]
        with np.errstate(over="ignore"):
            found = (sums[ends] - sums[starts]) * self.inverses[column][starts]
            found ^= found >> np.uint64(32)
            found *= np.uint64(_MIX)
            found ^= found >> np.uint64(29)
        return found


def smallest_of(values: Any, width: int) -> Any:
    """The smallest of each ``width`` consecutive values."""
    import numpy as np

    span, found = 1, values
    while 2 * span <= width:
        found = np.minimum(found[:-span], found[span:])
        span *= 2
    rest = width - span
    return np.minimum(found[: len(found) - rest], found[rest:]) if rest else found


def runs_of(words: Any, window: int) -> tuple[Any, Any, Any, Any, Any]:
    """(anchor, content, check, start, windows) of the runs of one text."""
    import numpy as np

    rolling, short, n = Rolling(words), max(1, window // ANCHOR_PARTS), len(words)
    at = np.arange(n - short + 1)
    anchors = smallest_of(rolling.hashes(at, at + short), window - short + 1)
    starts = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
    counts = np.diff(np.r_[starts, len(anchors)])
    ends = starts + counts - 1 + window
    content, check = (rolling.hashes(starts, ends, column) for column in (0, 1))
    return anchors[starts].view("i8"), content.view("i8"), check.astype("u4").view("i4"), starts, counts


def split_texts(part: pa.RecordBatch, column: str) -> list[list[bytes]]:
    texts = part.column(part.schema.get_field_index(column)).cast(pa.binary())
    return [(text or b"").split() for text in texts.to_pylist()]


def run_rows(docs: DataFrame, window: int) -> DataFrame:
    """The runs of all texts: anchor, content, check, doc_id, body, start, windows."""
    fields = "anchor long, content long, check int, start int, windows int"
    schema = T.StructType([*docs.select("doc_id", "body").schema.fields, *T._parse_datatype_string(fields).fields])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for at, n in slices(batch.num_rows, _AT_ONCE):
                part = batch.slice(at, n)
                hashed = word_hashes(split_texts(part, "text"))
                long = [k for k, words in enumerate(hashed) if len(words) >= window]
                if not long:
                    continue
                found = [runs_of(hashed[k], window) for k in long]
                rows = pa.array(np.repeat(long, [len(runs[0]) for runs in found]))
                columns = [np.concatenate(column) for column in zip(*found, strict=True)]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(rows),
                        part.column(1).take(rows),
                        *[pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(columns, kinds, strict=True)],
                    ],
                    names=schema.names,
                )

    return docs.where("doc_id IS NOT NULL").mapInArrow(find, schema)


def window_rows(docs: DataFrame, window: int) -> DataFrame:
    """The windows of the runs in the column ``runs``: value, check, doc_id, body, start."""
    fields = "value long, check int, start int"
    schema = T.StructType([*docs.select("doc_id", "body").schema.fields, *T._parse_datatype_string(fields).fields])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for at, n in slices(batch.num_rows, _AT_ONCE):
                part = batch.slice(at, n)
                hashed = word_hashes(split_texts(part, "text"))
                for row, runs in enumerate(part.column(part.schema.get_field_index("runs")).to_pylist()):
                    if not runs:
                        continue
                    starts = np.concatenate([np.arange(r["start"], r["start"] + r["windows"]) for r in runs])
                    rolling = Rolling(hashed[row])
                    same = pa.array(np.full(len(starts), row))
                    values = rolling.hashes(starts, starts + window).view("i8")
                    checks = rolling.hashes(starts, starts + window, 1).astype("u4").view("i4")
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).take(same),
                            part.column(1).take(same),
                            pa.array(values),
                            pa.array(checks),
                            pa.array(starts.astype("i4")),
                        ],
                        names=schema.names,
                    )

    return docs.mapInArrow(find, schema)


def repeated_intervals(docs: DataFrame, window: int) -> DataFrame:
    """doc_id, body and the intervals (from, to; in words) of what goes; they may overlap. ``docs`` has doc_id, body
    and text."""
    key, doc = ["anchor", "content", "check"], ["doc_id", "body"]
    runs = stored(run_rows(docs, window), "runs")
    # One row per content, and how many contents the anchor has: from rows that are merged before each shuffle.
    groups = runs.groupBy(*key).agg(F.min("doc_id").alias("smallest"), F.max("doc_id").alias("largest"))
    several = groups.groupBy("anchor").agg(F.count("*").alias("contents"), F.min("smallest").alias("s"), F.max("largest").alias("l"))
    several = several.where("s < l").select("anchor", "contents")
    groups = groups.drop("largest").join(several, "anchor")
    met = stored(runs.join(groups, key).select(*doc, "start", "windows", "contents", "smallest"), "repeated-runs")

    whole = met.where("doc_id > smallest").select(
        *doc, F.struct(F.col("start").alias("from"), (F.col("start") + F.col("windows") - 1 + window).alias("to")).alias("gone")
    )
    asked = (
        met.where("doc_id = smallest AND contents > 1")
        .groupBy(*doc)
        .agg(F.collect_list(F.struct("start", "windows")).alias("runs"))
    )
    # A left join, as in the last step: all of them read the one shuffle of the texts. Texts without runs stay behind.
    wanted = docs.join(asked, doc, "left").withColumn("text", F.when(F.col("runs").isNotNull(), F.col("text")))
    windows = window_rows(wanted, window)
    first = windows.groupBy("value", "check").agg(F.min("doc_id").alias("smallest"), F.max("doc_id").alias("largest"))
    later = windows.join(first.where("smallest < largest").drop("largest"), ["value", "check"]).where("doc_id > smallest")
    parts = later.select(*doc, F.struct(F.col("start").alias("from"), (F.col("start") + window).alias("to")).alias("gone"))
    return whole.unionByName(parts)


def drop_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, the kept words joined by single spaces, and the
    maximal intervals (from, to; in words) that were removed."""
    texts = docs.select("doc_id", F.hash(whole_text()).alias("body"), whole_text().alias("text"))
    gone = repeated_intervals(texts, window).groupBy("doc_id", "body").agg(F.collect_list("gone").alias("gone"))
    fields = [
        texts.schema["doc_id"],
        *T._parse_datatype_string("n_words long, n_removed long, kept_text string, removed array<struct<from:int,to:int>>").fields,
    ]
    schema = T.StructType(fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
        for batch in batches:
            for at, n in slices(batch.num_rows, _AT_ONCE):
                part = batch.slice(at, n)
                counts, removed, kept, cuts = [], [], [], []
                found = part.column(part.schema.get_field_index("gone")).to_pylist()
                for words, gaps in zip(split_texts(part, "text"), found, strict=True):
                    merged = maximal([(gap["from"], gap["to"]) for gap in gaps or []])
                    counts.append(len(words))
                    removed.append(sum(to - start for start, to in merged))
                    for start, to in reversed(merged):
                        del words[start:to]
                    kept.append(b" ".join(words))
                    cuts.append([{"from": start, "to": to} for start, to in merged])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(counts, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                        pa.array(cuts, kind),
                    ],
                    names=schema.names,
                )

    return texts.join(gone, ["doc_id", "body"], "left").mapInArrow(cut, schema)


def maximal(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, to in sorted(intervals):
        if merged and start <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(merged[-1][1], to)
        else:
            merged.append((start, to))
    return merged


SUBSTRINGS_SQL = f"""
WITH texts AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{BLANKS}'), lambda w: w <> '') AS words FROM documents
), starts AS (
  SELECT doc_id, unnest(range(len(words) - {WINDOW - 1})) AS start FROM texts WHERE len(words) >= {WINDOW}
), windows AS (
  SELECT s.doc_id, s.start, md5(array_to_string(t.words[s.start + 1 : s.start + {WINDOW}], ' ')) AS body
  FROM starts s JOIN texts t ON s.doc_id = t.doc_id
), smallest AS (
  SELECT body, min(doc_id) AS doc_id FROM windows GROUP BY body
), gone AS (
  SELECT DISTINCT w.doc_id, unnest(range(w.start, w.start + {WINDOW})) AS word
  FROM windows w JOIN smallest s ON w.body = s.body WHERE w.doc_id > s.doc_id
), lists AS (
  SELECT doc_id, list(word) AS words FROM gone GROUP BY doc_id
), kept AS (
  SELECT t.doc_id, len(t.words) AS n_words, coalesce(len(l.words), 0) AS n_removed,
    CASE WHEN l.words IS NULL THEN t.words
    ELSE list_filter(t.words, lambda w, i: NOT list_contains(l.words, i - 1)) END AS words
  FROM texts t LEFT JOIN lists l ON t.doc_id = l.doc_id
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(words, ' ')) AS kept_sha256 FROM kept
"""
