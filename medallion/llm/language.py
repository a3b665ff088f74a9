"""Language identification by language-bitmask n-gram filters.

A filter is one table of bit masks, a bit for each language: Bloom filters of all languages, sliced by slot. Looking
an n-gram up in each of its slots and combining the masks by AND gives all languages that contain it. The bits of a
text's masks are counted by language, and each count is corrected for the share of false positives of that
language's filter. The language with the highest corrected count is predicted; the score is that count as a share
of the text's n-grams.

n-grams are four code points of the lower-cased text, in which every character that is no letter counts as a blank;
n-grams without a letter are left out. A language contains an n-gram when it is at least ``MIN_SHARE`` as frequent
there as in the language where it is most frequent, so that words of one language inside texts of another do no harm.

The filters are fitted on a bounded sample of labelled rows, at most about ``SAMPLE`` of each language, chosen by a
hash of the id. Prediction reads whole texts, and nothing but the text.

Defined results
* A text that is NULL or has no letter is ``und`` with score 0; so is any text if no language has been learned.
* Ties go to the language with more labelled rows, then to the smaller name; that also decides for texts of which
  no language contains any n-gram.
* Rows with a NULL id or language are predicted, never learned from. Rows are judged one by one, so repeated rows
  get the same result. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.chunks import slices
from medallion.llm.common import worker_cache

UNKNOWN = "und"
SAMPLE = 2_000
GRAM = 4
MIN_COUNT = 3
MIN_SHARE = 0.2
SLOTS_PER_GRAM = 12
HASHES = 2
PLANE_BITS = 64
# The pipeline drops texts below this score: no learned language explains a quarter of their n-grams.
MIN_SCORE = 0.25
_AT_ONCE = 500
_BASE = 0x9E3779B97F4A7C15
_MIXES = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def letter_table() -> Any:
    import numpy as np

    return np.fromiter((chr(code).isalpha() for code in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> Any:
    """64-bit hashes of the text's n-grams, in order."""
    import numpy as np

    letters = worker_cache("letters", letter_table)
    codes = np.frombuffer(f" {text or ''} ".lower().ljust(GRAM).encode("utf-32-le", "replace"), "<u4")
    known = letters[codes]
    if not known.any():
        return np.zeros(0, np.uint64)
    codes = np.where(known, codes, 0x20).astype(np.uint64)
    n = len(codes) - GRAM + 1
    with np.errstate(over="ignore"):
        found = np.zeros(n, np.uint64)
        counted = np.zeros(n, bool)
        for k in range(GRAM):
            found *= np.uint64(_BASE)
            found += codes[k : k + n]
            counted |= known[k : k + n]
        found ^= found >> np.uint64(31)
        found *= np.uint64(_MIXES[0])
    return found[counted]


def slots_of(hashes: Any, bits: int) -> list[Any]:
    import numpy as np

    with np.errstate(over="ignore"):
        return [((hashes ^ np.uint64(k)) * np.uint64(_MIXES[k % 2] + 2 * k)) >> np.uint64(64 - bits) for k in range(HASHES)]


@dataclass
class Filters:
    """``planes`` has a table for each 64 languages; ``false_share`` the false positives of each language."""

    languages: list[str]
    bits: int
    planes: list[Any]
    false_share: list[float]

    def predict(self, text: str | None) -> tuple[str, float]:
        import numpy as np

        hashes = grams(text)
        if not len(hashes) or not self.languages:
            return UNKNOWN, 0.0
        slots, best, most = slots_of(hashes, self.bits), 0, -1.0
        for number, plane in enumerate(self.planes):
            masks = plane[slots[0]]
            for slot in slots[1:]:
                masks = masks & plane[slot]
            first = number * PLANE_BITS
            for k in range(first, min(first + PLANE_BITS, len(self.languages))):
                seen = np.count_nonzero(masks & plane.dtype.type(1 << (k - first)))
                share = self.false_share[k]
                count = max(0.0, (seen - share * len(hashes)) / (1 - share))
                if count > most:
                    best, most = k, count
        return self.languages[best], min(1.0, most / len(hashes))


def build(languages: list[str], contents: list[Any]) -> Filters:
    """Filters of the languages, in order of preference, from the n-gram hashes that each contains."""
    import numpy as np

    largest = max([1, *map(len, contents)])
    bits = max(10, (largest * SLOTS_PER_GRAM - 1).bit_length())
    planes, false_share = [], []
    for first in range(0, len(languages), PLANE_BITS):
        part = contents[first : first + PLANE_BITS]
        plane = np.zeros(1 << bits, np.min_scalar_type((1 << len(part)) - 1))
        for k, hashes in enumerate(part):
            bit = plane.dtype.type(1 << k)
            for slot in slots_of(np.asarray(hashes, np.uint64), bits):
                plane[slot] |= bit
            false_share.append(float((np.count_nonzero(plane & bit) / len(plane)) ** HASHES))
        planes.append(plane)
    return Filters(languages, bits, planes, false_share)


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) of ``labelled`` (text, lang), summed within each batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            by_language: dict[str, list[Any]] = {}
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                by_language.setdefault(lang, []).append(grams(text.as_py()))
            for lang, found in by_language.items():
                values, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(values), pa.string()), pa.array(values.view("i8")), pa.array(n.astype("i8"))],
                    names=["lang", "gram", "n"],
                )

    counted = labelled.select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Filters:
    """Filters from ``labelled`` (doc_id, text, lang). The driver gets the labels with their row counts and the
    n-grams of the sample, whose number is bounded by the sample's size."""
    rows = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(rows, key=lambda lang: (-rows[lang], lang))
    if not languages:
        return build([], [])
    parts = 1_000_000
    share = F.element_at(
        F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(parts, -(-sample * parts // rows[lang])))]), F.col("lang")
    )
    # By id and text: rows that share an id are not all chosen or all left out.
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)) < share)
    counts = gram_counts(chosen)
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = counts.where(F.col("n") >= MIN_COUNT).join(F.broadcast(total), "lang")
    shares = shares.select("lang", "gram", (F.col("n") / F.col("total")).alias("share"))
    top = shares.groupBy("gram").agg(F.max("share").alias("top"))
    held = shares.join(top, "gram").where(F.col("share") >= MIN_SHARE * F.col("top")).select("lang", "gram").toArrow()
    import numpy as np

    names, values = np.array(held.column("lang").to_pylist(), object), held.column("gram").to_numpy().view("u8")
    return build(languages, [values[names == lang] for lang in languages])


def held_out(doc_id: Column) -> Column:
    """A third of the ids, that nothing is learned from. A NULL id is in neither part."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def learn_from(docs: DataFrame, sample: int = SAMPLE) -> Filters:
    labelled = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    return fit(labelled.select("doc_id", "text", "lang"), sample)


def predicted(docs: DataFrame, filters: Filters) -> DataFrame:
    """The columns of ``docs`` in one struct ``doc``, lang_pred and score."""
    rows = docs.select(F.struct("*").alias("doc"), F.col("text").cast("string").alias("text"))
    schema = T.StructType(
        [rows.schema["doc"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in slices(batch.num_rows, _AT_ONCE):
                part = batch.slice(at, n)
                names, scores = zip(*[filters.predict(text.as_py()) for text in part.column(1)], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=schema.names
                )

    return rows.mapInArrow(judge, schema)


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score."""
    rows = predicted(docs.select("doc_id", "text"), learn_from(docs, sample))
    return rows.select("doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "lang_pred", "score")


def keep_known_languages(docs: DataFrame, min_score: float = MIN_SCORE, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the rows that are ``und`` or score below ``min_score``; their columns as they are."""
    rows = predicted(docs, learn_from(docs, sample))
    return rows.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select("doc.*")
