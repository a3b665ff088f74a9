"""Personal data: emails, IP addresses, card numbers and phone numbers, found in whole texts and redacted.

Fixed rules find the base spans; these always stay. Generators with a high recall then propose further, overlapping
spans: written-out emails, phone numbers without a country code, cards with other separators, any dotted quads.
Boosted trees judge each candidate by its format and the words before it, and a threshold calibrated for its kind
selects those that are redacted, too, where they don't overlap a base span or a better candidate.

The trees are trained here, on the candidates of a bounded sample of texts for which there is evidence. For: a base
span of its kind, a written-out email that is a valid one when normalised, Luhn digits in a card's groups or after a
word for cards, an area code in parentheses or a word for phones before. Against: no valid form, a quad with a part over
255, digits that fail Luhn, a part of a longer number or of another kind's span, a word for other numbers before. That
no base span covers a candidate is no evidence; without any, it teaches nothing and counts in no threshold.

Thresholds cover the whole table: all candidates that the trees have not learned from are scored, and the threshold of a
kind is the lowest score from which on the share of personal data among them is at least ``MIN_PRECISION``. The sample
is at most half of the texts, so any table has such candidates. A kind with fewer than ``MIN_EXAMPLES`` examples of
personal data takes the threshold of all kinds that have any, raised until its own examples reach the precision; a kind
without any gets no added spans.

Defined results
* A NULL text is empty. Offsets count code points, ends are exclusive.
* Without a sample, or with examples of one sort only, there is no model, and base spans are the result.
* Rows are judged one by one: repeated rows get the same result, ids play no part. The sample is chosen by the text,
  and equal texts are one text of it. Other columns are kept out of sight, or kept as they are when texts are redacted.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.chunks import slices
from medallion.llm.common import stored, whole_text

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 20_000
TREES, DEPTH = 20, 3
MIN_PRECISION, MIN_EXAMPLES = 0.98, 30
_BINS = 1_000
_AT_ONCE = 500

Span = tuple[int, int]

# The forms of the base spans. No digit run is tried twice, which changes no match.
_EMAIL_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# What the generators propose: more than is personal data.
_WRITTEN_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)*"
)
_ANY_QUAD = re.compile(r"(?<![0-9.])[0-9]{1,4}(?:\.[0-9]{1,4}){3}(?![0-9.])")
_ANY_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){11,18}(?![0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20./-]?[0-9]{3,4}[\x20./-][0-9]{3,4}(?![0-9])")
# Without blanks beside a plain @ or dot, so that the next sentence is left out.
_SPELLED_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@|\x20?(?:\(at\)|\[at\])\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]++)*"
)
_GENERATORS = ((0, _WRITTEN_EMAIL), (0, _SPELLED_EMAIL), (1, _ANY_QUAD), (2, _ANY_CARD), (3, _LOCAL_PHONE))
_CUES = (
    ("mail", "contact", "write", "@"),
    ("ip", "host", "server", "address"),
    ("card", "visa", "credit", "payment"),
    ("phone", "tel", "call", "mobile", "fax"),
)
_CONTEXT = 24
_GROUPS = re.compile(r"[0-9]+")
_WRITTEN_OUT = re.compile(r"\x20?[(\[](at|dot)[)\]]\x20?")
_VALID_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")
_CARD_GROUPS = ([4, 4, 4, 4], [4, 4, 4, 4, 3], [4, 6, 5], [4, 6, 4])
_AREA_CODE = re.compile(r"\([0-9]{3}\)\x20?[0-9]{3}[.-][0-9]{4}")
_WORDS = re.compile(r"[a-z]+")
# Words before a number that is not a phone's.
_OTHER_NUMBERS = frozenset("order invoice ref reference id item part serial isbn issn version date page case ticket tracking account sku zip visa card ip".split())


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else 2 * digit - 9 * (digit > 4)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(_GROUPS.findall(text))


def emails(text: str) -> list[Span]:
    """A host is looked for first: what stands before an @ is then read backwards, up to the last match."""
    found, free = [], 0
    for host in _EMAIL_HOST.finditer(text) if "@" in text else ():
        start = host.start()
        while start > free and text[start - 1] in _EMAIL_LOCAL:
            start -= 1
        if start < host.start():
            free = host.end()
            found.append((start, free))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, in that order."""
    found = [(start, 0, end) for start, end in emails(text)]
    for match in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in match[0].split(".")):
            found.append((match.start(), 1, match.end()))
    for match in _CARD.finditer(text):
        digits = digits_of(match[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((match.start(), 2, match.end()))
    for match in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(digits_of(match[0])) <= 15:
            found.append((match.start(), 3, match.end()))
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the generators propose; spans may overlap."""
    # Both email forms hold one of these.
    at = any(mark in text for mark in ("@", "(at)", "[at]"))
    forms = [(kind, form) for kind, form in _GENERATORS if kind or at]
    return [(m.start(), kind, m.end()) for kind, form in forms for m in form.finditer(text)]


def normal_email(span: str) -> str:
    """A written-out email as it is typed."""
    return _WRITTEN_OUT.sub(lambda m: "@" if m[1] == "at" else ".", span)


def of_longer_number(text: str, start: int, end: int) -> bool:
    """Whether digits go on beside the span, after a separator or without one."""
    left, right = text[max(0, start - 2) : start], text[end : end + 2]
    beside = left[-1:].isdigit() or right[:1].isdigit()
    return beside or left[:1].isdigit() and left[1:] in (*"-./",) or right[1:].isdigit() and right[:1] in (*"-./",)


def features(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format and context of a candidate. What stands right before it is seen as a word, never as a country code."""
    span, digits = text[start:end], digits_of(text[start:end])
    groups = [len(group) for group in _GROUPS.findall(span)]
    before = text[max(0, start - _CONTEXT) : start].lower()
    letters = sum(c.isalpha() for c in span)
    separators = [c for c in span if not c.isalnum()]
    quad = kind == 1 and all(int(part) <= 255 for part in span.split("."))
    return [
        *[float(kind == k) for k in range(len(KINDS))],
        float(len(span)),
        float(len(digits)),
        float(letters),
        float(len(separators)),
        float(len(set(separators))),
        float(len(groups)),
        float(max(groups, default=0)),
        float(min(groups, default=0)),
        float("(" in span),
        float("@" in span),
        float(span.count(".") + span.count("dot")),
        float(span.rpartition(".")[2].isalpha()),
        float(kind == 2 and luhn(digits)),
        float(quad),
        float(start > 0 and text[start - 1].isalnum()),
        float(end < len(text) and text[end].isalnum()),
        *[float(any(cue in before for cue in cues)) for cues in _CUES],
        float(kind == 0 and _VALID_EMAIL.fullmatch(normal_email(span)) is not None),
        float(kind == 0 and _WRITTEN_OUT.search(span) is not None),
        float(span.count(" ")),
        float(of_longer_number(text, start, end)),
        float(not _OTHER_NUMBERS.isdisjoint(_WORDS.findall(before)[-2:])),
    ]


def evidence(text: str, base: list[tuple[int, int, int]], start: int, kind: int, end: int) -> float | None:
    """1 and 0 where something speaks for or against personal data, None where nothing does."""
    span, digits = text[start:end], digits_of(text[start:end])
    words = _WORDS.findall(text[max(0, start - _CONTEXT) : start].lower())[-3:]
    named = not set(_CUES[kind]).isdisjoint(words)
    if kind == 0:
        if _VALID_EMAIL.fullmatch(normal_email(span)):
            return 1.0
        # Blanks beside a plain @ or dot: an email or two sentences.
        loose = _VALID_EMAIL.fullmatch(normal_email(span).replace(" ", ""))
        return None if loose and (named or covered(base, start, kind, end)) else float(covered(base, start, kind, end))
    if covered(base, start, kind, end):
        return 1.0
    if kind == 1 or kind == 2 and not luhn(digits):
        return 0.0
    if kind == 2:
        groups = [len(group) for group in _GROUPS.findall(span)]
        return 1.0 if digits[0] in "3456" and (named or groups in _CARD_GROUPS) else None
    if of_longer_number(text, start, end) or any(s < end and start < e for s, k, e in base if k != kind):
        return 0.0
    if named:
        return 1.0
    if not _OTHER_NUMBERS.isdisjoint(words[-2:]):
        return 0.0
    return 1.0 if _AREA_CODE.fullmatch(span) else None


def covered(spans: list[tuple[int, int, int]], start: int, kind: int, end: int) -> bool:
    return any(k == kind and 2 * (min(e, end) - max(s, start)) >= end - start for s, k, e in spans)


@dataclass
class Trees:
    """Boosted regression trees as arrays: feature, threshold, left, right and value of each node of each tree."""

    trees: list[list[tuple[int, float, int, int, float]]] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=lambda: [float("inf")] * len(KINDS))

    def score(self, values: list[float]) -> float:
        total = 0.0
        for tree, weight in zip(self.trees, self.weights, strict=True):
            at = 0
            while tree[at][0] >= 0:
                number, threshold, left, right, _ = tree[at]
                at = left if values[number] <= threshold else right
            total += weight * tree[at][4]
        return total


def tree_nodes(root: Any) -> list[tuple[int, float, int, int, float]]:
    nodes: list[tuple[int, float, int, int, float]] = []

    def visit(node: Any) -> int:
        at = len(nodes)
        nodes.append((-1, 0.0, 0, 0, node.prediction()))
        if node.subtreeDepth():
            split = node.split()
            left, right = visit(node.leftChild()), visit(node.rightChild())
            nodes[at] = (split.featureIndex(), split.threshold(), left, right, 0.0)
        return at

    visit(root)
    return nodes


def labelled_candidates(texts: DataFrame) -> DataFrame:
    """kind, features and label of the candidates of ``texts`` (text) with evidence."""

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                base = base_spans(text)
                for start, kind, end in candidates(text):
                    label = evidence(text, base, start, kind, end)
                    if label is not None:
                        rows.append((kind, features(text, start, kind, end), label))
            columns = zip(*rows, strict=True) if rows else [[]] * 3
            kinds = (pa.int32(), pa.list_(pa.float64()), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=["kind", "features", "label"]
            )

    return texts.mapInArrow(propose, "kind int, features array<double>, label double")


def sampled(texts: DataFrame) -> DataFrame:
    """The chosen ones of ``texts`` (text, chosen), equal texts once; copies are merged before the shuffle."""
    return texts.where("chosen").groupBy("text").agg(F.lit(1).alias("one")).select("text")


def train(docs: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees and thresholds from at most about ``sample`` texts, chosen by their hash, each once."""
    n = docs.count()
    if not n:
        return Trees()
    parts = 1_000_000
    share = min(parts // 2, -(-sample * parts // n))
    texts = docs.select(whole_text().alias("text")).withColumn("chosen", F.pmod(F.xxhash64("text"), F.lit(parts)) < share)
    learned = stored(labelled_candidates(sampled(texts)), "pii-candidates").repartition(2, "features")
    if learned.select("label").distinct().count() < 2:
        return Trees()
    points = learned.select(array_to_vector("features").alias("features"), "label")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=1).fit(points)
    trees = Trees(
        [tree_nodes(tree._call_java("rootNode")) for tree in model.trees], [float(w) for w in model.treeWeights]
    )
    counts = histogram(texts.where("NOT chosen").select("text"), trees)
    trees.thresholds = thresholds([tuple(row) for row in counts.collect()])
    return trees


def histogram(texts: DataFrame, trees: Trees) -> DataFrame:
    """kind, score (in steps of 1 / ``_BINS``), label and n of the candidates of ``texts`` (text) with evidence."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "score", "label", "n"]
        counts: Counter[tuple[int, int, float]] = Counter()
        for batch in batches:
            for text in batch.column(0):
                whole = text.as_py()
                base = base_spans(whole)
                for start, kind, end in candidates(whole):
                    label = evidence(whole, base, start, kind, end)
                    if label is not None:
                        counts[kind, math.floor(trees.score(features(whole, start, kind, end)) * _BINS), label] += 1
        if counts:
            columns = zip(*[(kind, step / _BINS, label, n) for (kind, step, label), n in counts.items()], strict=True)
            kinds = (pa.int32(), pa.float64(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    counted = texts.mapInArrow(count, "kind int, score double, label double, n long")
    return counted.groupBy("kind", "score", "label").agg(F.sum("n").alias("n"))


def thresholds(counts: list[tuple[int, float, float, int]]) -> list[float]:
    """The threshold of each kind, from (kind, score, label, n)."""
    # A kind without personal data adds nothing and says nothing of the others.
    kinds = {kind for kind, _, label, n in counts if label and n}
    together = lowest_score([(score, label, n) for kind, score, label, n in counts if kind in kinds])
    found = []
    for number in range(len(KINDS)):
        own = [(score, label, n) for kind, score, label, n in counts if kind == number]
        positive = sum(n for _, label, n in own if label)
        if positive >= MIN_EXAMPLES:
            found.append(lowest_score(own))
        elif positive:
            above = [(score, label, n) for score, label, n in own if score >= together]
            right, seen = sum(label * n for _, label, n in above), sum(n for _, _, n in above)
            found.append(together if right >= MIN_PRECISION * seen else lowest_score(above, 1))
        else:
            found.append(float("inf"))
    return found


def calibrated(scored: list[tuple[float, float]]) -> float:
    """The lowest score from which on enough candidates, and a high enough share of them, are personal data."""
    return lowest_score([(score, label, 1) for score, label in scored])


def lowest_score(counts: list[tuple[float, float, int]], least: int = MIN_EXAMPLES) -> float:
    """The same of (score, label, n)."""
    best, right, seen = float("inf"), 0.0, 0
    ordered = sorted(counts, reverse=True)
    for k, (score, label, n) in enumerate(ordered, 1):
        right, seen = right + label * n, seen + n
        last = k == len(ordered) or ordered[k][0] < score
        if last and seen >= least and right >= MIN_PRECISION * seen:
            best = score
    return best


def added_spans(text: str, base: list[tuple[int, int, int]], trees: Trees) -> list[tuple[int, int, int]]:
    proposed = []
    for start, kind, end in candidates(text):
        if not any(s < end and start < e for s, _, e in base):
            score = trees.score(features(text, start, kind, end))
            if score >= trees.thresholds[kind]:
                proposed.append((-score, start, kind, end))
    taken: list[tuple[int, int, int]] = []
    for _, start, kind, end in sorted(proposed):
        if not any(s < end and start < e for s, _, e in taken):
            taken.append((start, kind, end))
    return taken


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def find(docs: DataFrame, trees: Trees) -> DataFrame:
    """One row per row of ``docs``: doc_id, the number of base spans of each kind, all base spans and all spans."""
    rows = docs.select("doc_id", whole_text().alias("text"))
    names = [f"n_{kind}" for kind in KINDS]
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            *[T.StructField(name, T.LongType()) for name in names],
            T.StructField("base", T.StringType()),
            T.StructField("spans", T.StringType()),
        ]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in KINDS]
            base, spans = [], []
            for text in batch.column(1):
                whole = text.as_py()
                found = base_spans(whole)
                for kind, column in enumerate(counts):
                    column.append(sum(k == kind for _, k, _ in found))
                base.append(written(found))
                spans.append(written(found + added_spans(whole, found, trees)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(base, pa.string()), pa.array(spans, pa.string())],
                names=schema.names,
            )

    return rows.mapInArrow(search, schema)


def redacted(text: str, trees: Trees) -> str:
    """The text with every span replaced by its kind; overlapping spans become one, named after the first."""
    base = base_spans(text)
    merged: list[list[int]] = []
    for start, kind, end in sorted(base + added_spans(text, base, trees)):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([start, kind, end])
    parts, at = [], 0
    for start, kind, end in merged:
        parts += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, trees: Trees) -> DataFrame:
    """``docs`` with personal data replaced in ``text``, and ``n_chars`` counted anew where it is a column. A NULL
    text stays NULL."""
    rows = docs.select(F.struct("*").alias("doc"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc"], T.StructField("text", T.StringType())])

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in slices(batch.num_rows, _AT_ONCE):
                part = batch.slice(at, n)
                texts = [text if text is None else redacted(text, trees) for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=schema.names)

    done = rows.mapInArrow(replace, schema)
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return done.select(*[changed.get(name, F.col(f"doc.`{name}`")).alias(name) for name in docs.columns])


def personal_data(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    return find(docs, train(docs, sample))

