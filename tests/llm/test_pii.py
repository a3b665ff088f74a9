from __future__ import annotations

import random
import re

import pytest

from medallion.llm import pii

FORMS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def brute_spans(text):
    found = []
    for kind, form in enumerate(FORMS):
        for match in form.finditer(text):
            digits = re.sub("[^0-9]", "", match[0])
            good = (
                True,
                kind == 1 and all(int(part) <= 255 for part in match[0].split(".")),
                12 <= len(digits) <= 19 and luhn(digits),
                9 <= len(digits) <= 15,
            )[kind]
            if good:
                found.append((match.start(), kind, match.end()))
    return sorted(found)


def test_base_spans_against_the_forms():
    rng = random.Random(4)
    parts = ["1", "2", "25", "256", ".", ".", "-", " ", "+", "@", "a", "b.c", "(", ")", "4111 1111 1111 1111", "é", "٣", "00", "\n"]
    for _ in range(8000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert pii.base_spans(text) == brute_spans(text), text


def test_long_texts_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "+1" * 100_000, "1." * 100_000, "+" + "1 " * 100_000, "a@" * 100_000):
        pii.base_spans(text)
        pii.candidates(text)


def sample_docs(spark, n=400):
    rng = random.Random(6)
    rows = []
    for k in range(n):
        phone = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        local = f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        number = str(rng.randint(10**15, 10**16 - 1))
        rows.append((k, rng.choice([f"call {phone} now", f"number {number} here", "nothing at all", f"call {local} now" if k % 40 == 0 else "x"])))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_candidates_extend_the_base(spark):
    trees = pii.train(sample_docs(spark))
    assert len(trees.trees) == pii.TREES and trees.thresholds[0] == float("inf")
    rows = [(1, None), (2, ""), (None, "mail a.b@c.de"), (3, "call +1 (212) 555-1234 now"), (3, "é 1.2.3.4"), (4, "clean text 12 34"), (5, "number 4111111111111112 here")]
    docs = spark.createDataFrame([(*row, "clash") for row in rows], "doc_id long, text string, base string")
    found = pii.find(docs, trees).collect()
    assert len(found) == len(rows)
    for (_, text), row in zip(rows, found, strict=True):
        base = pii.written(brute_spans(text or ""))
        assert row["base"] == base and set(filter(None, base.split(","))) <= set(row["spans"].split(","))
        assert [row[f"n_{kind}"] for kind in pii.KINDS] == [sum(k == n for _, k, _ in brute_spans(text or "")) for n in range(4)]
    assert [r["spans"] for r in found if r["doc_id"] in (4, 5)] == ["", ""]
    cleaned = [r["text"] for r in pii.redact(docs, trees).collect()]
    assert cleaned[:4] == [None, "", "mail [EMAIL]", "call [PHONE] now"]
    assert pii.redact(docs, trees).columns == docs.columns


def test_added_spans_by_a_given_model():
    trees = pii.Trees([[(12, 0.5, 1, 2, 0.0), (-1, 0, 0, 0, -1.0), (-1, 0, 0, 0, 1.0)]], [1.0], [9.0, 9.0, 9.0, 1.0])
    text = "call (212) 555-1234 or +1 (212) 555-1234, not 212-555-1234"
    base = pii.base_spans(text)
    assert pii.added_spans(text, base, trees) == [(5, 3, 19)]
    assert pii.redacted(text, trees) == "call [PHONE] or [PHONE], not 212-555-1234"


@pytest.mark.parametrize("rows", [[], [(1, "clean")], [(1, None)]])
def test_without_a_model(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r["spans"] for r in pii.personal_data(docs).collect()] == [""] * len(rows)


def test_calibration():
    assert pii.calibrated([(1.0, 1.0)] * 100 + [(0.0, 0.0)] * 100) == 1.0
    assert pii.calibrated([(1.0, 1.0)] * 50 + [(1.0, 0.0)] * 50) == float("inf")
    assert pii.calibrated([(1.0, 1.0)] * 5) == float("inf")


def written_out_docs(spark, n=400):
    rng = random.Random(8)
    forms = ["mail u{0}@example.com now", "mail u{0} (at) example (dot) com. Then rest", "(2{1:02}) 555-{0} it is", "call +1 (2{1:02}) 555-{0} now", "order 2{1:02}-555-{0} came", "host 300.{1}.2.3"]
    rows = [(k, forms[k % 6].format(rng.randint(1000, 9999), rng.randint(10, 99))) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_spans_without_a_base_are_learned(spark):
    trees = pii.train(written_out_docs(spark, 2400))
    text = "mail jane (at) example (dot) com. Then ring (212) 555-1234 or order 212-555-1234, 300.1.2.3"
    found = [text[start:end] for start, _, end in sorted(pii.added_spans(text, pii.base_spans(text), trees))]
    assert found == ["jane (at) example (dot) com", "(212) 555-1234"]


def test_evidence():
    def label(text, span, kind):
        start = text.index(span)
        return pii.evidence(text, pii.base_spans(text), start, kind, start + len(span))

    assert label("jane (at) example (dot) com", "jane (at) example (dot) com", 0) == 1.0
    assert label("write @ noon", "write @ noon", 0) == 0.0
    assert label("4111.1111.1111.1111", "4111.1111.1111.1111", 2) == 1.0
    assert label("4111.1111.1111.1112", "4111.1111.1111.1112", 2) == 0.0
    assert label("so (212) 555-1234", "(212) 555-1234", 3) == 1.0
    assert label("so 212-555-1234", "212-555-1234", 3) is None
    assert label("order 212-555-1234", "212-555-1234", 3) == 0.0


def test_thresholds_of_rare_kinds():
    many = [(3, 1.5, 1.0, 100), (3, 0.5, 1.0, 100), (3, -1.0, 0.0, 100)]
    inf = float("inf")
    assert pii.thresholds(many) == [inf, inf, inf, 0.5]
    assert pii.thresholds([*many, (0, 1.0, 1.0, 4)]) == [0.5, inf, inf, 0.5]
    assert pii.thresholds([*many, (0, 1.0, 1.0, 4), (0, 0.7, 0.0, 1), (1, 2.0, 0.0, 9)])[:2] == [1.0, inf]


def test_thresholds_cover_the_whole_table(spark):
    trees = pii.train(written_out_docs(spark, 600), sample=100)
    assert trees.thresholds[0] < float("inf") and trees.thresholds[3] < float("inf")


def test_sample_is_bounded_without_ids(spark, monkeypatch):
    seen = []
    rows = pii.labelled_candidates
    monkeypatch.setattr(pii, "labelled_candidates", lambda texts: seen.append(texts.count()) or rows(texts))
    docs = written_out_docs(spark, 600).selectExpr("CAST(NULL AS LONG) AS doc_id", "text")
    same = docs.limit(1).crossJoin(spark.range(600)).select("doc_id", "text")
    pii.train(docs.unionByName(same), sample=60)
    assert 0 < seen[0] <= 120


@pytest.mark.parametrize("text", [
    "jane (at) mail (dot) cs (dot) uni (dot) edu",
    "jane(at)a(dot)b(dot)c(dot)d(dot)e(dot)f(dot)com",
    "a" * 90 + " [at] " + "b" * 80 + " [dot] " + " (dot) ".join("cdefghijkl"),
])
def test_written_out_addresses_of_any_length(text):
    found = pii.candidates(f"write to {text}, please")
    assert (9, 0, 9 + len(text)) in found
