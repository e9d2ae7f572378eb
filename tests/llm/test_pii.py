from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from tallyroll.llm import pii

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def confirmed(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(part) <= 255 for part in match.split(".")),
        "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def brute_force(text):
    order = list(BASE)
    found = [
        (match.start(), order.index(kind), kind, match.end())
        for kind, pattern in BASE.items()
        for match in pattern.finditer(text or "")
        if confirmed(kind, match[0])
    ]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


ODD = [
    None,
    "",
    "plain words only",
    "a@b.c, x.y+z@d-e.f.g;q@@r.s a@b.c@d.e .a@b a@b.c.@d.e é@b.c a_b@c.d..e@f.g",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 000255.1.1.1 1.2.3 v1.2.3.4.5 " + "9" * 60 + ".1.1.1",
    "4111 1111 1111 1111 and 4111111111111112 4111-1111-1111-1111, 79927398713 0000000000000",
    "+1 (202) 555-0170, +49 30 123456 +1 +12 3 call +4420 7946 0958 tel+1+2025550170123 +1 - - (",
    "😀 😀 mail a@b.co 😀 4111111111111111 😀",
    "IBAN DE89 3704 0044 0532 0130 00, GB82WEST12345698765432 and DE00370400440532013000",
    "SSN 219-09-9999, other 219-09-9998",
    "7" * 30000,
    "1 " * 20000,
    "a@" * 10000 + " x@y" + ".z" * 10000,
    "+" * 5000 + "1" + " " * 20000 + "2",
    "x" * 200000 + "@y.z",
    "1.1.1.1." * 3000,
]


def texts():
    rng = random.Random(2)
    signs = "aZ09.@+-() 4111 1111..@@é😀\n"
    return ODD + ["".join(rng.choice(signs) for _ in range(rng.randrange(120))) for _ in range(3000)]


def check(documents):
    wanted = {}
    for row in documents.select("doc_id", "text").collect():
        wanted.setdefault(row.doc_id, []).append(brute_force(row.text))
    found = pii.span_digests(pii.personal_data(documents)).collect()
    assert len(found) == documents.count()
    for row in found:
        base = wanted[row.doc_id].pop()
        all_spans = row.spans.split(",") if row.spans else []
        assert [span for span in all_spans if span.split(":")[0] in BASE] == base, row.doc_id
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        for kind in BASE:
            assert row[f"n_{kind}"] == sum(span.startswith(kind) for span in base)
    return found


def test_odd_texts(spark):
    rows = list(enumerate(texts()))
    documents = spark.createDataFrame([*rows, rows[4], rows[4]], "doc_id long, text string")
    documents = documents.selectExpr("*", "'x' AS spans", "1 AS matches_email", "2 AS `a.b`").repartition(4)
    found = {row.doc_id: row.spans for row in check(documents)}
    assert found[8].count("iban") == 2 and "iban:5:32" in found[8]
    assert found[9] == "ssn:4:15"
    assert pii.personal_data(documents.limit(0)).count() == 0


def test_whole_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_null_ids(spark):
    documents = spark.createDataFrame([(None, "a@b.c"), (None, None)], "doc_id long, text string")
    assert sorted(row.n_email for row in pii.span_digests(pii.personal_data(documents)).collect()) == [0, 1]


def test_context_raises_the_score(spark):
    documents = spark.createDataFrame([(1, "mail me: a@b.c"), (2, "see a@b.c")], "doc_id long, text string")
    scores = {row.doc_id: row.spans[0].score for row in pii.personal_data(documents).collect()}
    assert scores == {1: 1.0, 2: 0.9}


@pytest.mark.parametrize(
    ("text", "clean"),
    [
        ("write a@b.co or 10.0.0.1.", "write [EMAIL] or [IP]."),
        ("+1 202 555 0170 x", "[PHONE] x"),
        ("call +4111 1111 1111 1111", "call +[CARD]"),
        ("call +49111 1111 1111, 😀", "call [PHONE], 😀"),
        ("none", "none"),
        (None, None),
    ],
)
def test_redaction(spark, text, clean):
    documents = spark.createDataFrame([(1, text, 3, "s")], "doc_id long, text string, n_chars long, spans string")
    (row,) = pii.without_personal_data(documents).collect()
    assert (row.doc_id, row.text, row.spans) == (1, clean, "s")
    assert row.n_chars == (3 if clean == text else len(clean))


def test_native(spark):
    documents = spark.createDataFrame([(1, "a@b.c")], "doc_id long, text string")
    plan = pii.personal_data(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_text_with_very_many_matches(spark):
    """Spans of many matches, and the text without them, in time that does not grow with their square."""
    seconds = {}
    for count in (8_000, 32_000):
        text = "é " + " ".join(f"a{number}@b.co" for number in range(count)) + " +1 555 010 9999"
        rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
        started = time.perf_counter()
        (row,) = pii.personal_data(rows).collect()
        (clean,) = pii.without_personal_data(rows).collect()
        seconds[count] = time.perf_counter() - started
        assert [text[span.start : span.end] for span in row.spans] == re.findall(r"a\d+@b\.co|\+[0-9 ]+", text)
        assert clean.text == "é " + " ".join(["[EMAIL]"] * count) + " [PHONE]"
    assert seconds[32_000] < 5 * seconds[8_000] + 5
