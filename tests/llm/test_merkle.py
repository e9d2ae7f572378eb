from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tallyroll.llm import merkle

SF = "/root/testdata/sf0.001"


def brute_force(rows):
    """(doc_id, n_chars, sha256 of the edited text) in the order of ids, nulls first, then texts."""
    rows = sorted(((doc_id is not None, doc_id or 0, text or "") for doc_id, text in rows))
    found = []
    for number, (known, doc_id, text) in enumerate(rows):
        following = rows[(number + 1) % len(rows)][2]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        found.append((str(doc_id if known else None), len(text), hashlib.sha256(edited.encode()).hexdigest(), edited, text, following))
    return sorted(found)


def check(documents):
    wanted = brute_force([(row.doc_id, row.text) for row in documents.select("doc_id", "text").collect()])
    rows = merkle.edit_report(documents).collect()
    assert sorted((str(row.doc_id), row.n_chars, row.edited_sha256) for row in rows) == [each[:3] for each in wanted]
    texts = {(each[0], each[2]): each[3:] for each in wanted}
    prints = {}
    for row in rows:
        edited, text, following = texts[str(row.doc_id), row.edited_sha256]
        assert prints.setdefault(text, row.fingerprint) == row.fingerprint
        assert prints.setdefault(edited, row.edited_fingerprint) == row.edited_fingerprint
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        assert (row.fingerprint == row.edited_fingerprint) == (text == edited)
        if text == edited:
            assert row.near_edited == 1 and row.n_changed == 0
        if text == following:
            assert row.near_next == 1
    assert len(set(prints.values())) == len(prints)
    return rows


def test_whole_table(spark):
    rows = check(spark.read.parquet(f"{SF}/documents.parquet"))
    long = [row for row in rows if row.n_chars >= 300]
    assert sum(row.near_edited for row in long) / len(long) > 0.65
    assert min(row.near_edited for row in long) > 0.3
    assert sum(row.near_edited > row.near_next for row in long) > 0.9 * len(long)


@pytest.mark.parametrize("partitions", [1, 4])
def test_odd_rows(spark, partitions):
    rows = [
        (5, "Same text here.\n\nSecond section. It goes on.\nLine.\n"),
        (5, "Same text here.\n\nSecond section. It goes on.\nLine.\n"),
        (5, "another text with this id"),
        (None, "no id"),
        (None, None),
        (-3, ""),
        (9_000_000_000_000_000_000, "😀é" * 50 + "."),
        (9_000_000_000_000_000_001, "x" * 300_000),
        (7, "\n\n\n\n"),
        (8, "a\n\nb"),
        (10, "a\n\n\nb"),
        (11, "\n"),
        (12, None),
    ]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    documents = documents.selectExpr("*", "1 AS block", "'x' AS own", "2 AS `a.b`", "3 AS copy")
    check(documents)
    assert merkle.edit_report(documents.limit(0)).count() == 0
    check(documents.where("doc_id = 8"))
    check(documents.where("doc_id IS NULL"))
    assert merkle.fingerprints(documents).count() == len(rows)


def test_edits_are_located(spark):
    left = "Intro one.\nIntro two.\n\nBody one.\nBody two.\nBody three.\n\nEnd."
    right = left.replace("Body two.", "Body 2.")
    rows = merkle.with_trees(spark.createDataFrame([(left, right)], "l string, r string"), a=F.col("l"), b=F.col("r"))
    (row,) = rows.select(merkle.changed_paragraphs(F.col("a"), F.col("b")).alias("places")).collect()
    assert [(place.section, place.paragraph) for place in row.places] == [(1, 1)]


def test_native(spark):
    documents = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = merkle.edit_report(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_many_null_ids_and_small_blocks(spark, monkeypatch):
    """Blocks of a few hundred bytes: neighbours are found across blocks, with and without ids."""
    monkeypatch.setattr(merkle, "NEIGHBOUR_BYTES", 500)
    rows = [(None, f"{number % 400} text without an id") for number in range(1000)]
    rows += [(number * 7 % 501, f"{number} it is. " * (number % 5)) for number in range(600)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    check(documents)
    check(documents.where("doc_id IS NOT NULL"))
    check(documents.where("doc_id IS NULL"))


def test_neighbours_move_no_texts_through_one_task(spark):
    documents = spark.createDataFrame([(1, "a"), (None, "b")], "doc_id long, text string")
    plan = merkle.with_next(documents)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == plan.count("windowspecdefinition(block") == 1


def test_a_text_of_very_many_lines(spark):
    text = "".join(f"line {number}\n" for number in range(100_000))
    changed = text.replace("line 5\n", "line five\n").replace("line 77777\n", "")
    rows = merkle.with_trees(spark.createDataFrame([(text, changed)], "l string, r string"), a=F.col("l"), b=F.col("r"))
    (row,) = rows.select(merkle.changed_paragraphs(F.col("a"), F.col("b")).alias("places")).collect()
    assert [(place.section, place.paragraph) for place in row.places] == [(0, 5), (0, 77777)]


def test_changed_paragraphs_as_a_plain_search(spark):
    chosen = random.Random(8)
    lines = ["a", "b", "c", "", "", "dd"]
    texts = ["\n".join(chosen.choices(lines, k=chosen.randrange(0, 12))) for _ in range(300)]
    pairs = spark.createDataFrame(list(zip(texts, texts[1:], strict=False)), "l string, r string")
    rows = merkle.with_trees(pairs, a=F.col("l"), b=F.col("r"))
    for row in rows.select("a", "b", merkle.changed_paragraphs(F.col("a"), F.col("b")).alias("places")).collect():
        sections = {section.digest for section in row.b.sections}
        known = {paragraph.digest for section in row.b.sections for paragraph in section.paragraphs}
        wanted = [
            (number, place)
            for number, section in enumerate(row.a.sections)
            if section.digest not in sections
            for place, paragraph in enumerate(section.paragraphs)
            if paragraph.digest not in known
        ]
        assert [(place.section, place.paragraph) for place in row.places] == wanted
