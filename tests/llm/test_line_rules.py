from __future__ import annotations

import random
import re

import duckdb
import pandas as pd
import pytest

from tallyroll.llm import line_rules, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(text):
    text = text or ""
    words = WORD.findall(text)
    lines = text.split("\n")
    duplicates = sum(bool(WORD.search(line)) and line in lines[:number] for number, line in enumerate(lines))
    windows = [tuple(words[place : place + 3]) for place in range(len(words) - 2)]
    covered = {place + step for place, window in enumerate(windows) if windows.count(window) > 1 for step in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        duplicates,
        len(covered),
        failed,
    )


def measures(row):
    return (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed)


CLEAN = "\n".join(f"Alpha{number} tells beta{number} of gamma{number}, and then delta{number} ends." for number in range(12))


def odd_texts():
    rng = random.Random(4)
    texts = [None, "", " \t\x0b\x0c\r\n", "a b c\x1cd \x85e", "x\n\nx\n \nx\n ", "é " * 60, "a b c " * 30, "w" * 100_000]
    texts += ["\n".join(["same line"] * 40), "# * $ % & | < > " * 3, CLEAN, "😀 " * 51]
    return texts + [
        "".join(rng.choice(["a ", "b ", "c\n", "d\t", "é ", "# "]) for _ in range(rng.randrange(160))) for _ in range(400)
    ]


def test_measures(spark):
    rows = list(enumerate(odd_texts()))
    documents = spark.createDataFrame([*rows, rows[3], (None, "no id")], "doc_id long, text string")
    documents = documents.selectExpr("*", "1 AS kept", "2 AS judged", "3 AS `a.b`").repartition(3)
    wanted = {row.doc_id: brute_force(row.text) for row in documents.collect()}
    found = line_rules.line_quality(documents).collect()
    assert len(found) == len(rows) + 2
    for row in found:
        assert measures(row) == wanted[row.doc_id], row.doc_id
        assert not (row.kept and row.base_failed)
    assert line_rules.line_quality(documents.limit(0)).count() == 0


def test_whole_table(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = {row.doc_id: row.quality for row in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    wanted = {row.doc_id: brute_force(row.text) for row in documents.collect()}
    rows = line_rules.line_quality(documents).collect()
    for row in rows:
        assert measures(row) == wanted[row.doc_id]
    good = [row for row in rows if labels.get(row.doc_id) == 1 and not row.base_failed]
    assert sum(row.kept for row in good) >= 0.98 * len(good)


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        ("Home | News | Sport | About | Contact", "navigation"),
        ("Home|About|News|Contact", "navigation"),
        ("Start » Shop » Shoes » Red · Blue", "navigation"),
        ("A well-known and/or so-called state-of-the-art (9/10) thing.", ""),
        ("buy*** now$$$ cheap### it is", "symbols"),
        ("BUY CHEAP WATCHES NOW AND SAVE BIG MONEY TODAY!", "shouting"),
        ("BUY CHEAP WATCHES NOW AND SAVE BIG MONEY TODAY", "shouting"),
        ("word " * 20, "punctuation"),
        ("word " * 19, ""),
        ("BUY THIS!! NOW!! IT IS!! SO VERY!! CHEAP!! HERE!!", "shouting"),
        ("word " * 45, "punctuation"),
        ("We use cookies to improve this site.", "boilerplate"),
        ("All rights reserved.", "boilerplate"),
        ("A heading", ""),
        ("A long sentence on cookies, " + "which goes on and on " * 6 + "until it ends.", ""),
        ("NASA AND ESA SIGNED A PAPER", ""),
        ("", ""),
        ("   ", ""),
    ],
)
def test_line_rules(line, rule):
    assert line_rules.line_verdict(line) == rule


def test_failing_lines_go(spark):
    rows = [
        (1, CLEAN + "\nHome | News | Sport | About", 1),
        (2, "\n".join(f"a{number} | b | c{number} | d | e" for number in range(30)), 1),
        (3, CLEAN, 7),
        (4, "short", 5),
        (5, None, None),
    ]
    documents = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").selectExpr("*", "'x' AS judged")
    left = line_rules.cleaned(documents)
    assert left.columns == documents.columns
    assert sorted((row.doc_id, row.text, row.n_chars) for row in left.collect()) == [(1, CLEAN, len(CLEAN)), (3, CLEAN, 7)]


def test_menus_of_one_item_a_line_go(spark):
    menu = "\n".join(["Home", "About us", "Our news", "", "Contact"])
    verse = "\n".join(["Roses,", "violets;", "sugar", "and you.", "The end."])
    rows = [(1, f"{menu}\n{CLEAN}"), (2, f"{CLEAN}\n{menu}"), (3, f"{CLEAN}\n{verse}"), (4, f"Title\n\nBy me\n{CLEAN}")]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    left = {row.doc_id: row.text for row in line_rules.cleaned(documents).collect()}
    assert left == {1: f"\n{CLEAN}", 2: f"{CLEAN}\n", 3: rows[2][1], 4: rows[3][1]}


def test_a_very_long_text_is_linear():
    lines = [f"A line with number {number}, and more." for number in range(200_000)] + ["x"] * 200_000
    found = line_rules.judge("\n".join(lines))
    assert found.n_bad_lines == 200_000 and found.n_dup_lines == 199_999


def odd_lines():
    rng = random.Random(5)
    lines = [
        "Home|About|News|Contact", "Start » Shop » Shoes » Red · Blue", "a > b > c > d", "a|>|b - c * d / e", "- * /",
        "buy*** now$$$ cheap### it is", "BUY CHEAP WATCHES NOW AND SAVE BIG MONEY TODAY", "ÉCOLE ÜBER ŒUVRE ÀÉÎ! Ⅻ Ⅷ Ⓐ Ⓑ ǅ ẞ",
        "word " * 20, "word " * 19, "слово " * 20 + "。", "We use COOKIES.", "Log in", "cookies " * 26, "Home", "About us", "Our news",
        "", " \t", " " * 250, "x" * 250, "end.", "NASA AND ESA SIGNED A PAPER!", "a\x1cb\x85c\u2028d e", CLEAN, "1 2 3 " * 20,
    ]
    return [None, "", *lines, *["\n".join(rng.choices(lines, k=rng.randrange(1, 30))) for _ in range(300)]]


def test_sql_agrees_on_odd_texts(spark):
    rows = list(enumerate([*odd_texts(), *odd_lines()]))
    rows += [rows[5], (None, CLEAN)]
    found = line_rules.line_quality(spark.createDataFrame(rows, "doc_id long, text string"))
    with duckdb.connect() as database:
        table = pd.DataFrame({"doc_id": pd.array([row[0] for row in rows], "Int64"), "text": [row[1] for row in rows]})
        database.register("documents", table)
        sql = queries.oracle_sql()["op7_line_rules"]
        wanted = database.sql(f"SELECT {', '.join(found.columns)} FROM ({sql})").fetchall()
    found = sorted(map(tuple, found.collect()), key=str)
    assert found == sorted(wanted, key=str)
    assert {row[-1] for row in found} == {True, False}
    assert len({row[6] for row in found}) > 10


def test_blank_lines_of_any_length_part_no_menu():
    assert line_rules.menu_lines(["Home", "About us", " " * 250, "Our news", "Contact"]) == {0, 1, 3, 4}
