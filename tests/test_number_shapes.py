"""Whole numbers by the shape of their text."""

from __future__ import annotations

import re

import pytest

from tallyroll.functions.text import whole_number


def test_the_usual_texts_reach_no_cast_that_fails(spark):
    texts = ["5", " 5 ", "+5", "005", "5.0", "5.", "5.00000000000000000000", "5.5", "5.0000000000000000001", "word", "", "-", ".", "1_000", "3000000000"]
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    strict = re.sub(r"\btry_cast\(", "cast(", whole_number("text"))
    found = [row.value for row in frame.selectExpr(f"{strict} AS value").collect()]
    assert found == [5] * 7 + [None] * 8


@pytest.mark.parametrize(
    ("text", "number"),
    [("1e2", 100), ("5e-19", None), ("1200e-2", 12), ("2147483647", 2147483647), ("2147483648", None), ("-2147483648.0", -2147483648),
     ("00000000000000000000012", 12), ("\x7f5", 5), ("5.0\x7f", None), ("٣", 3), ("5.٠", 5), (".0", 0), (None, None)],
)
def test_rare_texts_are_whole_numbers_as_before(spark, text, number):
    frame = spark.createDataFrame([(text,)], "text string")
    assert frame.selectExpr(f"{whole_number('text')} AS value").first().value == number
