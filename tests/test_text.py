"""Parsing rules, value by value."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from tallyroll.functions import text
from tallyroll.functions.months import last_complete_month


def evaluate(spark, expression, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [row[0] for row in frame.orderBy("i").selectExpr(expression).collect()]


def test_whole_numbers(spark):
    cases = {
        " 2 ": 2, "01": 1, "+5": 5, "2.0": 2, "1e2": 100, "3.": 3, "\t3\n": 3, " -7.0": -7, ".0": 0, "2147483648.0": None, "1.5.0": None, "1e2.0": None, ".0.0": None,
        "-0": 0, "2147483647": 2147483647,
        "1.5": None, "": None, " ": None, "inf": None, "nan": None, "abc": None, "0x10": None, "1_000": None,
        "1e-1": None, "1e-19": None, "0.0000000000000000001": None, "7.00000000000000000000": 7, "100e-2": 1, "2147483648": None, "1e30": None, None: None, "True": None, "2d": None,
    }
    assert evaluate(spark, text.whole_number("t"), cases) == list(cases.values())


def test_money(spark):
    cases = {
        " $1,200.25 ": Decimal("1200.25"), "$-5": Decimal("-5"), "-$5": Decimal("-5"), "1e3": Decimal("1000"),
        "0.0000004": Decimal("0.0000004"), "$1.0000000000000001": Decimal("1.0000000000000001"),
        "1.00000000000000001": None, "1.500000000000000000000": Decimal("1.5"), "1e-17": None,
        " $7.125\t": Decimal("7.125"), "$ 3": Decimal("3"), "": None, "$": None, "n/a": None, None: None,
    }
    assert evaluate(spark, text.money("t"), cases) == list(cases.values())


def test_source_dates(spark):
    parsed = text.source_date(text.zero_padded_day("t"))
    cases = {
        "1/5/2024": date(2024, 1, 5), "01/05/2024": date(2024, 1, 5), "1/ 5/2024": date(2024, 1, 5),
        "12/31/1999": date(1999, 12, 31), "001/5/2024": None, "1/005/2024": None, "1/5/24": None, "1/5/20245": None,
        "13/1/2024": None, "2/30/2024": None, " 1/5/2024": None, "1/5/2024 ": None, "2024-01-05": None,
        "1-5-2024": None, "1/5/+2024": None, "1/5T/2024": None, "1/5 /2024": None, "1/T5/2024": None,
        "1T/5/2024": None, "-1/5/2024": None, "1/-5/2024": None, "+1/5/2024": None, "1//2024": None, "/1/2024": None,
        "1/5/-202": None, "1/5/202T": None, "1/2/3/2024": None, "invalid": None, "": None, None: None,
    }
    assert evaluate(spark, parsed, cases) == list(cases.values())


def test_dates_agree_with_a_strict_parser(spark):
    """Every day-shaped text is read as the public pandas parser reads it."""
    pd = pytest.importorskip("pandas")
    values = [
        f"{month}{sep}{day}{sep}{year}"
        for month in ("1", "02", "12", "13", "0", "")
        for day in ("1", "09", " 7", "29", "31", "32", "0")
        for year in ("2023", "2024", "24", "1677", "2262", "2263", "02024")
        for sep in ("/", "-")
    ]
    expected = []
    for value in values:
        try:
            expected.append(pd.to_datetime(value, format="%m/%d/%Y").date())
        except ValueError:
            expected.append(None)
    parsed = text.source_date(text.zero_padded_day("t"))
    day = f"CASE WHEN {text.in_date_range(parsed)} THEN {parsed} END"
    assert evaluate(spark, day, values) == expected


def test_absent_dates_are_not_wrong_dates(spark):
    cases = {"": True, "NaT": True, "nan": True, None: True, " ": False, "None": False, "1/1/2024": False}
    assert evaluate(spark, text.no_date("t"), cases) == list(cases.values())


def test_blank_text(spark):
    cases = {"": True, " \t": True, "  ": True, None: True, "a": False, " a ": False}
    assert evaluate(spark, text.is_blank("t"), cases) == list(cases.values())
    assert evaluate(spark, text.stripped("t"), ["　 a b\r\n"]) == ["a b"]


def test_positive_integers(spark):
    cases = {"1e-19": False, "2": True, "2.0": True, " 7 ": True, "1e2": True, "0": False, "-1": False, "1.5": False, "": False, "x": False, None: False}
    assert evaluate(spark, text.positive_integer("t"), cases) == list(cases.values())


@pytest.mark.parametrize(
    "latest, expected",
    [("2021-02-20", "2021-01-01"), ("2020-02-29", "2020-02-01"), ("2021-02-28", "2021-02-01"), ("2021-01-05", "2020-12-01")],
)
def test_last_complete_month(spark, latest, expected):
    month = spark.range(1).selectExpr(f"cast({last_complete_month(f'DATE{chr(39)}{latest}{chr(39)}')} AS string)")
    assert month.first()[0] == expected
