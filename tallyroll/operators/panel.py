"""Monthly panel operators: zero-filled segments, lags and trailing means."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame


def zero_filled(monthly: DataFrame, segment: list[str], month: str, value: str, first: date, last: date) -> DataFrame:
    """A row for every month from ``first`` to ``last`` in every segment, absent ones as 0.

    Each segment expands its own months, so there is no month-by-segment product to join.
    """
    months = f"explode(sequence(DATE'{first}', DATE'{last}', interval 1 month)) AS {month}"
    grid = monthly.select(*segment).distinct().selectExpr(*segment, months)
    filled = grid.join(monthly.select(*segment, month, value), [*segment, month], "left")
    return filled.selectExpr(month, *segment, f"coalesce({value}, 0D) AS {value}")


def lagged(panel: DataFrame, segment: list[str], month: str, value: str) -> DataFrame:
    """Adds the value one and twelve months before, the mean of the three months before
    (NULL until there are three), and the month number as text.

    The panel has no gaps, so rows back are months back; a segment is a few hundred rows.
    """
    history = f"OVER (PARTITION BY {', '.join(segment)} ORDER BY {month})"
    before = {months: f"lag({value}, {months}) {history}" for months in (1, 2, 3, 12)}
    return panel.selectExpr(
        "*",
        f"{before[1]} AS lag_1",
        f"{before[12]} AS lag_12",
        f"({before[1]} + {before[2]} + {before[3]}) / 3 AS previous_3_month_average",
        f"cast(month({month}) AS string) AS month_number",
    )
