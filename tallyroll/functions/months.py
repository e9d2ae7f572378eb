"""Calendar months, as SQL expressions over a date expression."""

from __future__ import annotations


def month_start(day: str) -> str:
    return f"trunc({day}, 'MM')"


def last_complete_month(latest: str) -> str:
    """First day of the latest month that the dates cover to its last calendar day."""
    return month_start(f"CASE WHEN last_day({latest}) = {latest} THEN {latest} ELSE add_months({latest}, -1) END")
