"""Bring one-row aggregates of several tables together without a join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def side_by_side(frames: list[DataFrame]) -> DataFrame:
    """One row holding the columns of several one-row frames with distinct column names."""
    if len(frames) == 1:
        return frames[0]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.selectExpr(*[f"max({name}) AS {name}" for name in stacked.columns])


def as_rows(frame: DataFrame, names: list[str], label: str, value: str) -> DataFrame:
    """A one-row frame of counters as (position, label, value) rows, in the order of ``names``."""
    rows = ", ".join(
        f"struct({position} AS position, '{name}' AS {label}, cast({name} AS bigint) AS {value})"
        for position, name in enumerate(names, start=1)
    )
    return frame.selectExpr(f"inline(array({rows}))")
