"""Key-level operators: duplicates, lookups and anti-match counts.

Counts aggregate by key before any join. The map-side partial aggregate folds a hot key into
one row per task, so a key that holds a third of the table never lands in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_and_excess(df: DataFrame, keys: list[str], rows: str, excess: str) -> DataFrame:
    """One row: all rows, and the rows beyond the first of their key (NULL keys group)."""
    per_key = df.groupBy(*keys).agg(F.expr("count(1) AS n"))
    return per_key.selectExpr(
        f"cast(coalesce(sum(n), 0) AS bigint) AS {rows}", f"cast(coalesce(sum(n - 1), 0) AS bigint) AS {excess}"
    )


def lookup(dim: DataFrame, key: str, matched: str, duplicate_message: str, holds: str = "true") -> DataFrame:
    """``dim`` with a flag for the rows a left join finds, failing the job if a key repeats.

    ``holds`` may fail it too: it is evaluated for every row that has the flag.

    The check is a subquery beside the join, not a grouping below it. So the two inputs of a
    shuffle join are plain exchanges, which AQE needs in order to split a hot key.
    """
    most = dim.groupBy(key).agg(F.expr("count(1) AS copies")).selectExpr("coalesce(max(copies), 0)")
    unique = F.when(most.scalar() <= 1, F.lit(True)).otherwise(F.raise_error(F.lit(duplicate_message)))
    return dim.select("*", (F.expr(holds) & unique).alias(matched))


def lines_per_key(lines: DataFrame, dim: DataFrame, key: str, **flags: str) -> DataFrame:
    """``lines`` counted per key beside how often the key is in ``dim`` (NULL: never) and any
    further aggregates of its dimension rows."""
    counted = lines.groupBy(key).agg(F.expr("count(1) AS lines"))
    known = dim.groupBy(key).agg(
        F.expr("count(1) AS copies"), *[F.expr(f"{flag} AS {name}") for name, flag in flags.items()]
    )
    return counted.join(known, key, "left")


@dataclass(frozen=True)
class KeySet:
    """A key of the lines to be counted by, its dimension if it has one, and conditions whose lines are counted."""

    name: str
    columns: tuple[str, ...]
    dim: DataFrame | None = None
    conditions: dict[str, str] = field(default_factory=dict)


def key_counts(lines: DataFrame | None, keys: list[KeySet]) -> DataFrame:
    """One row of counts over several keys of ``lines`` and their dimensions, each table read once.

    For a key k: ``k_lines`` and ``k_excess`` count the lines and those beyond the first of their
    key (NULL keys group), and each condition the lines it holds for. With a dimension, ``k_rows``
    and ``k_repeats`` count its rows likewise, and ``k_joined`` and ``k_unmatched`` are the rows of
    a left join of lines and dimension and those without a match, though nothing is joined: every
    line stands once under each key, dimension rows stand beside them, and one grouping by key,
    folded before it is shuffled, has both counts. Without ``lines`` only dimensions are counted.
    """
    width = max(len(key.columns) for key in keys)
    conditions = {name: condition for key in keys for name, condition in key.conditions.items()}

    def entry(key: KeySet, copies: int) -> str:
        names = [*key.columns, *["NULL"] * (width - len(key.columns))]
        parts = [f"cast({column} AS string) AS key_{place}" for place, column in enumerate(names)]
        flags = [f"{holds if not copies and name in key.conditions else 'false'} AS {name}" for name, holds in conditions.items()]
        return f"struct('{key.name}' AS key_set, {', '.join([*parts, *flags])}, {1 - copies} AS line, {copies} AS copy)"

    tables = [] if lines is None else [lines.selectExpr(f"inline(array({', '.join(entry(key, 0) for key in keys)}))")]
    tables += [key.dim.selectExpr(f"inline(array({entry(key, 1)}))") for key in keys if key.dim is not None]
    per_key = (
        reduce(DataFrame.unionAll, tables)
        .groupBy("key_set", *[f"key_{place}" for place in range(width)])
        .agg(
            F.expr("sum(cast(line AS bigint)) AS n"),
            F.expr("sum(cast(copy AS bigint)) AS copies"),
            *[F.expr(f"count_if({name}) AS {name}") for name in conditions],
        )
    )
    sums = []
    for key in keys:
        # A NULL key is never found.
        found = "if(key_0 IS NULL, 0, copies)"
        wanted = {f"{key.name}_lines": "n", f"{key.name}_excess": "greatest(n - 1, 0)"}
        if key.dim is not None:
            wanted |= {
                f"{key.name}_rows": "copies",
                f"{key.name}_repeats": "greatest(copies - 1, 0)",
                f"{key.name}_joined": f"n * greatest({found}, 1)",
                f"{key.name}_unmatched": f"if({found} = 0, n, 0)",
            }
        wanted |= {name: name for name in key.conditions}
        sums += [f"coalesce(sum({value}) FILTER (WHERE key_set = '{key.name}'), 0) AS {name}" for name, value in wanted.items()]
    return per_key.selectExpr(*sums)
