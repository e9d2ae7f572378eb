"""The Gold export for reporting tools."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyroll.contracts import GOLD_KEYS, GOLD_TABLE
from tallyroll.errors import StageError
from tallyroll.sources.exports import replace_csv
from tallyroll.sources.layer_store import LayerStore


def ordered_summary(summary: DataFrame) -> DataFrame:
    return summary.orderBy(*GOLD_KEYS)


def export_gold(store: LayerStore, path: str) -> int:
    """Replace the CSV export with all published Gold rows in key order; returns how many."""
    store.require([("gold", GOLD_TABLE)], "gold")
    summary = store.table("gold", GOLD_TABLE)
    rows = summary.count()
    if rows == 0:
        raise StageError("there is no Gold row to export. Run gold first")
    replace_csv(ordered_summary(summary), path)
    return rows
