"""Exports for other tools: a folder of ordered part files that is replaced as a whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from tallyroll.sources.files import Files


def two_decimals(amount: Column) -> Column:
    """A double as text-stable money; ties round half up."""
    return amount.cast("decimal(38,2)")


def replace_csv(frame: DataFrame, path: str) -> None:
    """Write CSV with a header; the order of the rows is that of the part file names."""
    _replace(frame, path, lambda target: frame.write.option("header", True).csv(target))


def replace_json(frame: DataFrame, path: str) -> None:
    _replace(frame, path, lambda target: frame.write.option("ignoreNullFields", False).json(target))


def _replace(frame: DataFrame, path: str, write: Callable[[str], None]) -> None:
    """Write beside the target and swap; a failure leaves the previous export in place."""
    files, token = Files(frame.sparkSession), uuid.uuid4().hex
    path = path.rstrip("/")
    staged, previous = f"{path}.new-{token}", f"{path}.old-{token}"
    try:
        write(staged)
        had_previous = files.exists(path)
        if had_previous:
            files.move(path, previous)
        try:
            files.move(staged, path)
        except Exception:
            if had_previous:
                files.move(previous, path)
            raise
        if had_previous:
            files.delete(previous)
    finally:
        files.delete(staged)
