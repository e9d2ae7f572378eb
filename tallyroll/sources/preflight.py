"""Checks on the delivered files before anything is loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyroll.contracts import SOURCES, SourceContract
from tallyroll.errors import JOB_ERRORS, SourceError
from tallyroll.sources.delimited import TOO_LONG, count_rows, inspect_text

SUMMARY_SCHEMA = "file_name string, row_count bigint, column_count int"


def check_sources(spark: SparkSession, directory: str) -> DataFrame:
    """One row per source with its row and column counts; raises at the first bad source."""
    return spark.createDataFrame([check_source(spark, directory, contract) for contract in SOURCES], SUMMARY_SCHEMA)


def check_source(spark: SparkSession, directory: str, contract: SourceContract) -> tuple[str, int, int]:
    """Name, rows and columns of one source, or the reason why it is refused."""
    text = inspect_text(spark, directory, contract)
    if not text.valid_utf8:
        raise SourceError(f"{contract.file_name} is not valid UTF-8")
    if text.header != contract.headers:
        raise SourceError(f"{contract.file_name} has an unexpected header ({_difference(text.header, contract.headers)})")
    try:
        rows, too_long = count_rows(spark, directory, contract, text)
    except JOB_ERRORS as error:
        raise SourceError(f"could not read {contract.file_name}: {error}") from error
    if too_long:
        raise SourceError(TOO_LONG.format(contract.file_name))
    if rows == 0:
        raise SourceError(f"{contract.file_name} contains no data rows")
    return contract.file_name, rows, len(text.header)


def _difference(actual: list[str], expected: list[str]) -> str:
    problems = {
        "missing columns": [name for name in expected if name not in actual],
        "unexpected columns": [name for name in actual if name not in expected],
    }
    named = [f"{problem}: {', '.join(names)}" for problem, names in problems.items() if names]
    if named:
        return "; ".join(named)
    return "a column repeats" if len(actual) != len(expected) else "columns are in a different order"
