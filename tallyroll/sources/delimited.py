"""Delivered CSV files as all-text DataFrames, read as strictly as the contract asks."""

from __future__ import annotations

import csv
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroll.contracts import SOURCES, SourceContract
from tallyroll.errors import SourceError
from tallyroll.sources.files import Files

# A quoted field that closes, with doubled quotes inside.
_QUOTED = '"(?:[^"]|"")*+"'
MALFORMED = "_malformed"
BEYOND_HEADER = "_beyond_header"
TOO_LONG = "could not read {}: a row has more fields than the header"


@dataclass(frozen=True)
class SourceText:
    """What one pass over the raw text of a source shows before it is parsed."""

    header: list[str]
    valid_utf8: bool
    # The files with records over several lines; the others stay splittable.
    multiline_files: tuple[str, ...]


def source_path(directory: str, contract: SourceContract) -> str:
    return f"{directory.rstrip('/')}/{contract.file_name}"


def inspect_text(spark: SparkSession, directory: str, contract: SourceContract) -> SourceText:
    """Header, encoding and quoting of one source; a source may be a file or a folder of files.

    A record over several lines begins with a line in which a quoted field opens and does not
    close. Only files with such a line need the whole-file reader. A quote inside an unquoted
    field opens nothing. One pass over the text finds all of this. Quotes that stand in runs of even
    length close whatever they open, so lines with no others are not matched field by field.
    """
    path = source_path(directory, contract)
    files = Files(spark)
    if not files.exists(path):
        raise SourceError(f"required file not found: {path}")
    first_file = files.first_data_file(path)
    if first_file is None:
        raise SourceError(f"could not read {contract.file_name}: no columns to parse from file")

    closed_away = F.regexp_replace("value", f"(^|,){_QUOTED}", "$1")
    odd_quotes = F.contains(F.replace("value", F.lit('""'), F.lit("")), F.lit('"'))
    broken, multiline = (
        spark.read.text(path)
        .select("value", F.input_file_name().alias("file"))
        .agg(F.count_if(~F.is_valid_utf8("value")), F.collect_set(F.when(odd_quotes & closed_away.rlike('(^|,)"'), F.col("file"))))
        .first()
    )
    first_line = spark.read.text(first_file).where(F.trim("value") != "").first()
    if broken == 0 and first_line is None:
        raise SourceError(f"could not read {contract.file_name}: no columns to parse from file")
    header = next(csv.reader([first_line.value])) if first_line else []
    return SourceText(header, broken == 0, tuple(sorted(multiline)))


def read_source(
    spark: SparkSession, directory: str, contract: SourceContract, text: SourceText | None = None
) -> DataFrame:
    """The contract's columns of one source as text, renamed, in contract order.

    Columns are found by header name and extra ones are dropped. A blank cell is an empty
    string, never NULL. Short rows are padded; a row with more fields than the header, a
    part file with another header, or text that is not UTF-8 fails the read. Pass ``text``
    where the source has been inspected already, to save that pass over it.
    """
    text = text or inspect_text(spark, directory, contract)
    if not text.valid_utf8:
        raise SourceError(f"{contract.file_name} is not valid UTF-8")
    missing = [name for name in contract.headers if name not in text.header]
    if missing:
        raise SourceError(f"{contract.file_name} is missing columns: {', '.join(missing)}")
    return _parsed(spark, source_path(directory, contract), contract, text).select(
        *[F.col(f"`{header}`").alias(name) for header, name in contract.columns.items()]
    )


def read_sources(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """All contracted sources by Bronze table name."""
    return {contract.table: read_source(spark, directory, contract) for contract in SOURCES}


def count_rows(spark: SparkSession, directory: str, contract: SourceContract, text: SourceText) -> tuple[int, int]:
    """Data rows of a source, and how many of them have more fields than the header."""
    raw, too_long = _raw(spark, source_path(directory, contract), contract, text)
    # With any column pruned from the scan, Spark no longer compares field counts.
    every_column = F.coalesce(*[F.col(f"`{name}`") for name in text.header])
    counts = raw.agg(F.count(F.lit(1)), F.count_if(too_long), F.count(every_column)).first()
    return counts[0], counts[1]


def _parsed(spark: SparkSession, path: str, contract: SourceContract, text: SourceText) -> DataFrame:
    """The rows under their headers; one with more fields than the header fails the job."""
    raw, too_long = _raw(spark, path, contract, text)
    failure = F.raise_error(F.lit(TOO_LONG.format(contract.file_name)))
    first, *rest = text.header
    return raw.select(
        F.when(too_long, failure).otherwise(_text(first)).alias(first), *[_text(name).alias(name) for name in rest]
    )


def _raw(spark: SparkSession, path: str, contract: SourceContract, text: SourceText) -> tuple[DataFrame, Column]:
    """The rows as Spark parses them, and the condition that a row is too long."""
    folded = [name.casefold() for name in text.header]
    if len(set(folded)) < len(folded):
        raise SourceError(f"could not read {contract.file_name}: a column name repeats in the header")
    fields = [T.StructField(name, T.StringType()) for name in text.header]
    # enforceSchema=False makes the scan itself compare the header of every part file.
    reader = (
        spark.read.schema(T.StructType([*fields, T.StructField(MALFORMED, T.StringType())]))
        .option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", MALFORMED)
    )
    whole = set(text.multiline_files)
    split = [name for name in spark.read.text(path).inputFiles() if name not in whole] if whole else [path]
    raw = reader.csv([unquote(name) for name in split] if whole else split) if split else None
    if whole:
        parsed_whole = reader.option("multiLine", True).csv([unquote(name) for name in sorted(whole)])
        raw = raw.unionByName(parsed_whole) if raw is not None else parsed_whole
    # Spark drops surplus fields silently. It keeps the raw record of any row whose field
    # count is off, so only those few are parsed again, with one more field to catch it.
    wider = ", ".join(f"`{name}` string" for name in [*text.header, BEYOND_HEADER])
    again = F.from_csv(F.col(MALFORMED), wider, {"escape": '"'})
    return raw, F.col(MALFORMED).isNotNull() & again[BEYOND_HEADER].isNotNull()


def _text(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))
