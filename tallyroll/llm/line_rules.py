"""Line-first cleaning: rules judge each line, failing lines go, and a text that loses too much is rejected.

A text is read whole, line by line, in time linear in its length; a line that is repeated is judged once.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tallyroll.llm.batches import map_slices

# The base rules are fixed values of the result's contract.
FEWEST_WORDS = 50
MOST_REPEATED_PERCENT = 50
# A text may lose up to this share of its word characters with its failing lines.
MOST_LOST = 0.5
# Lines longer than this in words are prose, whatever phrase they hold.
BOILERPLATE_WORDS = 25
# Words from which a line without any mark fails. Every line of the labelled clean documents, in all
# their languages, has one; headings and items of lists, which need none, are shorter.
UNMARKED_WORDS = 20
# Words from which a line in capitals fails without an exclamation mark: headings are shorter.
LOUD_WORDS = 8
# Lines in a row, of so many words at most and without a mark, that make a menu.
MENU_LINES, MENU_WORDS = 4, 3

_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Signs that part items wherever they stand, and those that do only as words of their own.
_PARTS = re.compile(r"[|•·»›]|(?<![^\x20\x09-\x0D])[>—–\-*/](?![^\x20\x09-\x0D])")
_MARKS = re.compile(r"[.,;:!?…。！？、]")
_SYMBOL_RUN = re.compile(r"[#*$%&|<>]")
# Phrases of page furniture.
BOILERPLATE = re.compile(
    r"all rights reserved|cookie|privacy policy|terms of (?:use|service)|javascript|click here|read more"
    r"|sign (?:in|up)|log ?in|subscribe|newsletter|share this|skip to (?:main )?content|lorem ipsum|powered by",
    re.IGNORECASE,
)


def line_verdict(line: str) -> str:
    """The rule a line fails, or an empty text: navigation, symbols, shouting, punctuation or boilerplate.

    A line without a word passes. Shares are of the line's words.
    """
    words = _WORD.findall(line)
    count = len(words)
    if not count:
        return ""
    separators = len(_PARTS.findall(line))
    if separators >= 3 and 5 * separators >= len(_WORD.findall(_PARTS.sub(" ", line))):
        return "navigation"
    if count >= 3 and 2 * sum(bool(_SYMBOL_RUN.search(word)) for word in words) > count:
        return "symbols"
    letters = sum(map(str.isalpha, line))
    loud = count >= LOUD_WORDS or (count >= 5 and "!" in line)
    if loud and letters >= 20 and 5 * sum(map(str.isupper, line)) > 4 * letters:
        return "shouting"
    if count >= UNMARKED_WORDS and not _MARKS.search(line):
        return "punctuation"
    if count <= BOILERPLATE_WORDS and BOILERPLATE.search(line):
        return "boilerplate"
    return ""


def menu_lines(lines: list[str]) -> set[int]:
    """Numbers of the lines that stand in a menu of one short item a line; blank lines neither count nor part."""
    found: set[int] = set()
    run: list[int] = []
    for number, line in enumerate([*lines, "the end."]):
        words = len(_WORD.findall(line)) if len(line) < 200 else (MENU_WORDS + 1) * bool(_WORD.search(line))
        if words and (words > MENU_WORDS or _MARKS.search(line)):
            if len(run) >= MENU_LINES:
                found.update(run)
            run = []
        elif words:
            run.append(number)
    return found


@dataclass(frozen=True)
class Judged:
    """A text's base measures, verdicts and what its passing lines leave."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_bad_lines: int
    lost: float
    base_failed: bool
    kept: bool
    clean: str


def _word_chars(text: str) -> int:
    return len(text) - sum(map(text.count, _SPACE))


def repeated_words(words: list) -> int:
    """Words in three-word windows that occur twice or more, first occurrences included."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, upto = 0, 0
    for place, window in enumerate(windows):
        if counts[window] > 1:
            covered += place + 3 - max(place, upto)
            upto = place + 3
    return covered


def judge(text: str) -> Judged:
    """The base measures and both verdicts of a whole text."""
    # ASCII white space alone parts words, which is how bytes are split.
    words = text.encode().split()
    n_words, word_chars = len(words), _word_chars(text)
    seen, repeats = set(), 0
    kept_lines, bad_lines, lost = [], 0, 0
    verdicts: dict[str, str] = {}
    lines = text.split("\n")
    menu = menu_lines(lines)
    for number, line in enumerate(lines):
        if line in seen:
            repeats += 1
        elif _word_chars(line):
            seen.add(line)
        verdict = verdicts.get(line)
        if verdict is None:
            verdict = verdicts[line] = line_verdict(line)
        if verdict or number in menu:
            bad_lines += 1
            lost += _word_chars(line)
        else:
            kept_lines.append(line)
    n_repeat_words = repeated_words(words)
    base_failed = n_words < FEWEST_WORDS or 100 * n_repeat_words > MOST_REPEATED_PERCENT * n_words
    share = lost / word_chars if word_chars else 0.0
    return Judged(
        n_words,
        word_chars,
        sum(map(text.count, _SYMBOLS)),
        repeats,
        n_repeat_words,
        bad_lines,
        share,
        base_failed,
        not base_failed and share <= MOST_LOST,
        "\n".join(kept_lines) if bad_lines else text,
    )


_FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_bad_lines long, lost double, base_failed boolean, kept boolean, clean string"
)


def judged(documents: DataFrame) -> DataFrame:
    """``all, judged``: each row of ``documents(text, ...)`` beside its measures, verdicts and clean text.

    A null or empty text has no words and fails. A very long text is judged whole, by all of its
    lines. Repeated rows are judged alike; ``all`` holds the row's own columns, whatever their
    names; an empty table gives no rows.
    """
    rows = documents.select(F.struct(*[documents[f"`{name}`"] for name in documents.columns]).alias("all"))
    fields = StructType.fromDDL(_FIELDS)
    schema = StructType([*rows.schema.fields, StructField("judged", fields)])
    names = fields.names

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [judge(text or "") for text in batch.column("all").field("text").to_pylist()]
        kinds = {"lost": pa.float64(), "base_failed": pa.bool_(), "kept": pa.bool_(), "clean": pa.string()}
        columns = [pa.array([getattr(each, name) for each in found], kinds.get(name, pa.int64())) for name in names]
        return pa.RecordBatch.from_arrays(
            [batch.column("all"), pa.StructArray.from_arrays(columns, names=names)], names=["all", "judged"]
        )

    return map_slices(rows, run, schema, "all.text")


def line_quality(documents: DataFrame) -> DataFrame:
    """``doc_id`` with the measures and verdicts of ``judged``, without the clean text."""
    fields = [name for name in StructType.fromDDL(_FIELDS).names if name != "clean"]
    return judged(documents.select("doc_id", "text")).select("all.doc_id", *[f"judged.{name}" for name in fields])


def cleaned(documents: DataFrame) -> DataFrame:
    """The documents that are kept, without their failing lines; ``n_chars`` is counted anew where lines went."""
    changed = F.col("judged.n_bad_lines") > 0
    columns = []
    for field in documents.schema.fields:
        value = F.col("all")[field.name]
        if field.name == "text":
            value = F.col("judged.clean")
        elif field.name == "n_chars":
            value = F.when(changed, F.length("judged.clean").cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return judged(documents).where("judged.kept").select(columns)
