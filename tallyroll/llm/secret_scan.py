"""Secrets in texts: fixed patterns, and candidate strings whose windows hold much entropy.

A candidate is a run of characters that keys are written in. The narrowest class of characters
that holds all of it sets the length of a window and the entropy it must reach. A window moves
over the candidate a character at a time; only the counts of the character that leaves and of the
one that enters change, so the work is linear in the text however long a candidate is. Windows
that reach their class's entropy and mix letters with digits are merged into spans, unless an
allow-list knows the candidate as something else.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.batches import id_and_text, map_slices, texts_of

# The names, order, patterns and least lengths of the base kinds are fixed values of the result's contract.
_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
# Runs shorter than this fail, and a longer run is found whole from its first character.
_HEX = re.compile("[0-9a-f]{24,}")
SHORTEST_ASSIGNED, SHORTEST_ACCESS = 6, 20
BASE = ("assign", "access", "hex")
ADDED = "entropy"
KINDS = (*BASE, ADDED)


@dataclass(frozen=True)
class CharacterClass:
    """Characters a key may be written in, the window judged at once, and the bits a character it must hold.

    Random strings of a class reach its threshold in all but a few windows; words, paths and
    identifiers written in it do not.
    """

    name: str
    holds: re.Pattern
    window: int
    least_bits: float


# From the narrowest class to the widest; the last holds every candidate.
CLASSES = (
    CharacterClass("hex", re.compile("[0-9a-f]+|[0-9A-F]+"), 24, 2.9),
    CharacterClass("upper", re.compile("[A-Z0-9]+"), 20, 3.5),
    CharacterClass("lower", re.compile("[a-z0-9]+"), 20, 3.5),
    CharacterClass("base64", re.compile("[A-Za-z0-9+/_=-]+"), 20, 3.75),
)
CANDIDATE = re.compile("[A-Za-z0-9+/_=-]{20,}")
# Fewest digits and letters of a window that counts.
FEWEST_DIGITS, FEWEST_LETTERS = 2, 4

# What a candidate is known as instead: by its own characters, or by what stands before it.
ALLOWED = re.compile(
    r"(?ai:example|sample|dummy|placeholder|changeme|change[_-]me|your[_-]|redacted|xxxx)"
    r"|[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
    r"|(?ai:abcdefghij|0123456789|1234567890|qwertyuiop)"
    r"|\A(?ai:sha(?:1|256|384|512)|md5)[-=]"
)
ALLOWED_BEFORE = re.compile(
    r"(?ai:;base64,|\b(?:sha-?(?:1|256|384|512)|md5|crc32|etag|commit|revision|digest|checksum|integrity)\b\W{0,3})\Z"
)
# Code points before a candidate that the allow-list may look at.
_BEFORE = 24


def entropies(text: str, window: int) -> Iterator[tuple[int, float]]:
    """Start and Shannon entropy, in bits a character, of every window of a text at least as long.

    The sum of n * log2(n) over the characters' counts n is kept up to date by the two counts that change.
    """
    terms = [0.0, *(n * math.log2(n) for n in range(1, window + 1))]
    counts: dict[str, int] = {}
    total = 0.0
    for place, entering in enumerate(text):
        start = place - window + 1
        if start > 0:
            leaving = text[start - 1]
            count = counts[leaving]
            counts[leaving] = count - 1
            total += terms[count - 1] - terms[count]
        count = counts.get(entering, 0)
        counts[entering] = count + 1
        total += terms[count + 1] - terms[count]
        if start >= 0:
            yield start, math.log2(window) - total / window


def hot_ranges(text: str, kind: CharacterClass) -> list[tuple[int, int, float]]:
    """Ranges of a candidate covered by windows that count, with the most bits a character in each."""
    digits = letters = 0
    counted = 0
    found: list[tuple[int, int, float]] = []
    for start, bits in entropies(text, kind.window):
        end = start + kind.window
        for entering in text[counted:end]:
            digits += entering.isdigit()
            letters += entering.isalpha()
        counted = end
        if start:
            digits -= text[start - 1].isdigit()
            letters -= text[start - 1].isalpha()
        mixed = digits >= FEWEST_DIGITS and letters >= FEWEST_LETTERS
        if bits < kind.least_bits or not mixed:
            continue
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], end, max(found[-1][2], bits))
        else:
            found.append((start, end, bits))
    return found


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of the base kinds' matches that pass, in no order."""
    found = []
    if "=" in text or ":" in text:
        found += [(*match.span(), "assign") for match in _ASSIGN.finditer(text) if len(match[1]) >= SHORTEST_ASSIGNED]
    if "AKIA" in text:
        found += [(*match.span(), "access") for match in _ACCESS.finditer(text) if len(match[0]) >= SHORTEST_ACCESS]
    found += [(*match.span(), "hex") for match in _HEX.finditer(text)]
    return found


def _outside(ranges: list[tuple[int, int, float]], taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, float]]:
    """The ranges that overlap no taken one; both ascend and no two taken ones overlap."""
    at = 0
    for start, end, bits in ranges:
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at == len(taken) or taken[at][0] >= end:
            yield start, end, bits


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def secret_spans(text: str) -> list[tuple[int, int, str, float | None]]:
    """Start, end (exclusive, code points), kind and bits of all secrets, by start and then kind.

    Base spans stay whatever the allow-list says; an added span overlaps none of them.
    """
    base = base_spans(text)
    ranges = []
    for candidate in CANDIDATE.finditer(text):
        value, start = candidate[0], candidate.start()
        kind = next(each for each in CLASSES if each.holds.fullmatch(value))
        if len(value) < kind.window:
            continue
        hot = hot_ranges(value, kind)
        if not hot or ALLOWED.search(value) or ALLOWED_BEFORE.search(text[max(0, start - _BEFORE) : start]):
            continue
        ranges += [(start + first, start + last, bits) for first, last, bits in hot]
    taken = _merged([(start, end) for start, end, _ in base])
    found = [(start, end, kind, None) for start, end, kind in base]
    found += [(start, end, ADDED, bits) for start, end, bits in _outside(ranges, taken)]
    return sorted(found, key=lambda span: (span[0], KINDS.index(span[2])))


_SPANS = "array<struct<kind:string,start:int,end:int,bits:double>>"


def secrets(documents: DataFrame) -> DataFrame:
    """``doc_id, text, spans`` of ``documents(doc_id, text)``, a row each, repeated rows too.

    A span has kind, start, end (code points, end exclusive) and, for the added kind, its bits of
    entropy a character. Spans ascend by start; those that start together are in the order of
    ``KINDS``. A null or empty text has no spans and is given as empty. A very long text is
    scanned whole, in time linear in its length. Other columns are ignored; an empty table gives
    no rows.
    """

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("bits", pa.float64())])
        found = [
            [{"kind": kind, "start": start, "end": end, "bits": bits} for start, end, kind, bits in secret_spans(text)]
            for text in texts_of(batch)
        ]
        spans = pa.array(found, pa.list_(kind))
        return pa.RecordBatch.from_arrays([*batch.columns, spans], names=["doc_id", "text", "spans"])

    rows = id_and_text(documents)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_slices(rows, scan, f"doc_id {kind}, text string, spans {_SPANS}")


def _joined(spans: Column) -> Column:
    written = F.transform(spans, lambda span: F.concat_ws(":", span["kind"], span["start"], span["end"]))
    return F.array_join(written, ",")


def secret_digests(found: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans`` of found secrets."""

    def of(*names: str) -> Column:
        return F.filter("spans", lambda span: span["kind"].isin(*names))

    counts = [F.size(of(name)).cast("long").alias(f"n_{name}") for name in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_joined(of(*BASE)), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
