"""Running totals over arrays, and pieces of long texts, as Spark expressions without growing arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points of a part of a text: a piece of the text is cut from the parts it lies in.
PART = 4096


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, add: Callable[[Column, Column], Column], nothing: Column) -> Column:
    """The totals of ``values`` up to and with each element, by doubling: n log n steps for n elements.

    Each round adds to every element the total that stands 1, 2, 4 ... places before it. ``nothing``
    is what stands before the first; ``add`` must be associative.
    """
    steps = F.array(*[F.lit(1 << power) for power in range(31)])

    def double(totals: Column, step: Column) -> Column:
        earlier = F.concat(F.array_repeat(nothing, step), F.slice(totals, F.lit(1), F.size(totals) - step))
        return F.zip_with(earlier, totals, lambda before, value: add(before, value))

    def of_size(size: Column) -> Column:
        return F.filter(steps, lambda step: step < size)

    return bound(values, lambda given: F.aggregate(bound(F.size(given), of_size), given, double))


def parts(text: Column) -> Column:
    """The text in parts of PART code points; the last may be shorter."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}+"), F.lit(0))


def piece(text_parts: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` up to ``end`` (exclusive) of a text in parts."""
    first = F.floor(start / PART).cast("int")
    last = F.floor(end / PART).cast("int")
    around = F.array_join(F.slice(text_parts, first + 1, last - first + 1), "")
    return F.when(end > start, F.substring(around, start - first * PART + 1, end - start)).otherwise("")
