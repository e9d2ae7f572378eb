"""Licence scans by canonical digests.

A text is brought to a canonical form: lower case, no copyright lines, one spelling of words that
have several, no punctuation. Whole texts, their lines, their paragraphs and runs of consecutive
paragraphs are then joined by the digest of that form to a table of known licence texts. The match
is of entire texts, so a word more or less is another text. Only forms as long as a known one get a
digest, and a run starts only where a known text could.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.llm.license_texts import full_texts

# Public licence texts and notices.
_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software.\n\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted"
)
_ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies"
_ISC_DISCLAIMER = (
    '.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY "
    "SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
    "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION "
    "WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_NOTICES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.",),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "GPL-3.0-only": ("This work is licensed under the GNU General Public License, version 3.",),
    "GPL-2.0-only": ("This work is licensed under the GNU General Public License, version 2.",),
}
_IDENTIFIERS = ("0BSD", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0-only", "GPL-3.0-only", "ISC", "MIT")
_IDENTIFIERS += ("GPL-2.0-or-later", "GPL-3.0-or-later")
LICENSES: tuple[tuple[str, str], ...] = (
    ("MIT", _GRANT),
    ("MIT", "MIT License\n\n" + _GRANT),
    ("MIT", "The MIT License (MIT)\n\n" + _GRANT),
    ("ISC", _ISC_GRANT + _ISC_NOTICE + _ISC_DISCLAIMER),
    ("ISC", "ISC License\n\n" + _ISC_GRANT + _ISC_NOTICE + _ISC_DISCLAIMER),
    ("0BSD", _ISC_GRANT + _ISC_DISCLAIMER),
    *((name, notice) for name, notices in _NOTICES.items() for notice in notices),
    *((name, f"SPDX-License-Identifier: {name}") for name in _IDENTIFIERS),
    *full_texts(),
)
# Equivalent spellings, as whole words of the canonical form.
SPELLINGS = {
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "sub license": "sublicense",
    "non commercial": "noncommercial",
    "non infringement": "noninfringement",
    "merchantibility": "merchantability",
    "acknowledgement": "acknowledgment",
    "whilst": "while",
    "organisation": "organization",
    "favour": "favor",
    "v": "version",
}
# A line that only states a copyright, in lower case; the rights reserved after it belong to it.
_STATED = r"(?:copyright\b|\(c\)|©)[^\n]*(?:19|20)[0-9][0-9][^\n]*|(?:copyright[ \t]*(?:\(c\)|©)|©)[^\n]*"
_RESERVED = r"all rights reserved\.?[ \t\r]*"
COPYRIGHT = rf"[ \t>*/#;-]*(?:{_STATED}|{_RESERVED})"
# A line that may state one or be a list's third item or a sentence. Texts are tried with and without it.
UNDATED = r"[ \t>*/#;-]*(?:\(c\)[^\n]*|copyright\b[^\n]*[0-9][^\n]*)"
# Spellings of two words, which a paragraph's end may part.
_PARTED = [(*found.split(), len(found) - len(said)) for found, said in SPELLINGS.items() if " " in found]
# Known texts travel to every task; more than this are not a list of licences.
MOST_KNOWN = 10_000


def _line_words(line: Column) -> Column:
    """A line's words of a-z and 0-9; none if it states a copyright."""
    low = F.lower(line)
    words = F.regexp_replace(F.replace(low, F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " ")
    return F.when(low.rlike(f"^{COPYRIGHT}$"), "").otherwise(words)


def _spelled(words: Column) -> Column:
    """Words in one spelling, with one space between and around them."""
    form = F.regexp_replace(F.concat(F.lit(" "), words, F.lit(" ")), " +", " ")
    for found, said in SPELLINGS.items():
        form = F.replace(form, F.lit(f" {found} "), F.lit(f" {said} "))
    return form


def canonical(text: Column) -> Column:
    """The canonical form of a text."""
    return _spelled(F.array_join(F.transform(F.split(text, "\n", -1), _line_words), " "))


def _first_words(form: Column) -> Column:
    """The first two words of a form."""
    return F.substring_index(F.substr(form, F.lit(2)), " ", 2)


def known_digests(spark: SparkSession, texts: tuple[tuple[str, str], ...] = LICENSES) -> DataFrame:
    """``license, digest, size, head`` of the known texts' forms, made by the same expression."""
    if len(texts) > MOST_KNOWN:
        raise ValueError(f"more than {MOST_KNOWN} known texts")
    rows = spark.createDataFrame(list(texts), "license string, text string")
    forms = rows.select("license", canonical(F.col("text")).alias("form"))
    return forms.select(
        "license",
        F.sha2("form", 256).alias("digest"),
        F.length("form").alias("size"),
        _first_words(F.col("form")).alias("head"),
    ).distinct()


def _unit(form: Column, whole: bool = False) -> Column:
    return F.struct(form.alias("form"), F.lit(whole).alias("whole"))


def _runs(paragraphs: Column, sizes: list[int], heads: list[str]) -> Column:
    """The forms of two and more consecutive ``paragraphs(words, form)`` that may be a known text.

    A run starts with the first words of a known text, or where a spelling of two words may join
    the first paragraphs, and has a known text's length.
    """

    def opens(form: Column) -> Column:
        found = F.lit(False)
        for first, _, _ in _PARTED:
            found = found | form.endswith(f" {first} ")
        return found

    def starts(place: Column) -> Column:
        form = F.get(paragraphs, place - 1)["form"]
        following = F.coalesce(F.get(paragraphs, place)["form"], F.lit(" "))
        return _first_words(F.concat(F.rtrim(form), following)).isin(heads) | opens(form) | opens(following)

    def shorter(before: Column, form: Column) -> Column:
        joined = F.lit(0)
        for first, second, letters in _PARTED:
            both = before.endswith(f" {first} ") & form.startswith(f" {second} ")
            joined = F.when(both, letters).otherwise(joined)
        return F.when(opens(before), joined).otherwise(0)

    def longer(seen: Column, paragraph: Column) -> Column:
        form, count = paragraph["form"], seen["count"] + 1
        size = seen["size"] + F.length(form) - 1 - shorter(seen["before"], form)
        ends = F.when((count > 1) & size.isin(sizes), F.concat(seen["ends"], F.array(count))).otherwise(seen["ends"])
        return F.struct(count.alias("count"), size.alias("size"), form.alias("before"), ends.alias("ends"))

    def run(start: Column, count: Column) -> Column:
        words = F.transform(F.slice(paragraphs, start, count), lambda paragraph: paragraph["words"])
        return _unit(_spelled(F.array_join(words, " ")))

    none = F.struct(F.lit(0).alias("count"), F.lit(1).alias("size"), F.lit("").alias("before"), F.array().cast("array<int>").alias("ends"))

    def of_start(start: Column) -> Column:
        ends = F.aggregate(F.slice(paragraphs, start, F.lit(max(sizes))), none, longer, lambda seen: seen["ends"])
        return F.transform(ends, lambda count: run(start, count))

    return F.flatten(F.transform(F.filter(F.sequence(F.lit(1), F.size(paragraphs)), starts), of_start))


def _forms(lines: Column, sizes: list[int], heads: list[str]) -> Column:
    """The forms of a text, its lines, its paragraphs and their runs, from its lines' words."""
    none = F.array().cast("array<struct<form:string,whole:boolean>>")
    text = F.array_join(lines, " ")

    def of_paragraphs(paragraphs: Column) -> Column:
        alone = F.transform(paragraphs, lambda paragraph: _unit(paragraph["form"]))
        return F.when(F.size(paragraphs) > 1, F.concat(alone, _runs(paragraphs, sizes, heads))).otherwise(alone)

    paragraphs = F.filter(
        F.transform(F.split(text, "\n"), lambda words: F.struct(words.alias("words"), _spelled(words).alias("form"))),
        lambda paragraph: F.length(paragraph["form"]) > 1,
    )
    # A transform of one element, so that the paragraphs are made once.
    parts = F.flatten(F.transform(F.array(paragraphs), of_paragraphs))
    return F.concat(
        F.transform(F.array(F.replace(text, F.lit("\n"), F.lit(" "))), lambda words: _unit(_spelled(words), True)),
        F.when(F.contains(text, F.lit("\n")), parts).otherwise(none),
        F.transform(lines, lambda words: _unit(_spelled(words))),
    )


def with_forms(rows: DataFrame, sizes: list[int], heads: list[str]) -> DataFrame:
    """``rows`` with ``forms``: those of the whole text, its paragraphs, their runs and its lines, marked if whole.

    Lines are brought to their form once and joined for the others. Forms that have no known one's
    length cannot match and are left out.
    """

    def words(line: Column) -> Column:
        return F.when(F.btrim(line, F.lit(" \t\r")) == "", "\n").otherwise(_line_words(line))

    def without_undated(line: Column) -> Column:
        return F.when(F.lower(line).rlike(f"^{UNDATED}$"), "").otherwise(words(line))

    lines = F.split("text", "\n", -1)
    undated = F.when(F.col("text").rlike(f"(?im)^{UNDATED}$"), F.transform(lines, without_undated))
    rows = rows.withColumns({"lines": F.transform(lines, words), "fewer": undated})
    fewer = F.when(F.col("fewer").isNotNull(), _forms(F.col("fewer"), sizes, heads)).otherwise(F.array())
    found = F.concat(_forms(F.col("lines"), sizes, heads), fewer)
    known = F.filter(found, lambda unit: F.length(unit["form"]).isin(sizes) & (F.length(unit["form"]) > 1))
    return rows.withColumn("forms", known).drop("lines", "fewer")


def license_scan(documents: DataFrame, texts: tuple[tuple[str, str], ...] = LICENSES) -> DataFrame:
    """``doc_id, n_licenses, licenses, whole_license`` of ``documents(doc_id, text)``, a row each.

    ``licenses`` names those found, sorted and comma-joined; ``whole_license`` is the one whose
    text the whole document is, else null. A null or empty text has none; a very long text is
    scanned whole, in runs no longer than the longest known text; repeated rows have equal results; rows that share an id are told apart by their text; other columns are ignored; an
    empty table gives no rows.
    """
    known = known_digests(documents.sparkSession, texts)
    table = known.select("size", "head").distinct().collect()
    sizes = sorted({row.size for row in table} | {0})
    heads = sorted({row.head for row in table} | {""})
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = (
        with_forms(rows, sizes, heads)
        .select("doc_id", F.sha2("text", 256).alias("text_digest"), F.explode("forms").alias("unit"))
        .select("doc_id", "text_digest", "unit.whole", F.sha2("unit.form", 256).alias("digest"))
        .join(F.broadcast(known.select("license", "digest")), "digest")
        .groupBy("doc_id", "text_digest")
        .agg(
            F.array_sort(F.collect_set("license")).alias("names"),
            F.min(F.when(F.col("whole"), F.col("license"))).alias("whole_license"),
        )
    )
    mine = rows.select("doc_id", F.sha2("text", 256).alias("text_digest")).alias("mine")
    joined = mine.join(
        found.alias("found"),
        F.col("mine.doc_id").eqNullSafe(F.col("found.doc_id")) & (F.col("mine.text_digest") == F.col("found.text_digest")),
        "left",
    )
    names = F.coalesce("names", F.array().cast("array<string>"))
    return joined.select(
        F.col("mine.doc_id").alias("doc_id"),
        F.size(names).cast("long").alias("n_licenses"),
        F.array_join(names, ",").alias("licenses"),
        "whole_license",
    )


def oracle_sql(texts: tuple[tuple[str, str], ...] = LICENSES) -> str:
    """The same scan in DuckDB SQL, with forms compared in place of digests."""

    def form(text: str) -> str:
        sql = f"regexp_replace(lower({text}), '(?m)^{COPYRIGHT}$', ' ', 'g')"
        sql = f"' ' || regexp_replace(replace({sql}, '&', ' and '), '[^a-z0-9]+', ' ', 'g') || ' '"
        sql = f"regexp_replace({sql}, ' +', ' ', 'g')"
        for found, said in SPELLINGS.items():
            sql = f"replace({sql}, ' {found} ', ' {said} ')"
        return sql

    values = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in texts)
    return f"""
        WITH known AS (
            SELECT DISTINCT license, {form("text")} AS form FROM (VALUES {values}) AS texts(license, text)
        ), rows AS (
            SELECT doc_id, coalesce(text, '') AS text FROM documents
        ), units AS (
            SELECT doc_id, text, text AS unit, TRUE AS whole FROM rows
            UNION ALL
            SELECT doc_id, text, unnest(string_split_regex(text, '\\n[ \\t]*\\n')), FALSE FROM rows
            UNION ALL
            SELECT doc_id, text, unnest(string_split(text, chr(10))), FALSE FROM rows
        ), found AS (
            SELECT doc_id, text, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
                   count(DISTINCT license) AS n, min(license) FILTER (WHERE whole) AS whole_license
            FROM (SELECT doc_id, text, whole, {form("unit")} AS form FROM units)
            JOIN known USING (form)
            GROUP BY doc_id, text
        )
        SELECT r.doc_id, coalesce(f.n, 0) AS n_licenses, coalesce(f.licenses, '') AS licenses, f.whole_license
        FROM rows r LEFT JOIN found f ON r.doc_id IS NOT DISTINCT FROM f.doc_id AND r.text = f.text
    """
