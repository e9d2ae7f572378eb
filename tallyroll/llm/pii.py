"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Everything is a Spark expression. A pattern splits a text into what lies between its matches, and
running totals of both lengths give every match's place in code points. Patterns begin at the head of a run
of their first class and are possessive where that finds the same matches, and no repetition
nests calls. So a very long text, or one with very many matches, takes time in proportion to its
length and, for n matches, to n log n. A kind is skipped where a text lacks what it needs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.running import bound, parts, piece, running

# Code points looked at on either side of a match for context words.
NEARBY = 40
# Score from which spans of the added kinds are kept.
KEPT_SCORE = 0.5


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a digit string is right: from the right, every second digit doubles."""
    size = F.length(digits)

    def add(total: Column, place: Column) -> Column:
        value = F.ascii(digits.substr(place, F.lit(1))) - 48
        doubled = F.when(value > 4, 2 * value - 9).otherwise(2 * value)
        return total + F.when((size - place) % 2 == 1, doubled).otherwise(value)

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account number leaves 1 by 97 once its first four characters are moved to the end."""
    moved = F.concat(code.substr(F.lit(5), F.length(code)), code.substr(1, 4))

    def add(rest: Column, place: Column) -> Column:
        sign = F.ascii(moved.substr(place, F.lit(1)))
        return F.when(sign > 57, (rest * 100 + sign - 55) % 97).otherwise((rest * 10 + sign - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add) == 1


def _is_ip(match: Column) -> Column:
    return F.forall(F.split(match, "[.]"), lambda part: F.coalesce(part.try_cast("decimal(38,0)") <= 255, F.lit(False)))


def _is_card(match: Column) -> Column:
    return F.length(_digits(match)).between(12, 19) & luhn(_digits(match))


def _is_phone(match: Column) -> Column:
    return F.length(_digits(match)).between(9, 15)


def _is_iban(match: Column) -> Column:
    compact = F.regexp_replace(match, " ", "")
    return (F.length(compact) <= 34) & mod97(compact)


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: its pattern, a pattern texts must contain, its check, score and context.

    Spans of a base kind stay whatever their score; those of others need KEPT_SCORE.
    """

    name: str
    pattern: str
    needs: str
    confirmed: Callable[[Column], Column]
    score: float
    context: str
    base: bool = True
    bonus: float = 0.3


_LOCAL = "[A-Za-z0-9._%+-]"
# The names, order and matches of the base kinds are fixed values of the result's contract.
KINDS = (
    Kind(
        "email",
        rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        lambda match: F.lit(True),
        0.9,
        "mail|contact|write to|correo|kontakt",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]\.[0-9]",
        _is_ip,
        0.6,
        "address|host|server|login|client",
    ),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9]", _is_card, 0.7, "card|visa|credit|payment|karte|tarjeta|carte"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", _is_phone, 0.7, "phone|call|tel|mobile|fax|anruf"),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
        "[A-Z]{2}[0-9]{2}",
        _is_iban,
        0.8,
        "iban|account|bank|konto|cuenta|compte",
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        "[0-9]-[0-9]",
        lambda match: F.lit(True),
        0.3,
        "ssn|social.security",
        base=False,
    ),
)
_SPAN = "struct<start:int,rank:int,kind:string,end:int,score:double>"


def _kind_spans(kind: Kind, rank: int) -> Column:
    """The kind's confirmed spans by place, from its matches and the gaps around them.

    A match ends where the lengths of all gaps and matches up to it add up to.
    """
    gaps, matches = F.col(f"gaps_{kind.name}"), F.col(f"matches_{kind.name}")
    sizes = F.zip_with(matches, F.slice(gaps, F.lit(1), F.size(matches)), lambda match, gap: F.length(match) + F.length(gap))
    ends = running(sizes, lambda before, size: before + size, F.lit(0))
    near = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(matches)),
        F.slice(gaps, F.lit(2), F.size(matches)),
        lambda before, after: F.lower(F.concat(F.right(before, F.lit(NEARBY)), F.lit(" "), F.left(after, F.lit(NEARBY)))),
    )
    placed = F.zip_with(matches, ends, lambda match, end: F.struct(match.alias("match"), end.alias("end")))

    def span(place: Column, words: Column) -> Column:
        bonus = F.when(words.rlike(kind.context), kind.bonus).otherwise(0.0)
        kept = kind.confirmed(place["match"])
        score = F.least(F.lit(1.0), F.lit(kind.score) + bonus)
        if not kind.base:
            kept = kept & (score >= KEPT_SCORE)
        return F.when(
            kept,
            F.struct(
                (place["end"] - F.length(place["match"])).alias("start"),
                F.lit(rank).alias("rank"),
                F.lit(kind.name).alias("kind"),
                place["end"].alias("end"),
                score.alias("score"),
            ),
        )

    return F.filter(F.zip_with(placed, near, span), lambda found: found.isNotNull())


def with_spans(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` with ``text`` and all its ``spans``, by start and then kind; rows keep no clashing names."""
    rows = rows.withColumn("text", F.coalesce(text, F.lit("")))
    lists = {}
    for kind in KINDS:
        wanted = F.col("text").rlike(kind.needs)
        nothing = F.array().cast("array<string>")
        lists[f"matches_{kind.name}"] = F.when(
            wanted, F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(0))
        ).otherwise(nothing)
        lists[f"gaps_{kind.name}"] = F.when(wanted, F.split("text", kind.pattern, -1)).otherwise(nothing)
    kinds = [_kind_spans(kind, rank) for rank, kind in enumerate(KINDS)]
    names = rows.columns
    return rows.withColumns(lists).withColumn("spans", F.array_sort(F.concat(*kinds))).select(*names, "spans")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind; of overlapping spans the first names the cut."""

    def of_ends(text_parts: Column, ends: Column) -> Column:
        # What lies before a span begins where the farthest span before it ends.
        before = F.concat(F.array(F.lit(0)), ends)

        def cut(span: Column, at: Column) -> Column:
            name = F.concat(piece(text_parts, at, span["start"]), F.lit("["), F.upper(span["kind"]), F.lit("]"))
            return F.when(span["start"] >= at, name).otherwise("")

        cuts = F.zip_with(spans, F.slice(before, F.lit(1), F.size(spans)), cut)
        rest = piece(text_parts, F.element_at(before, -1), F.length(text))
        return F.concat(F.array_join(cuts, ""), rest)

    ends = running(F.transform(spans, lambda span: span["end"]), F.greatest, F.lit(0))
    return bound(parts(text), lambda text_parts: bound(ends, lambda found: of_ends(text_parts, found)))


def personal_data(documents: DataFrame) -> DataFrame:
    """``doc_id, text, spans`` of ``documents(doc_id, text)``, a row each, repeated rows too.

    A span has kind, start, end (code points, end exclusive) and score. A null or empty text has
    no spans and is given as empty. Other columns are ignored; an empty table gives no rows.
    """
    return with_spans(documents.select("doc_id", "text"), F.col("text"))


def _joined(spans: Column) -> Column:
    written = F.transform(spans, lambda span: F.concat_ws(":", span["kind"], span["start"], span["end"]))
    return F.array_join(written, ",")


def span_digests(found: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of found spans."""
    base = [kind.name for kind in KINDS if kind.base]

    def of(*names: str) -> Column:
        return F.filter("spans", lambda span: span["kind"].isin(*names))

    counts = [F.size(of(name)).cast("long").alias(f"n_{name}") for name in base]
    kept = of(*base)
    return found.select("doc_id", *counts, F.sha2(_joined(kept), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def without_personal_data(documents: DataFrame) -> DataFrame:
    """The documents with spans replaced in ``text`` and ``n_chars`` counted anew; other columns as they were.

    A text without spans stays as it was, null included.
    """
    rows = documents.select(F.struct(*[documents[f"`{name}`"] for name in documents.columns]).alias("all"))
    found = with_spans(rows, F.col("all.text")).withColumn("new", redacted(F.col("text"), F.col("spans")))
    changed = F.size("spans") > 0
    columns = []
    for field in documents.schema.fields:
        value = F.col("all")[field.name]
        if field.name == "text":
            value = F.when(changed, F.col("new")).otherwise(value)
        elif field.name == "n_chars":
            value = F.when(changed, F.length("new").cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return found.select(columns)
