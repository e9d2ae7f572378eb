"""Document fingerprints: a Merkle tree over sections, paragraphs and short blocks.

A section ends after an empty line, a paragraph after a line break, a block after a sentence or
BLOCK code points, and together they hold every character. Paragraph digests make section
digests, these make the root: equal roots mean equal texts, and where roots differ, the branches
that differ show where. The share of common blocks says how alike two fingerprints are.
Everything is a Spark expression.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroll.llm.running import bound, running

BLOCK = 32
# Text that a block of neighbouring documents holds, more or less.
NEIGHBOUR_BYTES = 64 << 20
# Bytes of a text that place it in a block: a double holds them exactly.
_PLACE_BYTES = 6
_BLOCKS = rf"[^\n.!?]{{1,{BLOCK}}}+[\n.!?]*+|[\n.!?]++"


def _parts(text: Column, after: str) -> Column:
    return F.filter(F.split(text, f"(?<={after})", -1), lambda part: part != "")


def _paragraph(text: Column) -> Column:
    blocks = F.regexp_extract_all(text, F.lit(_BLOCKS), F.lit(0))
    short = F.transform(blocks, lambda block: F.hex(F.xxhash64(block).bitwiseAND(0xFFFFFFFF)))
    return F.struct(F.sha2(text, 256).alias("digest"), short.alias("blocks"))


def _digest(parts: Column) -> Column:
    return F.sha2(F.array_join(F.transform(parts, lambda part: part["digest"]), ""), 256)


def with_trees(rows: DataFrame, **texts: Column) -> DataFrame:
    """``rows`` with the tree of each named text: root, and sections of paragraphs of blocks."""
    lists = {
        name: F.transform(
            _parts(text, r"\n\n"), lambda section: F.transform(_parts(section, r"\n"), _paragraph)
        )
        for name, text in texts.items()
    }
    rows = rows.withColumns(lists)
    sections = {
        name: F.transform(name, lambda parts: F.struct(_digest(parts).alias("digest"), parts.alias("paragraphs")))
        for name in texts
    }
    rows = rows.withColumns(sections)
    return rows.withColumns(
        {name: F.struct(_digest(F.col(name)).alias("root"), F.col(name).alias("sections")) for name in texts}
    )


def blocks_of(tree: Column) -> Column:
    """The blocks of a tree in order."""
    return F.flatten(
        F.flatten(
            F.transform(
                tree["sections"],
                lambda section: F.transform(section["paragraphs"], lambda paragraph: paragraph["blocks"]),
            )
        )
    )


def fingerprint(tree: Column) -> Column:
    """The tree as text: root, then sections (;) with their paragraphs (/) and blocks (,)."""

    def paragraph(part: Column) -> Column:
        return F.concat(F.left(part["digest"], F.lit(8)), F.lit(":"), F.array_join(part["blocks"], ","))

    def section(part: Column) -> Column:
        paragraphs = F.array_join(F.transform(part["paragraphs"], paragraph), "/")
        return F.concat(F.left(part["digest"], F.lit(8)), F.lit("="), paragraphs)

    return F.concat(tree["root"], F.lit("|"), F.array_join(F.transform(tree["sections"], section), ";"))


def likeness(left: Column, right: Column, left_blocks: Column, right_blocks: Column) -> Column:
    """1 for equal roots, else the common share of the larger set of blocks."""
    common = F.size(F.array_intersect(left_blocks, right_blocks))
    larger = F.greatest(F.size(F.array_distinct(left_blocks)), F.size(F.array_distinct(right_blocks)))
    return F.when(left["root"] == right["root"], 1.0).otherwise(common / F.greatest(larger, F.lit(1)))


def _lacking(own: Column, other: Column) -> Column:
    """Numbers, from 0, of the digests of ``own`` that are not among those of ``other``.

    Both are sorted together, each digest of ``other`` once and ahead of the equal ones of ``own``;
    the greatest digest of ``other`` up to an element is then its own digest if it is there at all.
    """
    marked = F.concat(
        F.transform(F.array_distinct(other), lambda digest: F.struct(digest.alias("digest"), F.lit(-1).alias("place"))),
        F.transform(own, lambda digest, place: F.struct(digest.alias("digest"), place.alias("place"))),
    )

    def of_sorted(entries: Column) -> Column:
        theirs = F.transform(entries, lambda entry: F.when(entry["place"] < 0, entry["digest"]).otherwise(""))
        nearest = running(theirs, F.greatest, F.lit(""))
        missing = F.zip_with(entries, nearest, lambda entry, seen: F.when(entry["digest"] != seen, entry["place"]))
        return F.sort_array(F.filter(missing, lambda place: place.isNotNull()))

    return bound(F.sort_array(marked), of_sorted)


def changed_paragraphs(left: Column, right: Column) -> Column:
    """(section, paragraph) numbers of ``left`` whose branches ``right`` lacks, from 0.

    Sections found in ``right`` by digest are left out whole; in the others, paragraphs are.
    """

    def digests(parts: Column) -> Column:
        return F.transform(parts, lambda part: part["digest"])

    def paragraphs(sections: Column) -> Column:
        return F.flatten(F.transform(sections, lambda section: section["paragraphs"]))

    def of_sections(numbers: Column) -> Column:
        # The paragraphs of the sections that differ, each with its place.
        places = F.flatten(
            F.transform(
                numbers,
                lambda number: F.transform(
                    F.get(left["sections"], number)["paragraphs"],
                    lambda paragraph, place: F.struct(number.alias("section"), place.alias("paragraph")),
                ),
            )
        )
        own = F.flatten(F.transform(numbers, lambda number: digests(F.get(left["sections"], number)["paragraphs"])))
        lacking = _lacking(own, digests(paragraphs(right["sections"])))
        return bound(places, lambda found: F.transform(lacking, lambda number: F.get(found, number)))

    return bound(_lacking(digests(left["sections"]), digests(right["sections"])), of_sections)


def _block_number(bounds: list[float], doc_id: Column) -> Column:
    """How many of the ascending bounds are at most the id, by halving. They are one literal, however many."""
    table = F.from_json(F.lit(str(bounds)), "array<double>")

    def step(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        below = (state["low"] < state["high"]) & (F.get(table, middle) <= doc_id)
        return F.struct(
            F.when(below, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(below | (state["low"] >= state["high"]), state["high"]).otherwise(middle).alias("high"),
        )

    whole = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))
    rounds = len(bounds).bit_length() + 1
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), whole, step, lambda state: state["low"])


def with_next(documents: DataFrame) -> DataFrame:
    """``doc_id, text, next_text``: the text of the next document by ascending doc_id, after the last the first.

    Ids fall into blocks by their quantiles, as many as the size of the texts asks for. The first
    document of each block is copied to the block before it, so every block finds its neighbours
    alone. Null ids come first, ordered by text, in blocks by the texts' first bytes; however many
    of them share a text, it passes through once. Rows that repeat an id are ordered by text and
    share a block, and null texts are empty.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    with_id = F.col("doc_id").isNotNull()
    size = F.octet_length("text").cast("long")
    sizes = rows.agg(
        F.coalesce(F.sum(F.when(with_id, size)), F.lit(0)).alias("known"),
        F.coalesce(F.sum(F.when(~with_id, size)), F.lit(0)).alias("nameless"),
        F.count_if(~with_id).alias("n_nameless"),
    ).first()
    known = rows.where(with_id).withColumns({"place": F.col("doc_id"), "copies": F.lit(1).cast("long")})
    parted = known.withColumn("block", _block_number(_cuts(known, sizes.known), F.col("place").cast("double")))
    if sizes.n_nameless:
        # Bytes order texts as their characters do.
        first_bytes = F.expr(f"rpad(substring(cast(text AS binary), 1, {_PLACE_BYTES}), {_PLACE_BYTES}, X'00')")
        nameless = rows.where(~with_id).groupBy("text").agg(F.count("*").alias("copies"))
        nameless = nameless.select(
            F.lit(None).cast("long").alias("doc_id"), "text", F.conv(F.hex(first_bytes), 16, 10).cast("long").alias("place"), "copies"
        )
        cuts = _cuts(nameless, sizes.nameless)
        # Blocks below zero, so that they come before the others.
        number = _block_number(cuts, F.col("place").cast("double")) - (len(cuts) + 1)
        parted = parted.unionByName(nameless.withColumn("block", number))
    return _neighbours(parted)


def _cuts(rows: DataFrame, size: int) -> list[float]:
    """Places that part the rows into blocks of about equal numbers, as many as their size asks for."""
    count = 1 + size // NEIGHBOUR_BYTES
    if count == 1:
        return []
    return sorted(set(rows.approxQuantile("place", [number / count for number in range(1, count)], 1 / (4 * count))))


def _neighbours(parted: DataFrame) -> DataFrame:
    """``doc_id, text, next_text`` of rows in blocks, a row for each of their copies."""
    # A row for each block: where it begins, and the block before it.
    firsts = sorted(parted.groupBy("block").agg(F.min("place").alias("place")).collect())
    before = [row.block for row in firsts[-1:] + firsts[:-1]]
    table = json.dumps([[row.block, row.place, target] for row, target in zip(firsts, before, strict=True)])
    found = F.explode(F.from_json(F.lit(table), "array<array<bigint>>"))
    begins = parted.sparkSession.range(1).select(found.alias("row")).selectExpr(
        "cast(row[0] AS int) AS block", "row[1] AS place", "cast(row[2] AS int) AS target"
    )
    # As many rows as there are blocks.
    heads = (
        parted.join(F.broadcast(begins), ["block", "place"])
        .groupBy("target", "doc_id", "place")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "text", "place", F.lit(1).cast("long").alias("copies"), F.col("target").alias("block"), F.lit(True).alias("copy"))
    )
    window = Window.partitionBy("block").orderBy("copy", "place", "text")
    together = parted.withColumn("copy", F.lit(False)).unionByName(heads)
    lead = together.withColumn("next_text", F.lead("text").over(window)).where("not copy")
    # All copies of a row but the last are followed by an equal one.
    following = F.expr("explode(transform(sequence(1L, copies), n -> if(n < copies, text, next_text)))")
    return lead.select("doc_id", "text", following.alias("next_text"))


def edited(rows: DataFrame) -> DataFrame:
    """Rows with ``edited``: the last quarter of the code points replaced by the first as many of the next text."""
    size = F.length("text")
    quarter = F.floor(size / 4).cast("int")
    return rows.withColumn("edited", F.concat(F.left("text", size - quarter), F.left("next_text", quarter)))


def fingerprints(documents: DataFrame) -> DataFrame:
    """The tree of each text of ``documents(doc_id, text)``: ``doc_id, text, tree``, a row each.

    A null or empty text has no sections, and the root of nothing. A very long text counts whole,
    and has as many nodes as it has parts. Repeated rows have equal fingerprints; other columns are
    ignored; an empty table gives no rows.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return with_trees(rows, tree=F.col("text"))


def edit_report(documents: DataFrame) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    n_changed``: the last counts the paragraphs that the edit changed. The rules for null, empty
    and repeated rows are those of ``with_next``.
    """
    rows = with_trees(edited(with_next(documents)), own=F.col("text"), other=F.col("edited"), following=F.col("next_text"))
    names = ("own", "other", "following")
    rows = rows.withColumns({f"{name}_blocks": blocks_of(F.col(name)) for name in names})
    own, other, following = map(F.col, names)
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(own).alias("fingerprint"),
        fingerprint(other).alias("edited_fingerprint"),
        likeness(own, other, F.col("own_blocks"), F.col("other_blocks")).alias("near_edited"),
        likeness(own, following, F.col("own_blocks"), F.col("following_blocks")).alias("near_next"),
        F.size(changed_paragraphs(own, other)).cast("long").alias("n_changed"),
    )
