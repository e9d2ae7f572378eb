"""Near duplicates by MinHash bands, odd sketches and exact word shingles.

Every document becomes a set of five-word shingles; equal sets form one class. MinHash samples
of a class give band keys, which find candidates, and are folded into an odd sketch: each sample
flips one bit of a bitmap, so the population count of two bitmaps' XOR estimates how many
samples differ, precisely where similarity is high. Pairs whose sketches are far apart are
dropped with a margin of six standard deviations; the others are confirmed on the full sets.

No band emits all its pairs. Its members are compared with one centre, the member that shares
bands most. Members the centre joins need no pairs among themselves. The rest are compared with
everyone beside the same centre in blocks of bounded size, each block pair in a task of its own,
which returns only a spanning forest of the links it confirmed. Components are therefore those of
all links. A member that a centre did not take is sent once for each block beside that centre, so
this part grows with the square of such members: n of them send n * n / 256 texts.

A class of equal sets, however many documents it has, is one row from the start: its least row
number stands for it, and texts are fetched by row number. A very long text is read whole, and
fills a block of its own where it exceeds BLOCK_BYTES.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyroll.llm.batches import kept_table, map_slices
from tallyroll.llm.components import components
from tallyroll.llm.words import constants, hashed_words, mix

WORDS = 5
SIMILARITY_PERCENT = 75
BANDS, ROWS = 32, 4
SKETCH_BITS = 512
# Bits that may differ before a pair is out: an estimate of 0.5, six deviations below 0.75.
SKETCH_REACH = 101
# Members of a block, and about how many bytes of their texts: a task holds two blocks.
BLOCK = 256
BLOCK_BYTES = 32 << 20
# Places of the bitmap that is broadcast to sieve texts before a shuffle: 4 MB.
SIEVE_BITS = 1 << 25
SIGNATURE = "n_shingles long, class binary, tag long, sketch array<long>, bands array<long>"
_SAMPLES = BANDS * ROWS
_FLIPS = constants(_SAMPLES, 21)
_FACTORS = constants(_SAMPLES, 22) | np.uint64(1)
_PLACES = constants(WORDS + 1, 23) | np.uint64(1)
_BAND_SEEDS = constants(BANDS, 24)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Of each text the sorted distinct 64-bit shingles of five words; fewer words are one shingle."""
    words = hashed_words(texts, lower=True)
    bounds = words.bounds()
    sets = []
    hashes = words.hashes
    total = max(0, len(hashes) - WORDS + 1)
    rolled = np.zeros(total, np.uint64)
    for place in range(WORDS):
        rolled += hashes[place : place + total] * _PLACES[place]
    rolled = mix(rolled)
    for first, last in zip(bounds[:-1], bounds[1:], strict=True):
        if last - first >= WORDS:
            sets.append(np.unique(rolled[first : last - WORDS + 1]))
        elif last > first:
            part = (hashes[first:last] * _PLACES[: last - first]).sum(dtype=np.uint64, keepdims=True)
            sets.append(mix(part + _PLACES[WORDS:] * np.uint64(last - first)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def min_samples(shingles: np.ndarray) -> np.ndarray:
    """The least of the set under each of the MinHash functions."""
    least = np.full(_SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 2048):
        part = shingles[start : start + 2048]
        np.minimum(least, ((part ^ _FLIPS[:, None]) * _FACTORS[:, None]).min(axis=1), out=least)
    return least


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps of sample rows as 64-bit numbers: each (function, sample) flips one bit."""
    bits = (mix(samples + _FLIPS) % np.uint64(SKETCH_BITS)).astype(np.int64)
    flat = bits + np.arange(len(samples), dtype=np.int64)[:, None] * SKETCH_BITS
    parity = np.bincount(flat.ravel(), minlength=len(samples) * SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8).reshape(len(samples), -1), axis=1).view(np.int64)


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One number for the samples of each band."""
    rows = samples.reshape(len(samples), BANDS, ROWS)
    keys = np.broadcast_to(_BAND_SEEDS, (len(samples), BANDS)).copy()
    for row in range(ROWS):
        keys = mix(keys ^ rows[:, :, row])
    return keys.view(np.int64)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), values.shape[1]).cast(pa.list_(pa.int64()))


def _sign(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = shingle_sets(batch.column("all").field("text"))
    samples = np.stack([min_samples(found) for found in sets])
    digests = [hashlib.blake2b(found.tobytes(), digest_size=16).digest() for found in sets]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("row"),
            batch.column("all"),
            pa.array([len(found) for found in sets], pa.int64()),
            pa.array(digests, pa.binary()),
            pa.array([int.from_bytes(digest[:8], "little", signed=True) for digest in digests], pa.int64()),
            _lists(odd_sketches(samples)),
            _lists(band_keys(samples)),
        ],
        names=["row", "all", "n_shingles", "class", "tag", "sketch", "bands"],
    )


def signed(documents: DataFrame) -> DataFrame:
    """One row for each document: its class (digest of the set), odd sketch and band keys; kept as a table.

    ``all`` holds the document's own columns, so their names cannot clash with these.
    """
    whole = F.struct(*[documents[f"`{name}`"] for name in documents.columns]).alias("all")
    rows = documents.select(F.monotonically_increasing_id().alias("row"), whole)
    schema = StructType([*rows.schema.fields, *StructType.fromDDL(SIGNATURE).fields])
    return kept_table(map_slices(rows, _sign, schema, "all.text"), "near-signed")


def _representatives(signatures: DataFrame) -> DataFrame:
    """``class, row, tag, sketch, bands``: each class once, by its least row; folded before it is shuffled."""
    one = signatures.where("n_shingles > 0").groupBy("class")
    values = [F.any_value(name).alias(name) for name in ("tag", "sketch", "bands")]
    return kept_table(one.agg(F.min("row").alias("row"), *values), "near-representatives")


def _shared_bands(representatives: DataFrame) -> DataFrame:
    """(key, class) of the bands in which at least two classes meet."""
    rows = representatives.select("class", "tag", F.explode("bands").alias("key"))
    met = rows.groupBy("key").agg(F.min("tag").alias("low"), F.max("tag").alias("high")).where("low < high")
    return rows.join(met, "key").select("key", "class").distinct()


def _stars(shared: DataFrame) -> DataFrame:
    """(center, class): the members of each band beside the member that shares bands most."""
    sizes = shared.groupBy("key").agg(F.count("*").alias("size"))
    weights = shared.join(sizes, "key").groupBy("class").agg(F.sum("size").alias("weight"))
    centers = (
        shared.join(weights, "class").groupBy("key").agg(F.max(F.struct("weight", "class")).alias("top"))
    ).select("key", F.col("top.class").alias("center"))
    return shared.join(centers, "key").where(F.col("class") != F.col("center")).select("center", "class").distinct()


def _sketch_distance(left: str, right: str):
    return F.expr(
        f"aggregate(zip_with({left}, {right}, (a, b) -> bit_count(a ^ b)), 0, (total, bits) -> total + bits)"
    )


def similar(left: np.ndarray, right: np.ndarray) -> bool:
    """Whether two sorted sets share enough; whole numbers, so the boundary is exact."""
    both = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * both >= SIMILARITY_PERCENT * (len(left) + len(right) - both)


def _confirm(batch: pa.RecordBatch) -> pa.RecordBatch:
    left, right = shingle_sets(batch.column("text")), shingle_sets(batch.column("center_text"))
    linked = pa.array([similar(a, b) for a, b in zip(left, right, strict=True)], pa.bool_())
    return pa.RecordBatch.from_arrays(
        [batch.column("center"), batch.column("class"), linked], names=["center", "class", "linked"]
    )


def _judged_stars(stars: DataFrame, classes: DataFrame) -> DataFrame:
    """(center, class, linked): sketches first, then the full sets of the pairs they leave."""
    near = stars.join(classes.select("class", "sketch"), "class").join(
        classes.select(F.col("class").alias("center"), F.col("sketch").alias("center_sketch")), "center"
    )
    near = near.select("center", "class", (_sketch_distance("sketch", "center_sketch") <= SKETCH_REACH).alias("near"))
    near = kept_table(near, "near-stars")
    texts = (
        near.where("near")
        .join(classes.select("class", "text"), "class")
        .join(classes.select(F.col("class").alias("center"), F.col("text").alias("center_text")), "center")
        .select("center", "class", "text", "center_text")
    )
    far = near.where("not near").select("center", "class", F.lit(False).alias("linked"))
    return kept_table(map_slices(texts, _confirm, "center binary, class binary, linked boolean").union(far), "near-judged")


def _near_pairs(left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
    """Whether each pair's sketches are within reach and their components differ."""
    distance = np.zeros((len(left), len(right)), np.int64)
    left_bits, right_bits = (np.stack(side["sketch"].tolist()).view(np.uint64) for side in (left, right))
    for part in range(left_bits.shape[1]):
        distance += np.bitwise_count(left_bits[:, part, None] ^ right_bits[None, :, part])
    return (distance <= SKETCH_REACH) & (left["root"].to_numpy()[:, None] != right["root"].to_numpy()[None, :])


def _spanning(left: pd.DataFrame, right: pd.DataFrame) -> list[tuple[bytes, bytes]]:
    """Links between two blocks, as many as join their components; pairs of one component are skipped."""
    wanted = _near_pairs(left, right)
    rows, columns = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
    if not len(rows):
        return []
    left, right, wanted = left.iloc[rows], right.iloc[columns], wanted[np.ix_(rows, columns)]
    left_sets, right_sets = (shingle_sets(pa.array(side["text"], pa.string())) for side in (left, right))
    both = _intersections(left_sets, right_sets)
    sizes = np.add.outer([len(found) for found in left_sets], [len(found) for found in right_sets])
    linked = wanted & (100 * both >= SIMILARITY_PERCENT * (sizes - both))
    parent: dict[bytes, bytes] = {}

    def top(node: bytes) -> bytes:
        while parent.get(node, node) != node:
            parent[node] = parent.get(parent[node], parent[node])
            node = parent[node]
        return node

    found = []
    names, others = left["class"].tolist(), right["class"].tolist()
    roots, other_roots = left["root"].tolist(), right["root"].tolist()
    for i, j in zip(*np.nonzero(linked), strict=True):
        a, b = top(roots[i]), top(other_roots[j])
        if a != b:
            parent[a] = b
            found.append((names[i], others[j]))
    return found


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, as products of 0/1 matrices over shared members."""
    both = np.zeros((len(left), len(right)), np.int64)
    common = np.intersect1d(np.concatenate(left), np.concatenate(right))
    for start in range(0, len(common), 4096):
        part = common[start : start + 4096]
        tables = []
        for sets in (left, right):
            table = np.zeros((len(sets), len(part)), np.float32)
            for number, members in enumerate(sets):
                inside = members[np.searchsorted(members, part[0]) : np.searchsorted(members, part[-1], "right")]
                places = np.searchsorted(part, inside)
                table[number, places[part[places] == inside]] = 1
            tables.append(table)
        both += (tables[0] @ tables[1].T).astype(np.int64)
    return both


def _block_links(rows: pd.DataFrame) -> pd.DataFrame:
    sides = rows["side"].to_numpy()
    left = rows[sides == 0]
    right = rows[sides == 1] if (sides == 1).any() else left
    return pd.DataFrame(_spanning(left, right) if len(left) else [], columns=["a", "b"])


def _block_tasks(judged: DataFrame, roots: DataFrame, sizes: DataFrame) -> DataFrame:
    """``center, class, root, i, j, side``: where the members meet that their centre did not take.

    A task compares side 0 with side 1, or side 0 with itself: rest block i with rest blocks j >= i
    and with the blocks of members that joined the centre, numbered from the rest blocks on.
    """
    root_of = roots.select(F.col("node"), F.col("root"))
    members = (
        judged.join(root_of.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
        .join(root_of.select(F.col("node").alias("center"), F.col("root").alias("center_root")), "center", "left")
        .withColumn("rest", F.col("root") != F.coalesce("center_root", "center"))
        .join(sizes.select("class", "size"), "class")
        .select("center", "class", "root", "rest", "size")
    )
    members = kept_table(members, "near-members")

    def blocks(rows: str, size: str) -> Column:
        return F.greatest(F.ceil(F.col(rows) / BLOCK), F.ceil(F.col(size) / BLOCK_BYTES)).cast("int")

    groups = (
        members.groupBy("center")
        .agg(
            F.count_if("rest").alias("n_rest"),
            F.count_if(~F.col("rest")).alias("n_in"),
            F.sum(F.when(F.col("rest"), F.col("size")).otherwise(0)).alias("rest_size"),
            F.sum(F.when(F.col("rest"), 0).otherwise(F.col("size"))).alias("in_size"),
        )
        .where("n_rest > 0 and n_rest + n_in > 1")
        .select("center", blocks("n_rest", "rest_size").alias("rest_blocks"), blocks("n_in", "in_size").alias("in_blocks"))
    )
    placed = members.join(groups, "center").withColumn(
        "block",
        F.pmod(F.xxhash64("class"), F.when(F.col("rest"), F.col("rest_blocks")).otherwise(F.col("in_blocks"))).cast("int"),
    )
    rest = placed.where("rest").withColumn(
        "task",
        F.explode(
            F.expr(
                "concat("
                " transform(sequence(block, rest_blocks + in_blocks - 1), j -> struct(block AS i, j AS j, 0 AS side)),"
                " transform(filter(sequence(0, block), i -> i < block), i -> struct(i AS i, block AS j, 1 AS side)))"
            )
        ),
    )
    joined = placed.where("not rest").withColumn(
        "task",
        F.explode(F.expr("transform(sequence(0, rest_blocks - 1), i -> struct(i AS i, block + rest_blocks AS j, 1 AS side))")),
    )
    columns = ["center", "class", "root", "task.i", "task.j", "task.side"]
    return rest.select(columns).union(joined.select(columns))


def _rest_links(judged: DataFrame, roots: DataFrame, classes: DataFrame) -> DataFrame:
    """Links beside the stars: of members not in their centre's component, with everyone near that centre."""
    return (
        _block_tasks(judged, roots, classes)
        .join(classes.select("class", "sketch", "text"), "class")
        .groupBy("center", "i", "j")
        .applyInPandas(_block_links, "a binary, b binary")
    )


def _sieved(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose ``on`` may be among the keys: all that are, and few others.

    A bitmap of hash places, SIEVE_BITS at most, is broadcast, so the rows that are certainly not
    wanted leave before their texts are shuffled. A join must follow.
    """
    place = F.pmod(F.xxhash64(on), F.lit(SIEVE_BITS))
    bitmaps = (
        keys.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    marked = rows.withColumns({"part": F.bitmap_bucket_number(place), "bit": F.bitmap_bit_position(place)})
    hit = "CAST(conv(hex(substring(bits, CAST(bit DIV 8 AS INT) + 1, 1)), 16, 10) AS INT) DIV shiftleft(1, CAST(bit % 8 AS INT)) % 2 = 1"
    return marked.join(F.broadcast(bitmaps), "part").where(hit).select(*rows.columns)


def linked_classes(signatures: DataFrame) -> DataFrame:
    """``node, root`` for every class that is linked to another."""
    representatives = _representatives(signatures)
    stars = kept_table(_stars(kept_table(_shared_bands(representatives), "near-bands")), "near-pairs")
    met = stars.select("class").union(stars.select("center")).distinct()
    chosen = kept_table(representatives.select("class", "row", "sketch").join(met, "class"), "near-met")
    texts = _sieved(signatures.select("row", F.col("all.text").alias("text")), chosen, "row")
    # Not a semi join, which Catalyst would move below the sieve.
    found = texts.join(chosen, "row").select("class", "sketch", F.octet_length("text").cast("long").alias("size"), "text")
    classes = kept_table(found, "near-classes")
    judged = _judged_stars(stars, classes)
    star_links = judged.where("linked").select(F.col("center").alias("a"), F.col("class").alias("b"))
    roots = components(star_links)
    more = kept_table(_rest_links(judged, roots, classes), "near-links")
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a <> b").union(more))


def grouped(signatures: DataFrame) -> DataFrame:
    """``row, doc_id, n_shingles, root, component_id, kept`` of every signed document.

    ``root`` tells groups apart where ``component_id`` does not: ids may be null or repeated.
    """
    doc_id = F.col("all.doc_id").cast("long")
    firsts = signatures.where("n_shingles > 0").groupBy("class").agg(F.min(doc_id).alias("first"))
    rooted = firsts.join(linked_classes(signatures), F.col("class") == F.col("node"), "left").select(
        "class", "first", F.coalesce("root", "class").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = rooted.join(least, "root").select("class", "root", "component_id")
    rows = signatures.select("row", doc_id.alias("doc_id"), "n_shingles", "class").join(of_class, "class", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    kept = F.col("doc_id").eqNullSafe(component).alias("kept")
    return rows.select("row", "doc_id", "n_shingles", "root", component.alias("component_id"), kept)


def near_duplicates(documents: DataFrame) -> DataFrame:
    """Groups of near duplicates among ``documents(doc_id, text)``.

    One row for each document row, repeated rows included: ``doc_id, n_shingles, component_id,
    kept``. component_id is the least doc_id reachable over links of Jaccard similarity 0.75 or
    more between sets of five-word shingles. Null and blank texts have no shingles and are linked
    with nothing: their component is their own doc_id. A null doc_id takes part as a text but never
    names a component unless all its members lack one. So groups that lack ids share the null
    component_id, and groups whose least id is the same repeated one share it too. Other columns
    are ignored; an empty table gives no rows.
    """
    return grouped(signed(documents.select("doc_id", "text"))).drop("row", "root")


def without_near_duplicates(documents: DataFrame) -> DataFrame:
    """The documents with one row of each group left, all columns as they were.

    The row with the least doc_id stays, a null one last; of rows that repeat it, the first. Texts
    that are no near duplicates stay whatever their ids, null or the same. Texts without words all
    stay.
    """
    signatures = signed(documents)
    groups = kept_table(grouped(signatures), "near-groups")
    blank = groups.where("n_shingles = 0").select("row")
    first = groups.where("kept and n_shingles > 0").groupBy("root").agg(F.min("row").alias("row")).select("row")
    return signatures.select("row", "all").join(first.union(blank), "row", "left_semi").select("all.*")
