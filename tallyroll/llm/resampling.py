"""Importance resampling of documents towards a target, by hashed n-grams.

Every document's words, parted by single spaces, are scanned once for their running CRC-32; the
checksum of each n-gram follows from two of its values. Checksums fall into buckets. A bucket's
gain is the log of how much more often the target uses it than the corpus does, a document's
weight is the mean gain over its n-grams, and noise that depends on the document's id alone turns
the choice of the highest scores into a weighted draw without replacement.

Counts are added up inside each task before they are shuffled, one row a bucket. The buckets'
gains, as many as there are buckets, are the only thing that tasks are sent. Ranks are counted
over score values, never by sorting everything in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroll.llm.batches import id_and_text, kept_table, text_slices
from tallyroll.llm.byte_bpe import id_bytes
from tallyroll.llm.prefix_crc import running_crcs, substring_crcs
from tallyroll.llm.words import utf8

LONGEST = 1
BUCKETS = 10_000
# Gains travel with every task: more buckets than this are no table of features.
MOST_BUCKETS = 1 << 20
SEED = 2024
FEWEST_WORDS = 20
DRAWN_PERCENT = 10
# Score values whose rows are counted together first: there are at most some hundreds of bands.
_BAND = 1024

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Letters, digits and every byte of a character beyond ASCII are of words; the rest parts them.
_OF_WORDS = np.zeros(256, bool)
_OF_WORDS[48:58] = _OF_WORDS[97:123] = _OF_WORDS[128:] = True


def feature_checksums(texts: pa.Array, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC-32 of every run of up to ``longest`` words of each text, text by text; how many, and how many words.

    Words are lower-cased in A-Z and joined by one space. Runs of one text stand by length.
    """
    data, bounds = utf8(texts)
    data = _LOWER[data]
    size = len(data)
    inside = _OF_WORDS[data]
    edge = np.zeros(size + 1, bool)
    edge[bounds] = True
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:size]
    finishes[:-1] &= ~inside[1:] | edge[1:size]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    doc = np.searchsorted(bounds, starts, "right") - 1
    n_words = np.bincount(doc, minlength=len(bounds) - 1)
    # Of what parts words, one byte behind each word stays, as a space.
    kept = inside.copy()
    spaced = ends[(ends < size) & ~inside[np.minimum(ends, size - 1)]]
    kept[spaced] = True
    data[spaced] = 32
    place = np.concatenate(([0], np.cumsum(kept)))
    running = running_crcs(data[kept])
    starts, ends = place[starts], place[ends]
    found, owners = [], []
    for length in range(1, longest + 1):
        first = np.arange(max(0, len(starts) - length + 1))
        first = first[doc[first] == doc[first + length - 1]]
        found.append(substring_crcs(running, starts[first], ends[first + length - 1]))
        owners.append(doc[first])
    checksums, owner = np.concatenate(found), np.concatenate(owners)
    if longest > 1:
        order = np.argsort(owner, kind="stable")
        checksums, owner = checksums[order], owner[order]
    return checksums, np.bincount(owner, minlength=len(bounds) - 1), n_words


def bucketed(documents: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words, n_features, features``: each document's buckets as little-endian 32-bit numbers."""
    rows = id_and_text(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                checksums, counts, n_words = feature_checksums(part.column("text"), longest)
                ends = np.concatenate(([0], np.cumsum(counts)))
                features = id_bytes(checksums % np.uint32(buckets), ends)
                columns = [part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(counts, pa.int64()), features]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "features"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, features binary")


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n`` of bucketed rows; each task adds up its own rows first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for features in batch.column("features"):
                if features.is_valid:
                    counts += np.bincount(np.frombuffer(features.as_buffer(), "<u4"), minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])

    return rows.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket, in thousandths, rounded down; a table of fixed size, read by the driver.

    Both counts are smoothed by one a bucket, so buckets that neither uses have a gain too.
    """
    if buckets > MOST_BUCKETS:
        raise ValueError(f"more than {MOST_BUCKETS} buckets")
    both = corpus.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).union(
        target.select("bucket", F.lit(0).cast("long"), "n")
    )
    spark = corpus.sparkSession
    both = both.union(spark.range(buckets).select("id", F.lit(0).cast("long"), F.lit(0).cast("long")))
    counts = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    rows = counts.collect()
    total_s, total_t = (sum(row[name] for row in rows) for name in ("s", "t"))
    found = np.zeros(buckets, np.int64)
    for row in rows:
        ratio = float(row.t + 1) * float(total_s + buckets) / (float(row.s + 1) * float(total_t + buckets))
        found[row.bucket] = int(np.floor(1000 * np.log(ratio)))
    return found


def weighted(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of bucketed rows: the mean gain, rounded down; 0 without features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(gain[np.frombuffer(each.as_buffer(), "<u4")].sum()) for each in batch.column("features")]
            sizes = batch.column("n_features").to_pylist()
            weights = [total // size if size else 0 for total, size in zip(sums, sizes, strict=True)]
            columns = [batch.column("doc_id"), batch.column("n_words"), batch.column("n_features"), pa.array(weights, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """A draw from the standard Gumbel distribution in thousandths, rounded down, that the id fixes; a null id is empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.left(F.sha2(text, 256), F.lit(8)), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _ranked(scored: DataFrame, drawn: int, fewest_words: int) -> DataFrame:
    """``rank`` beside each of the ``drawn`` highest scores of documents long enough, null beside the others.

    Rows are counted by score, and scores by bands. A gain, so a weight too, lies within 44,000
    of zero and noise between -3,200 and 22,900, so there are at most 120 bands, and no window
    meets more than them, the scores of a band, or the rows of one score.
    """
    able = scored.where(F.col("n_words") >= fewest_words)
    band = F.floor(F.col("score") / _BAND)
    above = Window.rowsBetween(Window.unboundedPreceding, -1)
    sizes = able.groupBy("score").agg(F.count("*").alias("n")).withColumn("band", band)
    bands = sizes.groupBy("band").agg(F.sum("n").alias("n"))
    bands = bands.select("band", F.coalesce(F.sum("n").over(above.orderBy(F.desc("band"))), F.lit(0)).alias("far"))
    near = F.coalesce(F.sum("n").over(above.partitionBy("band").orderBy(F.desc("score"))), F.lit(0))
    before = sizes.withColumn("near", near).join(F.broadcast(bands), "band")
    before = before.select("score", (F.col("far") + F.col("near")).alias("before")).where(F.col("before") < drawn)
    order = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "row")
    places = able.join(before, "score").select("row", (F.col("before") + F.row_number().over(order)).alias("rank"))
    return scored.join(places.where(F.col("rank") <= drawn), "row", "left")


def resampled(
    documents: DataFrame,
    target: DataFrame,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    percent: int = DRAWN_PERCENT,
    seed: int = SEED,
    fewest_words: int = FEWEST_WORDS,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of ``documents(doc_id, text)``, a row each.

    ``target`` has a text column and is what the draw should resemble. Of the documents of at
    least ``fewest_words`` words, the ``percent`` with the highest scores (rounded down) are
    drawn: rank is 1, 2, 3 ... by falling score and then rising doc_id, and null for the others.
    A null or empty text has no features and a weight of 0. Rows that repeat an id have its noise
    and stand in the order they were read; null ids share their noise and come last among equal
    scores. A very long text is scanned whole. Other columns are ignored; an empty table gives no
    rows, and an empty target equal counts for all buckets.
    """
    corpus = kept_table(bucketed(documents, longest, buckets), "resampling-features")
    wanted = bucketed(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), longest, buckets)
    gain = gains(bucket_counts(corpus, buckets), bucket_counts(wanted, buckets), buckets)
    scored = weighted(corpus, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = kept_table(scored.withColumn("row", F.monotonically_increasing_id()), "resampling-scores")
    able = scored.where(F.col("n_words") >= fewest_words).count()
    found = _ranked(scored, able * percent // 100, fewest_words)
    return found.select("doc_id", "n_words", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))
