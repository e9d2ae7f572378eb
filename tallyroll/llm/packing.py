"""Mixture-controlled packing of documents into sequences of equal length.

Each source is a queue of tokens. Deficit round-robin fills every window, one sequence or several,
to the target proportions: a queue's deficit grows by its share of the window, whole tokens are
served, all of a queue's tokens of a window one after another, and the fraction is carried to the
next window. Every token is packed once. Without targets the shares are the corpus's own. With
targets, queues run empty one by one; what is left then goes on in the targets' proportions.

Served cumulatively, queue s has sent B(s, w) - B(s - 1, w) tokens after w windows, where B(s, w)
is the whole part of w times the share of the first s queues. So what is carried into any window
is known without those before it, and partitions cut their documents independently: a document
needs only its place in its queue, a prefix sum that is built from sums of partitions. Up to the
moment a queue runs empty, this holds with the tokens that the queues have sent by then. All
sequences but the last are full. Sequences in a window of several hold longer pieces of documents.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyroll.llm.batches import kept_table, text_slices, texts_of
from tallyroll.llm.byte_bpe import id_bytes
from tallyroll.llm.byte_pairs import json_encoder

SEQUENCE = 1024
END_ID = 0
# Sequences of a window for training: a source's pieces are as long as its share of so many.
WINDOW = 20


@dataclass(frozen=True)
class Phase:
    """Tokens served until a queue runs empty: where they begin in the output and in each queue, and each queue's running total."""

    start: int
    before: np.ndarray
    upto: np.ndarray


def phases(sizes: np.ndarray, targets: np.ndarray | None = None) -> list[Phase]:
    """The phases in which queues of these sizes are served; with targets, as many as queues at most."""
    left = sizes.astype(np.int64)
    found: list[Phase] = []
    start = 0
    while left.sum():
        weights = left.astype(float) if targets is None else np.where(left > 0, targets, 0.0)
        if not weights.any():
            weights = left.astype(float)
        some = weights > 0
        rounds = left[some] / weights[some]
        served = np.where(some, np.minimum(left, np.floor(weights * rounds.min())), 0).astype(np.int64)
        empty = np.flatnonzero(some)[rounds == rounds.min()]
        served[empty] = left[empty]
        found.append(Phase(start, sizes - left, np.cumsum([0, *served], dtype=np.int64)))
        start += int(served.sum())
        left = left - served
    return found


def tokenized(documents: DataFrame, tokenizer: bytes, end_id: int = END_ID) -> DataFrame:
    """``block, source, doc_id, n_tokens, before, ids``: each document's ids with the end id.

    A block is a partition of the input; ``before`` counts the tokens of the same source that
    the block holds ahead of the document.
    """
    rows = documents.select(
        "doc_id",
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        # A null source is a queue of its own.
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("source"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = json_encoder(tokenizer)
        kind = "<u2" if len(encoder.merges.pieces) <= 1 << 16 else "<u4"
        block = TaskContext.get().partitionId()
        sent: dict[str, int] = defaultdict(int)
        for batch in batches:
            for part in text_slices(batch):
                ids, bounds = encoder.encode(texts_of(part))
                ids = np.insert(ids, bounds[1:], end_id)
                bounds = bounds + np.arange(len(bounds))
                sizes, before = np.diff(bounds), []
                for source, size in zip(part.column("source").to_pylist(), sizes.tolist(), strict=True):
                    before.append(sent[source])
                    sent[source] += size
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(part.num_rows, block)),
                        part.column("source"),
                        part.column("doc_id"),
                        pa.array(sizes),
                        pa.array(before, pa.int64()),
                        id_bytes(ids, bounds, kind),
                        pa.array(np.full(part.num_rows, int(kind[-1]), np.int32)),
                    ],
                    names=["block", "source", "doc_id", "n_tokens", "before", "ids", "width"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"block long, source string, doc_id {kind}, n_tokens long, before long, ids binary, width int"
    return kept_table(rows.mapInArrow(run, schema), "packing-ids")


def _queues(tokens: DataFrame, length: int) -> tuple[dict[str, int], np.ndarray]:
    """The queue number of each source that has one, and the tokens of all queues up to each.

    A source with less than a token in each window shares the last queue with others like it,
    so there are at most ``length`` queues, whatever the number of sources.
    """
    sums = tokens.groupBy("source").agg(F.sum("n_tokens").alias("n"))
    total = sums.agg(F.sum("n")).first()[0] or 0
    large = sorted((row.n, row.source) for row in sums.where(F.col("n") * length >= total).collect())
    shared = total - sum(n for n, _ in large)
    while large and 0 < shared * length < total:
        shared += large.pop(0)[0]
    queues = {source: number for number, (_, source) in enumerate(sorted(large, key=lambda pair: pair[1]))}
    sizes = [dict((source, n) for n, source in large)[source] for source in queues]
    return queues, np.cumsum([0, *sizes, *([shared] if shared else [])], dtype=np.int64)


def _bases(tokens: DataFrame, queues: dict[str, int]) -> DataFrame:
    """``block, source, queue, base``: the tokens of the queue ahead of a block's share of a source.

    Sums of blocks are added up over blocks, and within a block over its sources, so no task
    meets more rows than there are blocks, or sources in a block.
    """
    spark = tokens.sparkSession
    shares = tokens.groupBy("block", "source").agg(F.sum("n_tokens").alias("n"))
    numbered = spark.createDataFrame(list(queues.items()), "source string, queue int")
    shares = shares.join(F.broadcast(numbered), "source", "left").withColumn("queue", F.coalesce("queue", F.lit(len(queues))))
    ahead = Window.rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        shares.groupBy("queue", "block")
        .agg(F.sum("n").alias("n"))
        .select("queue", "block", F.coalesce(F.sum("n").over(ahead.partitionBy("queue").orderBy("block")), F.lit(0)).alias("far"))
    )
    within = F.coalesce(F.sum("n").over(ahead.partitionBy("queue", "block").orderBy("source")), F.lit(0))
    bases = shares.withColumn("near", within).join(blocks, ["queue", "block"])
    return kept_table(bases.select("block", "source", "queue", (F.col("far") + F.col("near")).alias("base")), "packing-bases")


def sent_up_to(upto: np.ndarray, length: int, queue: int, windows: np.ndarray) -> np.ndarray:
    """Tokens that the queues before ``queue`` have sent after each number of windows."""
    total = int(upto[-1])
    if queue == len(upto) - 1:
        return np.minimum(windows * length, total)
    served = np.floor(windows * (length * (int(upto[queue]) / total))).astype(np.int64)
    return np.where(windows * length >= total, upto[queue], np.minimum(served, upto[queue]))


def cut(upto: np.ndarray, length: int, queue: int, place: int, size: int) -> tuple[np.ndarray, ...]:
    """Pieces of ``size`` tokens at ``place`` of a queue: first token, count, window and offset there."""
    share = length * (int(upto[queue + 1] - upto[queue]) / int(upto[-1]))
    last = -(-int(upto[-1]) // length)
    windows = np.arange(max(0, int(place / share) - 2), min(last, int((place + size) / share) + 3) + 1)
    below, above = (sent_up_to(upto, length, number, windows) for number in (queue, queue + 1))
    sent = above - below
    starts, ends = np.maximum(sent[:-1], place), np.minimum(sent[1:], place + size)
    some = ends > starts
    offsets = (below[1:] - below[:-1]) + starts - sent[:-1]
    return (starts - place)[some], (ends - starts)[some], windows[:-1][some], offsets[some]


def pieces_of(plan: list[Phase], length: int, window: int, queue: int, place: int, size: int) -> np.ndarray:
    """Rows of first token, count, sequence and offset there, for ``size`` tokens at ``place`` of a queue."""
    rows = []
    for phase in plan:
        first = int(phase.before[queue])
        last = first + int(phase.upto[queue + 1] - phase.upto[queue])
        low, high = max(place, first), min(place + size, last)
        if low < high:
            starts, counts, windows, offsets = cut(phase.upto, length * window, queue, low - first, high - low)
            rows.append(np.stack((starts + low - place, counts, phase.start + windows * length * window + offsets)))
    starts, counts, at = np.concatenate(rows, axis=1)
    # Where sequences end, pieces do.
    parts = (at + counts - 1) // length - at // length + 1
    number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    starts, counts, at = (np.repeat(values, parts) for values in (starts, counts, at))
    low = np.maximum(at, (at // length + number) * length)
    high = np.minimum(at + counts, (at // length + number + 1) * length)
    return np.stack((starts + low - at, high - low, low // length, low % length))


def packed(
    documents: DataFrame,
    tokenizer: bytes,
    length: int = SEQUENCE,
    end_id: int = END_ID,
    window: int = 1,
    targets: dict[str | None, float] | None = None,
) -> DataFrame:
    """Pieces of ``documents(doc_id, text, source)`` in sequences of at most ``length`` tokens.

    One row for each piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``, with
    ids as little-endian unsigned 32-bit numbers. Offsets of a sequence are gapless from 0, and
    every sequence but the last is full. Every ``window`` sequences hold the sources in their
    proportions; ``targets`` gives these by source, else they are the corpus's own, and sources it
    does not name come last. A source's documents follow in the order they are read, partition by
    partition, so ties need no rule. A very long text is cut where windows and sequences
    end. A null or empty text is the end id alone; a null source is a source of its own; repeated
    rows are packed as often as they occur; other columns are ignored; an empty table gives no rows.
    """
    tokens = tokenized(documents, tokenizer, end_id)
    queues, upto = _queues(tokens, length)
    wanted = None
    if targets is not None:
        named = {"" if source is None else f"={source}": float(share) for source, share in targets.items()}
        wanted = np.array([named.get(source, 0.0) for source in queues] + [0.0] * (len(upto) - 1 - len(queues)))
        if len(wanted) > len(queues):
            # The last queue has the sources without one of their own.
            wanted[-1] = sum(share for source, share in named.items() if source not in queues)
    plan = phases(np.diff(upto), wanted)
    placed = tokens.join(_bases(tokens, queues), ["block", "source"])
    placed = placed.select("doc_id", "queue", (F.col("base") + F.col("before")).alias("place"), "ids", "width")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "ids"):
                yield _pieces(part, plan, length, window)

    kind = placed.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return placed.mapInArrow(run, schema)


def _pieces(batch: pa.RecordBatch, plan: list[Phase], length: int, window: int) -> pa.RecordBatch:
    rows, texts, found = [], [], []
    columns = (batch.column(name).to_pylist() for name in ("queue", "place", "ids", "width"))
    for number, (queue, place, data, width) in enumerate(zip(*columns, strict=True)):
        ids = np.frombuffer(data, f"<u{width}")
        parts = pieces_of(plan, length, window, queue, place, len(ids))
        rows.append(np.full(parts.shape[1], number))
        found.append(np.stack([parts[0], parts[1], np.full(parts.shape[1], len(ids)), parts[2], parts[3]]))
        texts.append(ids)
    starts, sizes, totals, windows, offsets = np.concatenate(found, axis=1)
    # The pieces of a document follow each other and cover it, so the ids stay as they lie.
    ends = np.concatenate(([0], np.cumsum(sizes)))
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    doc_ids = batch.column("doc_id").take(pa.array(np.concatenate(rows)))
    ids = id_bytes(np.concatenate(texts), ends)
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(starts), pa.array(sizes), ids, pa.array(totals), pa.array(windows), pa.array(offsets)], names=names
    )


def checksums(pieces: DataFrame) -> DataFrame:
    """The pieces with a CRC-32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
