"""Token counts by a piece model, without encoding whole texts.

No piece of the model crosses from other characters into a space or over a line break, so a
text's tokens are those of its pre-tokens: runs of spaces with what follows them. Each distinct
pre-token is counted once in a worker, and a document's count is the sum over its pre-token
frequencies. The join of frequencies with counts runs inside the task: as a shuffle it would move
a row for every distinct pre-token of every document, more than the text itself.
"""

from __future__ import annotations

import functools
import re
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.batches import id_and_text, map_slices, texts_of

LIMIT = 4096
# Pre-tokens remembered at once by a worker, in about 100 bytes each.
REMEMBERED = 1_000_000
_UNITS = re.compile(r"\n| +[^ \n]*|[^ \n]+")
_MARK = "▁"


class PieceCounter:
    """Counts of pieces by pre-token, each found once."""

    def __init__(self, model: bytes):
        self._model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = map(self._model.id_to_piece, range(self._model.get_piece_size()))
        if any(_MARK in piece.lstrip(_MARK) or ("\n" in piece and len(piece) > 1) for piece in pieces):
            raise ValueError("the model has pieces across spaces or line breaks")
        self._lead = len(self._model.encode("\n"))
        self._known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        frequencies = [
            Counter(_UNITS.findall(" " + text.replace(_MARK, " "))) if text else Counter() for text in texts
        ]
        if len(self._known) > REMEMBERED:
            self._known = {}
        known = self._known
        unknown = list({unit for counts in frequencies for unit in counts if unit not in known})
        # A line break ahead keeps the model's own leading space apart from the unit.
        for unit, ids in zip(unknown, self._model.encode(["\n" + unit for unit in unknown], num_threads=1), strict=True):
            known[unit] = len(ids) - self._lead
        return [sum(known[unit] * times for unit, times in counts.items()) for counts in frequencies]


@functools.lru_cache(maxsize=2)
def _counter(model: bytes) -> PieceCounter:
    return PieceCounter(model)


def token_counts(documents: DataFrame, model: bytes, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of ``documents(doc_id, text)``.

    Counts are those of the piece model's library without begin and end tokens. A null or empty
    text has no bytes and no tokens. A very long text is counted whole, by its distinct pre-tokens.
    Rows, repeated ones too, map one to one; other columns are ignored; an empty table gives no rows.
    """

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = pa.array(_counter(model).count(texts_of(batch)), pa.int64())
        sizes = pc.binary_length(batch.column("text")).cast(pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, counts], names=["doc_id", "n_bytes", "n_tokens"])

    rows = id_and_text(documents)
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long"
    return map_slices(rows, count, schema).withColumn("over_limit", F.col("n_tokens") > limit)
