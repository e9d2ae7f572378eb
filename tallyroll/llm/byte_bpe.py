"""Byte-level BPE over whole documents: encoding by ranks and decoding by joining pieces.

The merges run over the bytes of each task's distinct pre-tokens, side by side, and the ids of a
text are gathered from its pre-tokens' ids; nothing is shuffled. The rank file's content travels
with the task, so executors need no file.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.batches import id_and_text, map_slices, texts_of
from tallyroll.llm.byte_pairs import rank_encoder, rank_pieces

# A vocabulary travels with every task; a larger file is not one.
MOST_VOCABULARY_BYTES = 64 << 20


def read_vocabulary(path: str) -> bytes:
    """The content of a vocabulary file, read on the driver."""
    with open(path, "rb") as file:
        content = file.read(MOST_VOCABULARY_BYTES + 1)
    if len(content) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path} is too large for a vocabulary")
    return content


def id_bytes(ids: np.ndarray, bounds: np.ndarray, kind: str = "<u4") -> pa.Array:
    """One binary value of little-endian ids for each text."""
    data = ids.astype(kind)
    offsets = (bounds * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def encoded(documents: DataFrame, ranks: bytes) -> DataFrame:
    """``doc_id, ids`` of ``documents(doc_id, text)``: ids as little-endian unsigned 32-bit numbers.

    Every match of the vocabulary's pattern is merged by itself and there are no special tokens.
    A null or empty text has no ids. A very long text is encoded whole, alone in its slice. Rows,
    repeated ones too, map one to one; other columns are ignored; an empty table gives no rows.
    """

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, bounds = rank_encoder(ranks).encode(texts_of(batch))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), id_bytes(ids, bounds)], names=["doc_id", "ids"])

    rows = id_and_text(documents)
    return map_slices(rows, encode, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def decoded(rows: DataFrame, ranks: bytes) -> DataFrame:
    """``doc_id, ids, bytes`` of encoded rows: the pieces of the ids, joined. Null ids give null."""

    def decode(batch: pa.RecordBatch) -> pa.RecordBatch:
        pieces = rank_pieces(ranks)
        joined = [
            None if ids is None else b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))
            for ids in batch.column("ids").to_pylist()
        ]
        columns = [batch.column("doc_id"), batch.column("ids"), pa.array(joined, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "bytes"])

    rows = rows.select("doc_id", "ids")
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, bytes binary"
    return map_slices(rows, decode, schema, "ids")


def digests(rows: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of decoded rows."""
    return rows.select(
        "doc_id",
        F.expr("CAST(octet_length(ids) AS LONG) DIV 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
