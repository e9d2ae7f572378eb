"""Running a function over Arrow batches inside tasks, and tables kept in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyroll.session import scratch_path

# Characters handled at once: temporary arrays stay at some tens of bytes for each.
SLICE_CHARS = 1 << 20


def text_slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about SLICE_CHARS bytes; a longer text stands alone."""
    top, *inner = column.split(".")
    texts = batch.column(top)
    for name in inner:
        texts = texts.field(name)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = int(total[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + SLICE_CHARS, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def map_slices(
    rows: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str | StructType,
    column: str = "text",
) -> DataFrame:
    """One pass without a shuffle: ``function`` turns each slice of rows into result rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, column):
                yield function(part)

    return rows.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null is empty."""
    return [text or "" for text in batch.column(column).to_pylist()]


def id_and_text(documents: DataFrame) -> DataFrame:
    """The two columns the operators read; others, whatever their names, are left out."""
    return documents.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def kept_table(rows: DataFrame, purpose: str) -> DataFrame:
    """Written to the shared folder and read back: lineage ends there, and columns can be pruned."""
    spark: SparkSession = rows.sparkSession
    path = scratch_path(spark, purpose)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
