"""A quality classifier: a factorisation machine over hashed words, structure and size.

The score is a logistic function of a bias, linear weights and the interactions of all feature
pairs through low-rank factors. By the sum-of-squares identity the interactions cost one pass over
a text's features: half the sum, over factors, of the squared sum less the sum of squares.
Features come from the text alone. The model is fitted by Spark on a bounded sample of labelled
rows and scores every document in one pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import FMClassifier
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallyroll.llm.batches import id_and_text, kept_table, map_slices
from tallyroll.llm.words import hashed_words, utf8

# Labelled rows that the model is fitted on, at most; those with the least hash of their id.
TRAINING_ROWS = 8192
ACCEPTED = 0.3
FOLDS = 5
FACTORS = 4
WORD_BUCKETS = 1 << 12
SIZE_BUCKETS = 24
ROUNDS = 60

_KINDS = ("letter_upper", "letter_lower", "digit", "mark", "symbol", "exclamation", "bar", "break", "space", "rest", "inner")
_STATISTICS = 12
N_FEATURES = _STATISTICS + SIZE_BUCKETS + WORD_BUCKETS


def _kind_table() -> np.ndarray:
    table = np.full(256, _KINDS.index("rest"), np.uint8)
    for kind, signs in (("mark", b".,;:?()'\""), ("symbol", b"#*$%&<>@=_^~{}[]\\/+"), ("exclamation", b"!"), ("bar", b"|")):
        table[list(signs)] = _KINDS.index(kind)
    table[65:91] = _KINDS.index("letter_upper")
    table[97:123] = _KINDS.index("letter_lower")
    table[48:58] = _KINDS.index("digit")
    table[[9, 11, 12, 13, 32]] = _KINDS.index("space")
    table[10] = _KINDS.index("break")
    table[128:192] = _KINDS.index("inner")  # bytes inside a code point
    return table


_TABLE = _kind_table()


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, feature number and value of every non-zero feature, in that order."""
    size = len(texts)
    data, bounds = utf8(texts)
    words = hashed_words(texts, lower=False)
    owner = np.repeat(np.arange(size), np.diff(bounds))
    counts = np.bincount(owner * len(_KINDS) + _TABLE[data], minlength=size * len(_KINDS)).reshape(size, -1)
    of = {name: counts[:, number] for number, name in enumerate(_KINDS)}
    chars = counts.sum(axis=1) - of["inner"]
    solid = np.maximum(chars - of["space"] - of["break"], 1)
    n_words = np.maximum(words.counts, 1)
    order = np.lexsort((words.hashes, words.doc))
    hashes, docs = words.hashes[order], words.doc[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
    distinct = np.bincount(docs[fresh], minlength=size)
    again = (words.hashes[1:] == words.hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    repeated = np.bincount(words.doc[1:][again], minlength=size)
    letters = np.maximum(of["letter_upper"] + of["letter_lower"], 1)
    statistics = np.stack(
        [
            of["letter_upper"] / letters,
            of["digit"] / solid,
            of["mark"] / solid,
            np.minimum(1, 4 * of["symbol"] / solid),
            np.minimum(1, 4 * of["exclamation"] / solid),
            np.minimum(1, 4 * of["bar"] / solid),
            of["rest"] / solid,
            np.minimum(1, of["break"] / n_words),
            np.minimum(1, solid / n_words / 20),
            distinct / n_words,
            repeated / n_words,
            np.minimum(1, np.log1p(words.counts) / 12),
        ],
        axis=1,
    )
    buckets = np.minimum(np.log2(chars + 1).astype(np.int64), SIZE_BUCKETS - 1)
    key, times = np.unique(words.doc * WORD_BUCKETS + (words.hashes % np.uint64(WORD_BUCKETS)).astype(np.int64), return_counts=True)
    word_docs, weight = key // WORD_BUCKETS, np.log1p(times)
    norm = np.sqrt(np.bincount(word_docs, weights=weight**2, minlength=size))
    doc = np.concatenate((np.repeat(np.arange(size), _STATISTICS), np.arange(size), word_docs))
    number = np.concatenate(
        (np.tile(np.arange(_STATISTICS), size), _STATISTICS + buckets, _STATISTICS + SIZE_BUCKETS + key % WORD_BUCKETS)
    )
    value = np.concatenate((statistics.ravel(), np.ones(size), weight / norm[word_docs]))
    order = np.lexsort((number, doc))
    order = order[value[order] != 0]
    return doc[order], number[order], value[order]


@dataclass(frozen=True)
class Model:
    """Bias, linear weights and factors; without factors the score is the bias's alone."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, texts: pa.Array) -> np.ndarray:
        """The probability of label 1 of each text, in time linear in its features."""
        size = len(texts)
        doc, number, value = features(texts)
        raw = self.bias + np.bincount(doc, weights=self.linear[number] * value, minlength=size)
        for factor in self.factors.T:
            part = factor[number] * value
            raw += 0.5 * np.bincount(doc, weights=part, minlength=size) ** 2
            raw -= 0.5 * np.bincount(doc, weights=part**2, minlength=size)
        return 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: its id's CRC-32 is divisible by the folds."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def _training_rows(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``label, features`` of at most TRAINING_ROWS labelled rows outside the held-out fold."""
    known = (
        labels.where("quality IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("quality").cast("double").alias("label"))
        .where(~held_out())
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAINING_ROWS)
    )

    def extract(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc, number, value = features(batch.column("text"))
        ends = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=batch.num_rows)))).astype(np.int32)
        lists = [pa.ListArray.from_arrays(ends, pa.array(part)) for part in (number.astype(np.int32), value)]
        columns = [batch.column("doc_id"), batch.column("label"), *lists]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "number", "value"])

    rows = id_and_text(documents).join(F.broadcast(known), "doc_id").select("doc_id", "label", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = map_slices(rows, extract, f"doc_id {kind}, label double, number array<int>, value array<double>")
    # An id may repeat, so the bound is set once more on the rows themselves.
    found = found.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("number", "value")).limit(TRAINING_ROWS)
    return kept_table(found, "quality-training")


def fitted(documents: DataFrame, labels: DataFrame) -> Model:
    """A model of ``labels(doc_id, quality)`` for ``documents(doc_id, text)``.

    Ids with several labels count as 1 if any is; unlabelled rows, other labels and null ids are
    left out. With one class or none, every score is the smoothed share of label 1.
    """
    rows = _training_rows(documents, labels)
    ones, total = rows.agg(F.coalesce(F.sum("label"), F.lit(0.0)), F.count("*")).first()
    if ones in (0, total):
        share = (ones + 1) / (total + 2)
        return Model(float(np.log(share / (1 - share))), np.zeros(N_FEATURES), np.zeros((N_FEATURES, 0)))
    to_vector = F.udf(lambda number, value: Vectors.sparse(N_FEATURES, number, value), VectorUDT())
    training = rows.select("label", to_vector("number", "value").alias("features")).repartition(4)
    machine = FMClassifier(factorSize=FACTORS, maxIter=ROUNDS, stepSize=0.1, regParam=1e-5, initStd=0.05, seed=7)
    model = machine.fit(training)
    return Model(model.intercept, model.linear.toArray(), model.factors.toArray())


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """``all, score``: each row of ``documents(text, ...)`` beside its score from 0 to 1.

    Null texts count as empty, and empty texts have a score too; a very long text is scored by all
    of its words. Repeated rows score alike; ``all`` holds the row's own columns, whatever their
    names; an empty table gives no rows.
    """
    rows = documents.select(F.struct(*[documents[f"`{name}`"] for name in documents.columns]).alias("all"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("all").field("text")
        return pa.RecordBatch.from_arrays([batch.column("all"), pa.array(model.score(texts))], names=["all", "score"])

    return map_slices(rows, run, StructType([*rows.schema.fields, StructField("score", DoubleType())]), "all.text")


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document by a model fitted on the labels."""
    model = fitted(documents, labels)
    rows = scored(documents.select("doc_id", "text"), model).select(F.col("all.doc_id").alias("doc_id"), "score")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= ACCEPTED).cast("int").alias("predicted"))


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is ACCEPTED or more, all columns as they were."""
    return scored(documents, fitted(documents, labels)).where(F.col("score") >= ACCEPTED).select("all.*")
