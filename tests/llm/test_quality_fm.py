from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import FMClassifier
from pyspark.ml.linalg import Vectors

from tallyroll.llm import quality_fm

SF = "/root/testdata/sf0.01"


def test_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    shape = quality_fm.N_FEATURES
    model = quality_fm.Model(0.2, rng.normal(size=shape) * 0.1, rng.normal(size=(shape, 3)) * 0.1)
    texts = pa.array(["Some words, some words again!\nAnd a | b.", "", None, "é 😀 # 1"])
    doc, number, value = quality_fm.features(texts)
    for place, score in enumerate(model.score(texts)):
        mine = doc == place
        numbers, values = number[mine], value[mine]
        raw = model.bias + (model.linear[numbers] * values).sum()
        for a in range(len(numbers)):
            for b in range(a):
                raw += model.factors[numbers[a]] @ model.factors[numbers[b]] * values[a] * values[b]
        assert score == pytest.approx(1 / (1 + np.exp(-raw)))


def test_score_is_that_of_spark(spark):
    texts = ["good words here, and more.", "bad### worse$$$", "good text again.", "bad*** bad&&&"]
    doc, number, value = quality_fm.features(pa.array(texts))
    rows = []
    for place in range(4):
        mine = doc == place
        rows.append((float(place % 2 == 0), Vectors.sparse(quality_fm.N_FEATURES, number[mine].tolist(), value[mine].tolist())))
    training = spark.createDataFrame(rows, ["label", "features"])
    fitted = FMClassifier(factorSize=2, maxIter=20, stepSize=0.1, seed=1).fit(training)
    model = quality_fm.Model(fitted.intercept, fitted.linear.toArray(), fitted.factors.toArray())
    wanted = [row.probability[1] for row in fitted.transform(training).collect()]
    assert model.score(pa.array(texts)) == pytest.approx(wanted)


def test_features_do_not_depend_on_neighbours():
    texts = ["One two two. THREE!", "", None, "x" * 5000, "| a | b |\n\n9", "One two two. THREE!"]
    doc, number, value = quality_fm.features(pa.array(texts))
    for place, text in enumerate(texts):
        _, alone, its = quality_fm.features(pa.array([text], pa.string()))
        mine = doc == place
        assert (number[mine] == alone).all() and value[mine] == pytest.approx(its)


def test_held_out_quality(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {row.doc_id: row for row in quality_fm.quality_scores(documents, labels).collect()}
    assert len(rows) == documents.count()
    right = []
    for doc_id, row in rows.items():
        assert row.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.3)
    for label in labels.collect():
        row = rows[label.doc_id]
        if row.held_out:
            right.append((label.quality, row.score))
    ones = [score for quality, score in right if quality]
    zeros = [score for quality, score in right if not quality]
    assert np.mean([[one > zero for zero in zeros] for one in ones]) > 0.97
    assert np.mean([score >= 0.3 for score in ones]) > 0.95


def test_labels_of_the_held_out_fold_are_never_used(spark):
    documents = spark.createDataFrame([(n, f"text number {n}.") for n in range(40)], "doc_id long, text string")
    labels = documents.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS quality")
    ids = {row.doc_id for row in quality_fm._training_rows(documents, labels).collect()}
    assert ids == {n for n in range(40) if zlib.crc32(str(n).encode()) % 5}


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", "x"), (None, "no id", "x"), (3, "w " * 60_000, "x"), (3, "w " * 60_000, "x"), (4, "z" * 200_000, "x")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, score string").selectExpr("*", "1 AS `all`", "2 AS `a.b`")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (9, 0), (3, 7)], "doc_id long, quality int")
    found = quality_fm.quality_scores(documents, labels).collect()
    assert len(found) == 6 and all(0 < row.score < 1 for row in found)
    left = quality_fm.accepted(documents, labels)
    assert left.columns == documents.columns and left.count() == 6
    assert quality_fm.quality_scores(documents.limit(0), labels).count() == 0
    assert {row.score for row in quality_fm.quality_scores(documents, labels.limit(0)).collect()} == {0.5}
