from __future__ import annotations

import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline  # noqa: E402
import test_near_dedup  # noqa: E402
import test_pii  # noqa: E402

from tallyroll.llm import line_rules, quality_fm  # noqa: E402
from tallyroll.llm.batches import kept_table  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage gave, from the documents on."""
    found = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        found.append(kept_table(stage(spark, found[-1], SF), f"test-{name}"))
    return [(rows.columns, [tuple(row) for row in rows.collect()]) for rows in found]


def test_columns(stages):
    columns = stages[0][0]
    assert [each[0] for each in stages[:-1]] == [columns] * 5


def test_classifier(spark, stages):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    scores = quality_fm.quality_scores(documents, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    good = {row.doc_id for row in scores if row.score >= 0.3}
    assert sorted(stages[1][1]) == sorted(row for row in stages[0][1] if row[0] in good)
    assert 0 < len(good) < len(scores)


def test_rules(stages):
    wanted = []
    for doc_id, text, *rest, n_chars in stages[1][1]:
        found = line_rules.judge(text)
        if found.kept:
            wanted.append((doc_id, found.clean, *rest, len(found.clean) if found.n_bad_lines else n_chars))
    assert sorted(stages[2][1]) == sorted(wanted)


def test_near_duplicates(stages):
    groups = test_near_dedup.brute_force([row[:2] for row in stages[2][1]])
    kept = {doc_id for doc_id, _, component in groups if doc_id == component}
    assert sorted(stages[3][1]) == sorted(row for row in stages[2][1] if str(row[0]) in kept)
    assert len(stages[3][1]) < len(stages[2][1])


def test_personal_data(stages):
    after = {row[0]: row for row in stages[4][1]}
    assert len(after) == len(stages[3][1])
    for doc_id, text, *rest, n_chars in stages[3][1]:
        spans = [span.split(":") for span in test_pii.brute_force(text)]
        _, clean, *others, length = after[doc_id]
        assert others == rest
        if not spans and "[SSN]" not in clean and "[IBAN]" not in clean:
            assert (clean, length) == (text, n_chars)
            continue
        assert length == len(clean)
        for _, start, end in spans:
            assert text[int(start) : int(end)] not in clean


def test_packing(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    columns, rows = stages[5]
    pieces = [dict(zip(columns, row)) for row in rows]
    of_doc, windows = defaultdict(list), defaultdict(list)
    for piece in pieces:
        assert zlib.crc32(piece["ids"]) == piece["ids_crc32"]
        of_doc[piece["doc_id"]].append((piece["start"], np.frombuffer(piece["ids"], "<u4").tolist()))
        windows[piece["sequence_id"]].append((piece["offset"], piece["length"]))
    for doc_id, text, *_ in stages[4][1]:
        ids = [number for _, part in sorted(of_doc[doc_id]) for number in part]
        assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
    for found in windows.values():
        assert [offset for offset, _ in sorted(found)] == np.cumsum([0, *(n for _, n in sorted(found))])[:-1].tolist()
    assert sorted(sum(n for _, n in found) for found in windows.values())[1:] == [1024] * (len(windows) - 1)


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(tuple(row) for row in corpus_pipeline.run(spark, SF).collect()) == sorted(stages[5][1])
    assert corpus_pipeline.ORACLE_SQL is None


def test_odd_documents(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", "a", 0), (5, "x" * 100_000, None, None, None)], documents.schema
    )
    for rows in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            rows = kept_table(stage(spark, rows, SF), f"odd-{name}")
