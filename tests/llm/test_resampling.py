"""Importance resampling against a plain one, and checksums of substrings against the library's."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tallyroll.llm import oracle_sql
from tallyroll.llm.prefix_crc import running_crcs, shifted, substring_crcs
from tallyroll.llm.resampling import feature_checksums, resampled

COLUMNS = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]


def _words(text):
    lowered = "".join(chr(ord(sign) + 32) if "A" <= sign <= "Z" else sign for sign in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def _checksums(text, longest):
    words = _words(text)
    return [
        zlib.crc32(" ".join(words[at : at + size]).encode())
        for size in range(1, longest + 1)
        for at in range(len(words) - size + 1)
    ]


def plain(documents, target, longest=1, buckets=10_000, percent=10, seed=2024, fewest=20):
    features = [[value % buckets for value in _checksums(text, longest)] for _, text in documents]
    s = Counter(value for each in features for value in each)
    t = Counter(value % buckets for text in target for value in _checksums(text, longest))
    all_s, all_t = s.total(), t.total()

    def gain(bucket):
        return math.floor(1000 * math.log((t[bucket] + 1) * (all_s + buckets) / ((s[bucket] + 1) * (all_t + buckets))))

    rows = []
    for (doc_id, text), each in zip(documents, features, strict=True):
        weight = sum(map(gain, each)) // len(each) if each else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append([doc_id, len(_words(text)), len(each), weight, score, None])
    able = [row for row in rows if row[1] >= fewest]
    able.sort(key=lambda row: (-row[4], row[0] is None, row[0] or 0))
    for number, row in enumerate(able[: len(able) * percent // 100], 1):
        row[5] = number
    return sorted(map(tuple, rows), key=str)


def _found(spark, documents, target, **options):
    rows = spark.createDataFrame(documents, "doc_id long, text string")
    wanted = spark.createDataFrame([(text,) for text in target], "text string")
    return sorted((tuple(row) for row in resampled(rows, wanted, **options).select(COLUMNS).collect()), key=str)


def test_checksums_of_substrings():
    chosen = np.random.default_rng(1)
    for size in (0, 1, 255, 256, 257, 5000, 70_001):
        data = chosen.integers(0, 256, size, dtype=np.uint8)
        ends = np.sort(chosen.integers(0, size + 1, (300, 2)), axis=1)
        found = substring_crcs(running_crcs(data), ends[:, 0], ends[:, 1])
        assert found.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in ends.tolist()]


def test_shifts_add_up():
    registers = np.array([1, 0xFFFFFFFF, 0x12345678], np.uint32)
    once = shifted(registers, np.array([700, 700, 700]))
    assert shifted(shifted(registers, np.array([300] * 3)), np.array([400] * 3)).tolist() == once.tolist()


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_features_of_odd_texts(longest):
    texts = ["Ab c-d  É2x!", None, "", "  ", "ñandú ZZ9 K  x", "y", "x" * 5000 + " y", "\x00a\x7fb", "é", "A B C D E F"]
    found, counts, n_words = feature_checksums(pa.array(texts), longest)
    assert found.tolist() == [value for text in texts for value in _checksums(text, longest)]
    assert counts.tolist() == [len(_checksums(text, longest)) for text in texts]
    assert n_words.tolist() == [len(_words(text)) for text in texts]


@pytest.mark.parametrize("options", [{}, {"longest": 3, "buckets": 64, "percent": 40, "seed": 7}])
def test_small_tables(spark, options):
    chosen = random.Random(2)
    vocabulary = ["alpha", "beta", "Gamma", "été", "delta9", "x"]
    documents = [
        (number, " ".join(chosen.choices(vocabulary, k=chosen.randrange(0, 60)))) for number in range(300)
    ] + [(None, None), (1000, ""), (1001, None), (1002, "word " * 30_000)]
    target = ["alpha beta alpha", None, "delta9"]
    found = _found(spark, documents, target, **options)
    names = {"fewest_words": "fewest"}
    assert found == plain(documents, target, **{names.get(key, key): value for key, value in options.items()})
    assert sorted(row[5] for row in found if row[5]) == list(range(1, 1 + sum(row[1] >= 20 for row in found) * options.get("percent", 10) // 100))


def test_repeated_rows_and_null_ids_all_get_ranks(spark):
    text = " ".join(["same"] * 25)
    found = _found(spark, [(5, text)] * 6 + [(None, text)] * 6 + [(9, text)] * 8, ["same"], percent=100)
    assert sorted(row[5] for row in found) == list(range(1, 21))
    assert len({(row[0], row[4]) for row in found}) == 3


def test_empty_tables_and_clashing_names(spark):
    rows = spark.createDataFrame([], "doc_id long, text string")
    assert resampled(rows, rows.select("text")).count() == 0
    rows = spark.createDataFrame([(1, "a " * 30, 4, 5, 6)], "doc_id long, text string, row long, score long, features long")
    found = resampled(rows, rows.select("text").limit(0), percent=100).select(COLUMNS).collect()
    assert [tuple(row) for row in found] == plain([(1, "a " * 30)], [], percent=100)


def test_given_documents_against_plain_and_sql(spark):
    folder = "/root/testdata/sf0.001"
    documents, target = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "benchmark"))
    found = sorted((tuple(row) for row in resampled(documents, target).select(COLUMNS).collect()), key=str)
    assert found == plain([(row.doc_id, row.text) for row in documents.collect()], [row.text for row in target.collect()])
    with duckdb.connect() as database:
        for name in ("documents", "benchmark"):
            database.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
        columns = [name for name in COLUMNS if name != "n_words"]
        wanted = database.sql(f"SELECT {', '.join(columns)} FROM ({oracle_sql.RESAMPLING})").fetchall()
    assert sorted(((row[0], *row[2:]) for row in found), key=str) == sorted(wanted, key=str)
