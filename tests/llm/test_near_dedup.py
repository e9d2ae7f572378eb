from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyroll.llm import near_dedup
from tallyroll.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda found: found[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_force(rows):
    """(doc_id, n_shingles, component_id) by comparing every pair that shares a shingle."""
    sets = [shingles(text) for _, text in rows]
    holders = defaultdict(list)
    for number, found in enumerate(sets):
        for shingle in found:
            holders[shingle].append(number)
    parent = list(range(len(rows)))

    def top(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for number, found in enumerate(sets):
        for other in {other for shingle in found for other in holders[shingle] if other < number}:
            both = len(found & sets[other])
            if 100 * both >= 75 * len(found | sets[other]):
                parent[top(number)] = top(other)
    least = {}
    for number, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(number)] = min(doc_id, least.get(top(number), doc_id))
    return sorted((str(doc_id), len(found), str(least.get(top(n)))) for n, ((doc_id, _), found) in enumerate(zip(rows, sets)))


def result(documents):
    rows = near_dedup.near_duplicates(documents).collect()
    for row in rows:
        assert row.kept == (row.doc_id == row.component_id)
    return sorted((str(row.doc_id), row.n_shingles, str(row.component_id)) for row in rows)


def test_whole_small_table(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(row.doc_id, row.text) for row in documents.select("doc_id", "text").collect()]
    assert result(documents) == brute_force(rows)


def edited(words, rng, count):
    words = list(words)
    for _ in range(count):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def test_large_group_whose_members_are_not_all_alike(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = random.Random(5)
    base = [f"word{rng.randrange(3000)}" for _ in range(150)]
    texts = [" ".join(base)] * 5
    chain = base
    for _ in range(60):  # a chain: neighbours are alike, its ends are not
        chain = edited(chain, rng, 2).split()
        texts.append(" ".join(chain))
    texts += [edited(base, rng, rng.randrange(1, 12)) for _ in range(150)]
    texts += [" ".join(f"other{rng.randrange(9000)}" for _ in range(80)) for _ in range(40)]
    rows = [(number * 3 + 1, text) for number, text in enumerate(texts)]
    rng.shuffle(rows)
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(documents) == brute_force(rows)


def test_odd_rows(spark):
    long_text = " ".join(f"w{number}" for number in range(60000))
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n", "en", "a", 3),
        (4, "One two", "en", "a", 7),
        (5, "one\ttwo", None, None, None),
        (6, "one two three four five", "en", "b", 1),
        (None, "ONE two three four five", "en", "b", 1),
        (7, "É two three four five", "en", "b", 1),
        (8, "é two three four five", "en", "b", 1),
        (9, long_text, "en", "c", 9),
        (9, long_text, "en", "c", 9),
        (10, long_text + " end", "en", "c", 9),
    ]
    documents = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS kept", "2 AS row", "3 AS `class`", "'x' AS `a.b`")
    assert result(documents) == brute_force([(row[0], row[1]) for row in rows])
    left = near_dedup.without_near_duplicates(documents)
    assert left.columns == documents.columns
    kept = sorted((row.doc_id for row in left.collect()), key=str)
    assert kept == [1, 2, 3, 4, 6, 7, 8, 9]
    assert result(documents.limit(0)) == []
    assert near_dedup.without_near_duplicates(documents.limit(0)).count() == 0


def test_groups_that_share_an_id_or_lack_one(spark):
    rows = [
        (None, "alpha beta gamma delta epsilon"),
        (None, "one two three four five six"),
        (None, "ONE two three four five six"),
        (7, "red green blue white black"),
        (7, "north south east west up"),
        (7, "north south east west up"),
        (None, "North south east west up"),
        (8, "Red green blue white black"),
    ]
    documents = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert result(documents) == brute_force(rows)
    left = near_dedup.without_near_duplicates(documents).collect()
    assert sorted((str(row.doc_id), row.text.lower()) for row in left) == [
        ("7", "north south east west up"),
        ("7", "red green blue white black"),
        ("None", "alpha beta gamma delta epsilon"),
        ("None", "one two three four five six"),
    ]


def test_exact_boundary():
    left, right = np.arange(7, dtype=np.uint64), np.arange(1, 8, dtype=np.uint64)
    assert near_dedup.similar(left, right)  # 6 of 8
    assert not near_dedup.similar(left[:-1], right)  # 5 of 8


def test_sketches_estimate_high_similarity():
    rng = random.Random(3)
    for share in (0.75, 0.9):
        for _ in range(50):
            common = [rng.getrandbits(64) for _ in range(1000)]
            extra = round(1000 * (1 / share - 1) / 2)
            sets = [np.unique(np.array(common + [rng.getrandbits(64) for _ in range(extra)], np.uint64)) for _ in range(2)]
            bits = near_dedup.odd_sketches(np.stack([near_dedup.min_samples(found) for found in sets])).view(np.uint64)
            assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= near_dedup.SKETCH_REACH


@pytest.mark.parametrize("texts", [["a b c d e f", "", None, "x"], [None, None], ["  lead and trail  "]])
def test_shingle_counts(texts):
    assert [len(found) for found in near_dedup.shingle_sets(pa.array(texts, pa.string()))] == [len(shingles(t)) for t in texts]


def test_components(spark):
    rng = random.Random(7)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000, n) for n in range(1001, 1300)]
    pairs += [(n, n + 1) for n in range(2000, 2040)]
    parent = {}

    def top(node):
        while parent.setdefault(node, node) != node:
            node = parent[node]
        return node

    for a, b in pairs:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    wanted = {(node, top(node)) for pair in pairs for node in pair if pair[0] != pair[1]}
    found = {(row.node, row.root) for row in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == wanted


@pytest.mark.parametrize("size", [64, 1024, 4096])
def test_words_that_sums_of_powers_confuse_are_not_linked(spark, size):
    """The word of 0s and 1s by parity of bits, and the one with both exchanged, are other words."""
    words = ["".join(letters[place.bit_count() % 2] for place in range(size)) for letters in ("ab", "ba")]
    rows = spark.createDataFrame([(number, word) for number, word in enumerate(words)], "doc_id long, text string")
    assert sorted((row.doc_id, row.component_id) for row in near_dedup.near_duplicates(rows).collect()) == [(0, 0), (1, 1)]


def test_links_among_members_a_centre_did_not_take(spark):
    """2,000 classes that share a centre, unlike it and each other but for 10 pairs: these are linked."""
    chosen = random.Random(12)
    texts = [" ".join(f"w{chosen.randrange(10**9)}" for _ in range(60)) for _ in range(1991)]
    texts += [text + " and one" for text in texts[:10]]
    signatures = near_dedup.signed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    classes = signatures.selectExpr("class", "sketch", "cast(octet_length(all.text) AS long) AS size", "all.text AS text")
    center = classes.orderBy("class").first()["class"]
    judged = classes.where(F.col("class") != center).select(F.lit(bytes(center)).alias("center"), "class", F.lit(False).alias("linked"))
    roots = spark.createDataFrame([], "node binary, root binary")
    links = near_dedup._rest_links(judged, roots, classes).collect()
    assert 9 <= len({frozenset((bytes(row.a), bytes(row.b))) for row in links}) <= 10


def test_blocks_follow_the_size_of_texts(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 1000)
    classes = spark.range(40).selectExpr("unhex(sha2(cast(id AS string), 256)) AS class", "500L AS size")
    judged = classes.select(F.lit(b"c").alias("center"), "class", F.lit(False).alias("linked"))
    roots = spark.createDataFrame([], "node binary, root binary")
    tasks = near_dedup._block_tasks(judged, roots, classes)
    assert tasks.agg(F.max("i")).first()[0] >= 15
