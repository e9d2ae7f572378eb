"""The trie of conversation prefixes against a plain recursive one."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from tallyroll.llm import oracle_sql
from tallyroll.llm.prefix_trie import chained, prefix_trie, rebuilt, sequences, turns

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(rows: list[tuple]) -> list[tuple]:
    def place(row):
        _, turn, role, text = row
        digest = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
        return (turn is not None, turn or 0, role or "", digest)

    own = defaultdict(list)
    for row in sorted((row for row in rows if row[0] is not None), key=place):
        own[row[0]].append((row[2] or "", row[3] or ""))
    members, ends = defaultdict(list), defaultdict(list)
    for conv_id in sorted(own):
        h = zlib.crc32(str(conv_id).encode()) % 4
        whole = tuple(own.get(conv_id - int(conv_id % 20), [])[:h] + own[conv_id][h:])
        ends[whole].append(conv_id)
        for depth in range(len(whole) + 1):
            members[whole[:depth]].append(conv_id)
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", prefix[-1][1])) if prefix else 0
        leaves[prefix] = sum(leaves[child] for child in children[prefix]) or 1
        saved[prefix] = (len(members[prefix]) - 1) * words + sum(saved[child] for child in children[prefix])
    return [
        (
            members[prefix][0],
            len(prefix),
            members[prefix[:-1]][0] if prefix else None,
            len(members[prefix]),
            len(children[prefix]),
            leaves[prefix],
            saved[prefix],
            hashlib.sha256(",".join(map(str, ends[prefix])).encode()).hexdigest(),
        )
        for prefix in members
    ]


def _ordered(rows):
    return sorted((tuple(row) for row in rows), key=lambda row: (row[1], row[0], row[7], row[3]))


def _check(spark, rows):
    found = prefix_trie(spark.createDataFrame(rows, SCHEMA)).select(COLUMNS).collect()
    assert _ordered(found) == _ordered(plain_trie(rows))
    return found


def test_shared_heads_copies_and_prefixes(spark):
    rows = []
    for conv_id in range(0, 65):
        for turn in range(conv_id % 5):
            rows.append((conv_id, turn, "user" if turn % 2 == 0 else "assistant", f"turn {turn} of {conv_id % 3}"))
    # Copies in number, across blocks of ids, and conversations that go on from them.
    for conv_id in range(4000, 6600, 2):
        rows += [(conv_id, 0, "user", "same first words"), (conv_id, 1, "assistant", "same  answer"), (conv_id, 2, "user", "a")]
        rows += [(conv_id, 3, "assistant", "b")] + ([(conv_id, 4, "user", "more here")] if conv_id % 100 == 0 else [])
    found = _check(spark, rows)
    assert max(row.n_convs for row in found if row.depth == 4) > 300


def test_odd_rows(spark):
    rows = [
        (7, None, None, None),
        (7, 2, "user", ""),
        (7, 2, "user", "tie"),
        (7, 2, "assistant", "tie"),
        (7, 2, "user", "tie"),
        (8, 0, "a", "bc"),
        (9, 0, "ab", "c"),
        (40, 0, "user", "x" * 100_000 + " y"),
        (41, 0, "user", "own"),
        (42, 0, "user", "one"),
        (43, 5, None, "  \t "),
        (2**62, 0, "user", "far"),
        (None, 0, "user", "no conversation"),
    ]
    _check(spark, rows)
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)).count() == 0
    clashing = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS depth", "2 AS node", "3 AS place", "4 AS sequence", "5 AS leaf", "6 AS words", "7 AS h"
    )
    assert _ordered(prefix_trie(clashing).select(COLUMNS).collect()) == _ordered(plain_trie(rows))


def test_a_very_long_conversation_streams(spark):
    rows = spark.range(30_000).select(
        F.lit(20).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.lit("user").alias("role"),
        F.concat(F.lit("w "), (F.col("id") % 7).cast("string")).alias("text"),
    )
    nodes = prefix_trie(rows.union(rows.selectExpr("CAST(40 AS LONG)", "turn", "role", "text")))
    found = nodes.agg(F.count("*"), F.max("depth"), F.max("n_leaves"), F.max("saved_tokens"), F.min("n_convs")).first()
    assert tuple(found) == (30_001, 30_000, 1, 60_000, 2)


def test_sequences_collapse(spark):
    rows = [(conv_id, 0, "user", "hello") for conv_id in (100, 120, 140)] + [(160, 0, "user", "other")]
    chain = chained(rebuilt(turns(spark.createDataFrame(rows, SCHEMA))))
    assert sorted((row.weight, row.first) for row in sequences(chain).collect()) == [(1, 160), (3, 100)]


def test_given_table_against_plain_and_sql(spark):
    path = "/root/testdata/sf0.001/conversations.parquet"
    rows = [tuple(row) for row in spark.read.parquet(path).select("conv_id", "turn", "role", "text").collect()]
    found = _check(spark, rows)
    with duckdb.connect() as database:
        database.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}')")
        wanted = database.sql(f"SELECT {', '.join(COLUMNS)} FROM ({oracle_sql.PREFIX_TRIE})").fetchall()
    assert _ordered(found) == _ordered(wanted)
