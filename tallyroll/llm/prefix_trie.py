"""The trie of all prefixes of conversations, by collapse of whole sequences.

Turns become digests at once, so texts are never shuffled. A conversation's turns pass through
one chain of digests, row by row in order: the value behind turn d names the prefix of d turns,
and the last value names the whole sequence. Identical conversations collapse to one sequence
with a weight, and a list of the conversations that end there. Sequences that are proper prefixes
of others leave by an anti-join, which makes the rest the leaves. The trie's nodes are the
prefixes of the sequences, added up by weight.

What a subtree holds is added up without visiting it: every node is owned by one leaf that lies
under it, each leaf's path is summed from its end, and every node adds up the sums of the leaves
that pass through it.

A root, a common first turn or a much repeated conversation is folded where it lies before it is
shuffled, its children find it through salted keys, and its list of ends is digested in order from
blocks of ids that other tasks have joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroll.llm.batches import kept_table

# Conversations in a row that begin alike, and the most turns they share.
FAMILY, SHARED_TURNS = 20, 4
ROOT = hashlib.sha256(b"").digest()
# Ids joined to one text before an end list is digested.
_ENDS_BLOCK = 1024
# Parts that a node's children are dealt to.
_SALTS = 64
_CHAINED = "conv_id long, depth int, node binary, parent binary, words int, last boolean"


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation has from the first of its family."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(SHARED_TURNS)).cast("int")


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, digest, words``: each turn's place from 1 and digest, without its text.

    Turns are ordered by number, null first; equal numbers by role and then by digest.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        # The role's length keeps it apart from the text.
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")).alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    return rows.select("conv_id", F.row_number().over(order).alias("place"), "digest", "words")


def rebuilt(ordered: DataFrame) -> DataFrame:
    """``conv_id, part, place, digest, words``: turns of rebuilt conversations in order of part and place.

    Part 0 is the textless root, part 1 the turns taken from the first of the family, part 2 a
    conversation's own turns behind as many. A conversation without any turn left has part 0 alone.
    """
    ids = ordered.select("conv_id").distinct()
    nothing = F.lit(None).cast("binary")
    roots = ids.select("conv_id", F.lit(0).alias("part"), F.lit(0).alias("place"), nothing.alias("digest"), F.lit(0).alias("words"))
    firsts = ordered.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < SHARED_TURNS))
    wanted = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"), shared_turns(F.col("conv_id")).alias("h"))
    taken = (
        wanted.where("h > 0")
        .join(firsts.withColumnRenamed("conv_id", "family"), "family")
        .where("place <= h")
        .select("conv_id", F.lit(1).alias("part"), "place", "digest", "words")
    )
    own = ordered.where(F.col("place") > shared_turns(F.col("conv_id")))
    own = own.select("conv_id", F.lit(2).alias("part"), "place", "digest", "words")
    return roots.union(taken).union(own)


def chained(rows: DataFrame) -> DataFrame:
    """``conv_id, depth, node, parent, words, last`` of rebuilt turns: the digest of each prefix, and of the one before.

    Rows stream in order with one digest in memory, so a conversation may have any number of turns.
    """
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # The last row seen, until the next one tells whether it ends its conversation.
        for batch in batches:
            found = []
            columns = (batch.column(name).to_pylist() for name in ("conv_id", "digest", "words"))
            for conv_id, digest, words in zip(*columns, strict=True):
                if digest is None:
                    row = (conv_id, 0, ROOT, None, 0)
                else:
                    node = hashlib.sha256(waiting[2] + digest).digest()
                    row = (conv_id, waiting[1] + 1, node, waiting[2], words)
                if waiting:
                    found.append((*waiting, waiting[0] != conv_id))
                waiting = row
            if found:
                yield _chain_batch(found)
        if waiting:
            yield _chain_batch([(*waiting, True)])

    return ordered.mapInArrow(run, _CHAINED)


def _chain_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.bool_())
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["conv_id", "depth", "node", "parent", "words", "last"])


def sequences(chain: DataFrame) -> DataFrame:
    """``sequence, weight, first``: each distinct whole sequence, its conversations and the least of them."""
    ends = chain.where("last").groupBy(F.col("node").alias("sequence"))
    return ends.agg(F.count("*").alias("weight"), F.min("conv_id").alias("first"))


def end_digests(chain: DataFrame) -> DataFrame:
    """``sequence, ends_sha256``: the digest of the ascending, comma-joined ids that end at each sequence.

    Blocks of ids are joined first; a sequence's blocks then stream through one digest in order.
    """
    block = F.floor(F.col("conv_id") / _ENDS_BLOCK)
    ids = F.array_join(F.array_sort(F.collect_list("conv_id")), ",")
    blocks = chain.where("last").groupBy(F.col("node").alias("sequence"), block.alias("block")).agg(ids.alias("ids"))
    ordered = blocks.repartition("sequence").sortWithinPartitions("sequence", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            done = []
            for sequence, ids in zip(batch.column("sequence").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if sequence == current:
                    state.update(b",")
                else:
                    if state:
                        done.append((current, state.hexdigest()))
                    current, state = sequence, hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield _ends_batch(done)
        if state:
            yield _ends_batch([(current, state.hexdigest())])

    return ordered.mapInArrow(run, "sequence binary, ends_sha256 string")


def _ends_batch(rows: list[tuple]) -> pa.RecordBatch:
    sequence, digest = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(sequence, pa.binary()), pa.array(digest)], names=["sequence", "ends_sha256"])


def weighted_prefixes(chain: DataFrame) -> DataFrame:
    """``sequence, weight, first, leaf, depth, node, parent, words``: the path of every distinct sequence.

    ``leaf`` says that no other sequence goes on from this one.
    """
    whole = sequences(chain)
    paths = chain.drop("last").withColumnRenamed("conv_id", "first").join(whole, "first")
    paths = kept_table(paths, "trie-paths")
    inner = paths.where("parent IS NOT NULL").select(F.col("parent").alias("sequence")).distinct()
    leaves = paths.where("node = sequence").select("sequence").join(inner, "sequence", "left_anti")
    marked = paths.join(leaves.withColumn("leaf", F.lit(True)), "sequence", "left")
    return kept_table(marked.withColumn("leaf", F.coalesce("leaf", F.lit(False))), "trie-prefixes")


def _nodes(prefixes: DataFrame) -> DataFrame:
    """``node, parent, depth, words, conv_id, n_convs, n_leaves, owner``: the prefixes added up by weight."""
    return prefixes.groupBy("node").agg(
        F.min("parent").alias("parent"),
        F.min("depth").alias("depth"),
        F.min("words").alias("words"),
        F.min("first").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.count_if("leaf").alias("n_leaves"),
        F.min(F.when(F.col("leaf"), F.col("sequence"))).alias("owner"),
    )


def _saved(prefixes: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, saved_tokens``: what all nodes of each subtree save.

    A node's own saving stands on its owner's path alone, at its depth, so it is counted once in
    every subtree that holds it.
    """
    own = nodes.select(F.col("owner").alias("sequence"), "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("own"))
    paths = prefixes.where("leaf").select("sequence", "depth", "node").join(own, ["sequence", "depth"], "left")
    to_end = Window.partitionBy("sequence").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    below = paths.select("node", F.sum(F.coalesce("own", F.lit(0))).over(to_end).alias("below"))
    return below.groupBy("node").agg(F.sum("below").alias("saved_tokens"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of rebuilt ``conversations(conv_id, turn, role, text)``, a row a node.

    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``,
    where a node is named by its least member and its depth. Each conversation begins with the
    turns it shares with the first of its family and goes on with its own behind them. A null role
    or text is empty; turns without a number come first, and those with equal numbers are ordered
    by role and then by a digest of role and text; a repeated row is a turn of its own. Rows
    without a conv_id belong to no conversation. Texts of any length count whole. Other columns
    are ignored; an empty table gives no rows, not even a root.
    """
    ordered = kept_table(turns(conversations), "trie-turns")
    chain = kept_table(chained(rebuilt(ordered)), "trie-chain")
    prefixes = weighted_prefixes(chain)
    nodes = kept_table(_nodes(prefixes), "trie-nodes")
    salt = F.pmod(F.xxhash64("node"), F.lit(_SALTS))
    children = nodes.where("parent IS NOT NULL").withColumn("salt", salt)
    # Children meet their parent once a salt, so no task meets all children of one node.
    parts = kept_table(children.groupBy("parent", "salt").agg(F.count("*").alias("n")), "trie-children")
    parents = parts.join(nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent")
    above = children.join(parents.drop("n"), ["parent", "salt"]).select("node", "parent_conv_id")
    counts = parts.groupBy(F.col("parent").alias("node")).agg(F.sum("n").alias("n_children"))
    found = (
        nodes.join(above, "node", "left")
        .join(counts, "node", "left")
        .join(_saved(prefixes, nodes), "node")
        .join(end_digests(chain).withColumnRenamed("sequence", "node"), "node", "left")
    )
    return found.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"),
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
