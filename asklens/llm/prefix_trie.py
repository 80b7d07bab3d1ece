"""Prefix trie of conversations by fixed-length block hashing.

A node of depth d is a distinct sequence of the first d turns (role and text) of some conversation; the root has none.

A turn is its truncated SHA-256 and byte count; texts are not shuffled.  A prefix is known by a fingerprint that is a sum over its
turns of hashes of (turn, place), four lanes of 32 bits, so the fingerprints of all prefixes are running sums, also when one conversation holds a
third of all turns.  Turns are cut into blocks of ``block``:

1. conversations are grouped by their successive block digests: (fingerprint before, fingerprint after) of each block.  The groups
   are aggregated in the map tasks, so a block that many conversations share is one row before the shuffle;
2. where all conversations that pass a block boundary go on with the same block, its inner nodes are that group;
3. only where siblings diverge are turn boundaries refined: the distinct blocks, not the conversations, are opened and
   grouped by the fingerprint of every inner prefix.

Sums over subtrees need no walk over the tree.  A leaf counts for every prefix of its smallest member.  A node's saving is
credited to its smallest member too; the smallest member at some depth stays the smallest below it, so with
T = all that a conversation was credited, and A = what a node's own smallest member was credited above the node, the sum over the subtree is the
sum of T over all members less A.  Both are one more pass over the block groups.

Defined cases: a null role or text is empty; turns are ordered by number, nulls first, then by their digest; rows without a
conversation id belong to no conversation and are left out; equal conversations end in the same node; a conversation
without turns ends in the root; extra columns are not looked at; no conversation, no node; long texts are hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asklens.llm.common import join_groups, map_batches, written
from asklens.llm.ranged import ranged_sums

BLOCK = 4
LANES = 4
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_keys(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv_id, turn, content, n_bytes): a turn's digest and the UTF-8 bytes of its text."""
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    framed = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.unhex(F.substring(F.sha2(framed, 256), 1, 32)).alias("content"), F.octet_length(text).cast("bigint").alias("n_bytes"))


def placed_turns(keys: DataFrame) -> DataFrame:
    """``turn_keys`` with ``place``: the turn's number in its conversation from 0, without gaps."""
    placed = ranged_sums(keys.withColumn("one", F.lit(1).cast("bigint")),
                         [*keys.columns][0], [F.col("turn").asc_nulls_first(), F.col("content")], ["one"], "turn-keys")
    return placed.select("conv_id", F.col("before_one").alias("place"), "content", "n_bytes")


def _packed(sums: list[Column]) -> list[Column]:
    """Four sums, each modulo 2^32, as two numbers."""
    low = [s.bitwiseAND(F.lit(0xFFFFFFFF)) for s in sums]
    return [F.shiftleft(low[i], 32).bitwiseOR(low[i + 1]) for i in range(0, LANES, 2)]


def prefix_trie(placed: DataFrame, ids: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``placed``: conv_id, place (order in the conversation), content, n_bytes.  ``ids``: conv_id of all
    conversations, each once, also those without turns."""
    ids = written(ids.select("conv_id"), "trie-ids")
    one = F.lit(1).cast("bigint")
    dense = ranged_sums(placed.select("conv_id", "place", "content", "n_bytes", one.alias("one")), "conv_id",
                        [F.col("place")], ["one"], "trie-places")
    lanes = [f"l{i}" for i in range(LANES)]
    hashed = dense.select("conv_id", F.col("before_one").alias("place"), "n_bytes", *[
        F.xxhash64("content", "before_one", F.lit(i)).bitwiseAND(F.lit(0xFFFFFFFF)).alias(c) for i, c in enumerate(lanes)])
    summed = ranged_sums(hashed, "conv_id", [F.col("place")], lanes, "trie-prefixes")
    above, here = _packed([F.col(f"before_{c}") for c in lanes]), _packed([F.col(f"before_{c}") + F.col(c) for c in lanes])
    turns = summed.select("conv_id", (F.col("place") + 1).alias("depth"), F.expr(f"place div {block}").alias("block"), "n_bytes",
                          above[0].alias("p0"), above[1].alias("p1"), here[0].alias("f0"), here[1].alias("f1"))

    # 1. block digests: where a conversation enters and leaves each of its blocks
    inner = F.sort_array(F.collect_list(F.struct("depth", "f0", "f1", "p0", "p1", "n_bytes")))
    blocks = written(turns.groupBy("conv_id", "block").agg(inner.alias("turns")).select(
        "conv_id", "block", "turns", F.get("turns", F.lit(0))["p0"].alias("in0"), F.get("turns", F.lit(0))["p1"].alias("in1"),
        F.element_at("turns", -1)["depth"].alias("last"), F.element_at("turns", -1)["f0"].alias("out0"),
        F.element_at("turns", -1)["f1"].alias("out1")), "trie-blocks")
    digest = ["block", "in0", "in1", "last", "out0", "out1"]
    groups = written(blocks.groupBy(*digest).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.first("turns").alias("turns")), "trie-groups")

    # 2. and 3. the nodes inside the blocks
    siblings = written(groups.groupBy("block", "in0", "in1").agg(F.count(F.lit(1)).alias("siblings")), "trie-siblings")
    marked = written(join_groups(groups, siblings, ["block", "in0", "in1"], "siblings"), "trie-marked")

    def opened(which: str, *columns) -> DataFrame:
        return marked.where(which).select(F.explode("turns").alias("t"), *columns).select("t.*", *columns)

    node = ["depth", "f0", "f1"]
    refined = opened("siblings > 1", "n", "conv_id").groupBy(*node).agg(
        F.first("p0").alias("p0"), F.first("p1").alias("p1"), F.first("n_bytes").alias("n_bytes"),
        F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"))
    root = ids.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id")).where("n > 0").select(
        F.lit(0).cast("bigint").alias("depth"), *[F.lit(0).cast("bigint").alias(c) for c in ("f0", "f1")],
        *[F.lit(None).cast("bigint").alias(c) for c in ("p0", "p1")], F.lit(0).cast("bigint").alias("n_bytes"), "n", "conv_id")
    nodes = written(opened("siblings = 1", "n", "conv_id").unionByName(refined).unionByName(root), "trie-nodes")

    # children of each node, and the parent's smallest member; a parent may have a large share of all nodes
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p0").alias("f0"),
                                               F.col("p1").alias("f1")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.join(children, node, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))),
                    "trie-children")
    parents = written(nodes.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("f0").alias("p0"),
                                                           F.col("f1").alias("p1"), F.col("conv_id").alias("parent_conv_id"),
                                                           "n_children"), "trie-parents")
    related = join_groups(nodes.where("depth > 0"), parents.withColumnRenamed("n_children", "siblings"), ["depth", "p0", "p1"],
                          "siblings").select(*node, "conv_id", "parent_conv_id", "n", "n_children", "n_bytes").unionByName(
        nodes.where("depth = 0").select(*node, "conv_id", F.lit(None).cast(dict(ids.dtypes)["conv_id"]).alias("parent_conv_id"),
                                        "n", "n_children", "n_bytes"))

    # credits: each node's saving and each leaf go to the smallest member, and from there to all prefixes
    shared = nodes.where("n > 1 AND n_bytes > 0").select("conv_id", *node, ((F.col("n") - 1) * F.col("n_bytes")).alias("w"))
    credited = ranged_sums(shared, "conv_id", [F.col("depth")], ["w"], "trie-credits")
    credits = credited.select("conv_id", "w", F.lit(0).cast("bigint").alias("leaf")).unionByName(
        nodes.where("n_children = 0").select("conv_id", F.lit(0).cast("bigint").alias("w"), one.alias("leaf"))).groupBy(
        "conv_id").agg(F.sum("w").alias("w"), F.sum("leaf").alias("leaf"))
    lengths = blocks.groupBy("conv_id").agg(F.count(F.lit(1)).alias("blocks"))
    paid = written(credits.join(lengths, "conv_id", "left").select("conv_id", "w", "leaf", F.coalesce("blocks", F.lit(0)).alias("blocks")),
                   "trie-paid")
    sums = join_groups(blocks.select("conv_id", *digest), paid, ["conv_id"], "blocks").groupBy(*digest).agg(
        F.sum("w").alias("w"), F.sum("leaf").alias("leaf"))
    total = paid.agg(F.sum("w").alias("w"), F.sum("leaf").alias("leaf")).select(
        F.lit(0).cast("bigint").alias("depth"), *[F.lit(0).cast("bigint").alias(c) for c in ("f0", "f1")], "w", "leaf")
    opened_sums = marked.join(sums, digest, "left").select(F.explode("turns").alias("t"), "w", "leaf").select(
        "t.depth", "t.f0", "t.f1", F.coalesce("w", F.lit(0)).alias("w"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    per_node = opened_sums.groupBy(*node).agg(F.sum("w").alias("w"), F.sum("leaf").alias("leaf")).unionByName(total)
    ahead = credited.select(*node, F.col("before_w").alias("ahead"))

    # conversations that end in each node
    deepest = blocks.groupBy("conv_id").agg(F.max(F.struct("last", "out0", "out1")).alias("end"))
    ends = ids.join(deepest, "conv_id", "left").select(
        "conv_id", *[F.coalesce(F.col("end")[c], F.lit(0).cast("bigint")).alias(k) for c, k in zip(("last", "out0", "out1"), node)])
    out = related.join(per_node, node).join(ahead, node, "left").join(member_digests(ends, node), node, "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", F.col("leaf").alias("n_leaves"),
        F.when(F.col("n") > 1, F.col("w") - F.coalesce("ahead", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("saved_tokens"),
        F.coalesce("sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def member_digests(members: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, sha256) of the decimal conv_ids of each group, ascending, comma-joined.

    Ranges of (keys, conv_id) deal a large group over many tasks, each of which joins its ids to one string; a group's
    strings are then hashed in order as they pass, so no task holds a group."""
    n = len(keys)
    sort = [*keys, "conv_id"]
    dealt = members.select(*sort).repartitionByRange(*sort).sortWithinPartitions(*sort)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, key, held, seq = TaskContext.get().partitionId(), None, [], 0
        out: list[tuple] = []
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                if row[:n] != key or len(held) >= 1 << 16:
                    if held:
                        out.append((*key, part, seq, ",".join(held)))
                        seq += 1
                    key, held = row[:n], []
                held.append(str(row[n]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
                out = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, part, seq, ",".join(held))], names)

    names = [*keys, "part", "seq", "ids"]
    joined = map_batches(dealt, join, ", ".join([*[f"{k} bigint" for k in keys], "part bigint, seq bigint, ids string"]))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, out = None, None, []
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                if row[:n] != key:
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = row[:n], hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(row[-1].encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], [*keys, "sha256"])
                out = []
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, sha.hexdigest())], [*keys, "sha256"])

    ordered = joined.repartition(*keys).sortWithinPartitions(*keys, "part", "seq")
    return map_batches(ordered, digest, ", ".join([*[f"{k} bigint" for k in keys], "sha256 string"]))


def node_texts(nodes: DataFrame, turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
               text_col: str = "text") -> DataFrame:
    """``nodes`` of ``conversation_trie(turns)`` with the role and text of their last turn (null for the root)."""
    slim = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"),
        F.coalesce(text_col, F.lit("")).alias("text"), F.lit(1).cast("bigint").alias("one"))
    content = turn_keys(slim.select("conv_id", "turn", "role", "text")).columns[2]
    framed = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    keyed = slim.withColumn(content, F.unhex(F.substring(F.sha2(framed, 256), 1, 32)))
    placed = ranged_sums(keyed, "conv_id", [F.col("turn").asc_nulls_first(), F.col(content)], ["one"], "trie-texts")
    return nodes.join(placed.select("conv_id", (F.col("before_one") + 1).alias("depth"), "role", "text"), ["conv_id", "depth"], "left")


def conversation_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The trie of the conversations as they are: see ``prefix_trie``."""
    placed = placed_turns(turn_keys(turns, conv_col, turn_col, role_col, text_col))
    return prefix_trie(placed, placed.select("conv_id").distinct(), block)
