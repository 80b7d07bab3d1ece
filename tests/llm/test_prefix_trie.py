import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from asklens.llm import prefix_trie, ranged
from asklens.llm.queries import op11_conversation_trie, rebuilt

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(sequences):
    """Every node by listing all prefixes of all conversations."""
    members, children = defaultdict(list), defaultdict(set)
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1].encode()) if node else 0
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(sequences[c]) == len(node))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node],
                    saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def sequences(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            convs[c].append(((turn is not None, turn or 0, digest), (role, text)))
    return {c: tuple(t for _, t in sorted(v)) for c, v in convs.items()}


def remade(convs):
    out = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        out[c] = convs.get(base, ())[:h] + convs[c][h:]
    return out


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_against_all_prefixes(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(op11_conversation_trie(spark, SF)) == trie(remade(sequences(rows)))


def odd_rows():
    rng = random.Random(11)
    rows = []
    for c in [*range(0, 40), *range(-12, 0), 10**12]:
        start = rng.choice(["a", "a", "a", "b", None])
        for turn in range(rng.choice([1, 2, 3, 5, 9, 12])):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", start if turn < 3 else rng.choice(["x", "ß🙂", "y" * 50])))
    rows += [(50, t, "user", f"long {t % 3}") for t in range(400)]
    rows += [(51, t, "user", f"long {t % 3}") for t in range(301)]  # a prefix of the one before
    rows += [(52, None, None, None), (52, None, "user", "tie"), (52, None, "user", "tie"), (52, 3, "", ""), (52, 3, "a", "")]
    rows += [(None, 1, "user", "no conversation"), (None, None, None, None)]
    rows += [(c, 0, "user", "one text of many") for c in range(100, 400)]
    rows += [(c, 0, "user", "without a first of five") for c in range(601, 620) if c % 5]
    rows += [rows[0], rows[1]]
    return rows


@pytest.fixture(scope="module")
def odd_turns(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    return df.select("*", *[F.lit("x").alias(c) for c in ("content", "depth", "n", "w", "leaf", "one", "place", "f0")]).repartition(5)


@pytest.mark.parametrize("block", [1, 3, 4, 64])
def test_odd_conversations_with_blocks_of_any_length(odd_turns, block):
    assert got(prefix_trie.conversation_trie(odd_turns, block=block)) == trie(sequences(odd_rows()))


def test_rebuilt_conversations(spark, odd_turns):
    placed = prefix_trie.placed_turns(prefix_trie.turn_keys(odd_turns))
    ids = placed.select("conv_id").distinct()
    made = remade(sequences(odd_rows()))
    assert any(not s for s in made.values())  # turnless ones too
    assert got(prefix_trie.prefix_trie(rebuilt(placed, ids), ids)) == trie(made)


def test_node_texts(spark, odd_turns):
    nodes = prefix_trie.conversation_trie(odd_turns)
    convs = sequences(odd_rows())
    for r in prefix_trie.node_texts(nodes, odd_turns).collect():
        assert (r["role"], r["text"]) == (convs[r["conv_id"]][r["depth"] - 1] if r["depth"] else (None, None))


def test_empty_table(spark):
    assert got(prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA))) == []
    only = spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)
    assert got(prefix_trie.conversation_trie(only)) == []


def test_running_sums_over_many_parts(spark):
    rng = random.Random(3)
    rows = [(7 if rng.random() < 0.6 else rng.randrange(30), i, rng.randrange(10)) for i in range(3000)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 37)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        df = spark.createDataFrame(rows, "g bigint, i bigint, v bigint").repartition(9)
        done = ranged.ranged_sums(df, "g", [F.col("i")], ["v"], "test").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sums = defaultdict(int)
    want = set()
    for g, i, v in sorted(rows):
        want.add((g, i, v, sums[g]))
        sums[g] += v
    assert {tuple(r) for r in done} == want and len(done) == len(rows)
