import random

import numpy as np
import pytest
import xxhash

from asklens.llm import simhash
from asklens.llm.components import components


def brute_fp(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, max_bits=3):
    """Index of the smallest reachable fingerprint by position, over all pairs."""
    fps = np.array(fps, dtype=np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= max_bits
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None, :], len(fps)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def expected(rows):
    fps = [brute_fp(t) for _, t in rows]
    label = brute_components(fps)
    least = {}
    for (doc, _), c in zip(rows, label):
        if doc is not None:
            least[c] = min(least.get(c, doc), doc)
    return sorted(((doc, fp, least.get(c)) for (doc, _), fp, c in zip(rows, fps, label)), key=repr)


def found(df):
    got = simhash.near_duplicates(df).collect()
    return sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got), key=repr)


def test_against_brute_force(docs, odd, none):
    for df in (docs, odd):
        assert found(df) == expected([(r["doc_id"], r["text"]) for r in df.collect()])
    assert found(none) == []


def test_blocks_of_a_long_text(monkeypatch):
    text = " ".join(random.Random(1).choice("abcdefg") * 3 for _ in range(500))
    whole = simhash.fingerprint(text.encode(), 3)
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 37)
    assert simhash.fingerprint(text.encode(), 3) == whole == np.uint64(brute_fp(text)).view(np.int64)


def clustered(rng, n):
    out = set()
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 5, 60])):
            out.add(x)
            for _ in range(rng.randrange(4)):
                x ^= 1 << rng.randrange(64)
    return sorted(out)


@pytest.mark.parametrize("leaf,step", [(4096, 8), (3, 8), (1, 5)])
def test_trie_join_links(spark, leaf, step):
    """Small leaves force the node pairs down level by level in Spark; the links' components stay the same."""
    fps = clustered(random.Random(leaf), 700)
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp bigint")
    links = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.fingerprint_links(df, 3, leaf, step).collect()]
    assert len(links) <= 4 * len(fps) * (1 if leaf > 1000 else 64)
    place = {x: i for i, x in enumerate(fps)}
    label = simhash.forest(len(fps), np.array([place[a] for a, _ in links]), np.array([place[b] for _, b in links]), np.arange(len(fps)))
    assert (label == brute_components(fps)).all()


def test_dense_prefix(spark):
    """Fingerprints that share their first 48 bits: one node holds all of them."""
    rng = random.Random(5)
    fps = sorted(rng.sample(range(1 << 16), 400))
    df = spark.createDataFrame([(x + (0x1234 << 48),) for x in fps], "fp bigint")
    links = [(r["a"] & 0xFFFF, r["b"] & 0xFFFF) for r in simhash.fingerprint_links(df, 3, 50, 8).collect()]
    place = {x: i for i, x in enumerate(fps)}
    label = simhash.forest(len(fps), np.array([place[a] for a, _ in links]), np.array([place[b] for _, b in links]), np.arange(len(fps)))
    assert (label == brute_components(fps)).all()


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(70, 70)]
    random.Random(2).shuffle(chain)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(50)}}


def test_drop_near_copies(odd, docs, none):
    for df in (odd, docs):
        left = simhash.drop_near_copies(df)
        assert left.columns == df.columns
        rows = [(r["doc_id"], r["text"]) for r in df.collect()]
        assert left.count() == len(set(brute_components([brute_fp(t) for _, t in rows])))
        kept = {r["doc_id"] for r in left.collect()}
        assert {c for _, _, c in expected(rows)} <= kept
    assert simhash.drop_near_copies(none).count() == 0


def test_near_copies_link(spark):
    base = [f"w{i}" for i in range(400)]
    near = [*base[:200], "changed", *base[201:]]
    df = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(near)), (3, "something else entirely here")], "doc_id bigint, text string")
    got = {d: c for d, _, c in found(df)}
    assert got[3] == 3 and (got[2] == 1) == (bin(brute_fp(" ".join(base)) ^ brute_fp(" ".join(near))).count("1") <= 3)
