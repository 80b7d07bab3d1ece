"""SimHash near-dedup: 64-bit fingerprints, linked by a self-join of their binary trie.

Documents with the same fingerprint form one class; the trie holds each fingerprint once.
A link needs at most ``max_bits`` differing bits.  Cut into ``max_bits + 1`` blocks, two linked
fingerprints agree in one block at least, so the trie is built once for each block, with that
block's bits on top, and joined with itself from the nodes below the block, where no bit differs yet:
node pairs are traversed together, their differing bits added up, and a pair is
dropped as soon as the sum exceeds ``max_bits``.

The nodes below a block are the unit of work.  A pair of nodes with more than ``LEAF`` fingerprints
on a side is expanded by ``STEP`` bits with Spark joins, level by level, until its parts are small; small pairs
are finished inside tasks, in numpy, several thousand at a time.  A task keeps a spanning
forest of the links that it finds, not the links.  (A fingerprint has at most 43,744 others
within 3 bits, whatever the corpus, so this work follows the number of distinct fingerprints.)

Defined cases: a null or empty text has fingerprint zero and is linked like any other; null ids never name a
component (``component_id`` is null if all ids in it are null); repeated rows are copies; extra
columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asklens.llm.common import join_groups, map_batches, numbered, written
from asklens.llm.components import components

SHINGLE = 3
MAX_BITS = 3
LEAF = 4096
STEP = 8
BLOCK_BYTES = 1 << 20  # of a text, hashed at a time

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)  # of a byte, lowest first


def _blocks(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time; cut at ASCII white space."""
    at = 0
    while at < len(raw):
        end = min(len(raw), at + BLOCK_BYTES)
        while end < len(raw) and raw[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield raw[at:end].split()
        at = end


def shingle_hashes(raw: bytes, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of all shingles of a lower-cased text, in blocks."""
    from xxhash import xxh64_intdigest

    carry: list[bytes] = []
    n = 0
    for words in _blocks(raw):
        n += len(words)
        words = carry + words
        if len(words) >= shingle:
            line = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words]).tolist()
            starts = [0, *ends]
            yield np.fromiter((xxh64_intdigest(line[s:e - 1], 42) for s, e in zip(starts, ends[shingle - 1:])),
                              dtype=np.uint64)
        carry = words[-(shingle - 1):] if shingle > 1 else []
    if 0 < n < shingle:
        yield np.array([xxh64_intdigest(b" ".join(carry), 42)], dtype=np.uint64)


def fingerprint(raw: bytes, shingle: int) -> int:
    """Bit b is 1 if it is set in over half the hashes; 0 without words.  Signed, as Spark's bigint."""
    ones, n = np.zeros((8, 256), dtype=np.int64), 0
    for h in shingle_hashes(raw, shingle):
        n += len(h)
        by_byte = h.astype("<u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            ones[k] += np.bincount(by_byte[:, k], minlength=256)
    set_bits = (ones @ _BITS).ravel()  # 64 counts, lowest bit first
    bits = np.packbits(2 * set_bits > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None,
                 shingle: int = SHINGLE) -> DataFrame:
    """row_no, doc_id, fp (bigint) of each row."""
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.encode().lower() if t else b"", shingle) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("row_no"), b.column("doc_id"), pa.array(fps, pa.int64())], ["row_no", "doc_id", "fp"])

    slim = docs.select(row.alias("row_no"), F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(slim, run, f"row_no {slim.schema['row_no'].dataType.simpleString()}, doc_id bigint, fp bigint")


# ---- the trie join -----------------------------------------------------------------

def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def forest(n: int, a: np.ndarray, b: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Smallest index reachable over links (a, b), starting from the labels ``root``; in place."""
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def trie_join(fps: np.ndarray, pairs: np.ndarray, errors: np.ndarray, depth: int, max_bits: int,
              chunk: int = 1 << 18) -> np.ndarray:
    """Links between node pairs, as each fingerprint's smallest linked index.

    ``fps`` is sorted inside every node; a node is a range.  ``pairs`` has rows (from, to, from, to), the two
    nodes equal or apart, all at ``depth`` bits; ``errors`` the bits in which the nodes differ.  The pairs are a
    stack: the top ``chunk`` of them go one bit down at a time, so memory stays bounded."""
    root = np.arange(len(fps))
    stack = [(pairs[i:i + chunk], errors[i:i + chunk], depth) for i in range(0, len(pairs), chunk)]
    while stack:
        p, e, d = stack.pop()
        one = (p[:, 1] - p[:, 0] == 1) & (p[:, 3] - p[:, 2] == 1)
        if d == 64:
            one[:] = True  # fingerprints are distinct: a range at full depth is one fingerprint
        if one.any():  # both nodes are one fingerprint: look at all bits left
            a, b = p[one, 0], p[one, 2]
            near = (a != b) & (_popcount(fps[a] ^ fps[b]) <= max_bits)
            forest(len(fps), a[near], b[near], root)
            p, e = p[~one], e[~one]
        if not len(p):
            continue
        bit = np.uint64(63 - d)
        mid_a, mid_b = _split(fps, p[:, 0], p[:, 1], bit), _split(fps, p[:, 2], p[:, 3], bit)
        same = (p[:, 0] == p[:, 2]) & (p[:, 1] == p[:, 3])
        kids, errs = [], []
        for left, right, more in ((0, 0, 0), (1, 1, 0), (0, 1, 1), (1, 0, 1)):
            lo_a, hi_a = (p[:, 0], mid_a) if not left else (mid_a, p[:, 1])
            lo_b, hi_b = (p[:, 2], mid_b) if not right else (mid_b, p[:, 3])
            ok = (hi_a > lo_a) & (hi_b > lo_b) & (e + more <= max_bits)
            if (left, right) == (1, 0):
                ok &= ~same  # a node with itself: its children's pair is there already
            kids.append(np.stack([lo_a[ok], hi_a[ok], lo_b[ok], hi_b[ok]], axis=1))
            errs.append(e[ok] + more)
        p, e = np.concatenate(kids), np.concatenate(errs)
        lone = (p[:, 0] == p[:, 2]) & (p[:, 1] - p[:, 0] == 1) & (p[:, 3] - p[:, 2] == 1)
        p, e = p[~lone], e[~lone]
        stack += [(p[i:i + chunk], e[i:i + chunk], d + 1) for i in range(0, len(p), chunk)]
    return root


def _split(fps: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.uint64) -> np.ndarray:
    """In each sorted range whose fingerprints agree above ``bit``: the first place where the bit is 1."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        zero = open_ & (((fps[np.minimum(mid, len(fps) - 1)] >> bit) & np.uint64(1)) == 0)
        one = open_ & ~zero
        lo[zero] = mid[zero] + 1
        hi[one] = mid[one]


def _leaf_links(max_bits: int):
    """Arrow batches sorted by (pair, side, fp) -> (turn, a, b), a spanning forest of the links in each."""

    def finish(t: pa.Table) -> pa.RecordBatch:
        pair, side = t.column("pair").to_numpy(), t.column("side").to_numpy()
        fps = t.column("fp").to_numpy().view(np.uint64)
        errors, depth = t.column("errors").to_numpy(), t.column("depth").to_numpy()
        cut = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (side[1:] != side[:-1])])
        end = np.r_[cut[1:], len(pair)]
        two = np.r_[pair[cut[1:]] == pair[cut[:-1]], False]  # this node is followed by its partner
        second = np.r_[False, two[:-1]]
        root = np.arange(len(fps))
        first = np.flatnonzero(~second)
        mate = np.where(two[first], first + 1, first)
        # a pair of different nodes whose partner has no row here cannot be: both nodes exist
        rows = np.stack([cut[first], end[first], cut[mate], end[mate]], axis=1)
        for d in np.unique(depth[cut[first]]):
            at = depth[cut[first]] == d
            part = trie_join(fps, rows[at], errors[cut[first]][at].astype(np.int64), int(d), max_bits)
            linked = np.flatnonzero(part != np.arange(len(part)))
            forest(len(fps), linked, part[linked], root)
        linked = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays(
            [pa.array(t.column("turn").to_numpy()[linked]), pa.array(fps[linked].view(np.int64)),
             pa.array(fps[root[linked]].view(np.int64))], ["turn", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            # all but the last pair are complete
            pair = b.column("pair").to_numpy()
            last = int(np.searchsorted(pair == pair[-1], True)) if pair[0] != pair[-1] else 0
            if last:
                yield finish(pa.Table.from_batches([*held, b.slice(0, last)]))
                held = [b.slice(last)]
            else:
                held.append(b)
        if held:
            yield finish(pa.Table.from_batches(held))

    return run


def _turned(fp, bits: int):
    """``fp`` rotated left by ``bits``."""
    return F.shiftleft(fp, bits).bitwiseOR(F.shiftrightunsigned(fp, 64 - bits)) if bits % 64 else fp


def _prefix(fp, depth: int):
    return F.shiftrightunsigned(fp, 64 - depth) if depth < 64 else fp


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, leaf: int = LEAF, step: int = STEP) -> DataFrame:
    """Distinct ``fps(fp)`` -> (a, b): links that span the same components as all links of ``max_bits`` bits."""
    width = 64 // (max_bits + 1)
    turned = F.explode(F.array(*[F.struct(F.lit(k).alias("turn"), _turned(F.col("fp"), k * width).alias("fp"))
                                 for k in range(max_bits + 1)])).alias("t")
    rows = written(fps.select(turned).select("t.turn", "t.fp"), "turned")

    def nodes(depth: int, below: DataFrame) -> DataFrame:
        return below.groupBy("turn", _prefix(F.col("fp"), depth).alias("node")).agg(F.count(F.lit(1)).alias("n"))

    depth, below = width, rows
    pairs = nodes(depth, rows).select("turn", F.col("node").alias("a"), F.col("node").alias("b"),
                                      F.lit(0).alias("errors"), F.col("n").alias("na"), F.col("n").alias("nb"))
    leaves = []
    while True:
        pairs = written(pairs.where("a <> b OR na > 1").withColumn("pair", F.monotonically_increasing_id()), "node-pairs")
        big = F.greatest("na", "nb") > leaf if depth < 64 else F.lit(False)
        small = pairs.where(~big)
        side = F.explode(F.expr("CASE WHEN a = b THEN array(struct(0 AS side, a AS node)) "
                                "ELSE array(struct(0 AS side, a AS node), struct(1 AS side, b AS node)) END")).alias("s")
        asked = small.select("turn", "pair", "errors", F.lit(depth).alias("depth"), side).select(
            "turn", "pair", "errors", "depth", "s.side", "s.node")
        found = asked.join(below.withColumn("node", _prefix(F.col("fp"), depth)), ["turn", "node"])
        dealt = (found.repartition("pair").sortWithinPartitions("pair", "side", "fp")
                 .select("turn", "pair", "errors", "depth", "side", "fp"))
        leaves.append(map_batches(dealt, _leaf_links(max_bits), "turn int, a bigint, b bigint"))
        if pairs.where(big).isEmpty():
            break
        # the large pairs go some bits down: children of both nodes, as far as the bits allow
        big_pairs = pairs.where(big)
        open_nodes = (big_pairs.select("turn", F.col("a").alias("node"))
                      .union(big_pairs.select("turn", F.col("b").alias("node"))).distinct())
        down = min(step, 64 - depth)
        keyed = below.withColumn("node", _prefix(F.col("fp"), depth))
        below = written(keyed.join(open_nodes, ["turn", "node"], "left_semi").select("turn", "fp"), "open-nodes")
        kids = written(nodes(depth + down, below), "children")
        left = kids.select("turn", F.shiftrightunsigned("node", down).alias("a"), F.col("node").alias("kid_a"),
                           F.col("n").alias("na"))
        right = kids.select("turn", F.shiftrightunsigned("node", down).alias("b"), F.col("node").alias("kid_b"),
                            F.col("n").alias("nb"))
        met = (big_pairs.select("turn", "a", "b", "errors").join(left, ["turn", "a"]).join(right, ["turn", "b"])
               .where("a <> b OR kid_a <= kid_b"))
        more = F.bit_count(F.col("kid_a").bitwiseXOR(F.col("kid_b")).bitwiseAND(F.lit((1 << down) - 1)))
        pairs = (met.withColumn("errors", (F.col("errors") + more).cast("int")).where(F.col("errors") <= max_bits)
                 .select("turn", F.col("kid_a").alias("a"), F.col("kid_b").alias("b"), "errors", "na", "nb"))
        depth += down
    links = leaves[0]
    for more_links in leaves[1:]:
        links = links.unionByName(more_links)

    def back(c):
        out = F.col(c)
        for k in range(1, max_bits + 1):
            out = F.when(F.col("turn") == k, _turned(F.col(c), 64 - k * width)).otherwise(out)
        return out

    return links.select(back("a").alias("a"), back("b").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None,
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: row_no, doc_id, fp, root (the component's fingerprint), component_id."""
    rows = written(fingerprints(docs, id_col, text_col, row_col, shingle), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "classes")
    linked = components(fingerprint_links(classes.select("fp"), max_bits))
    rooted = written(classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
                     .withColumn("root", F.coalesce("root", "fp")), "rooted")
    groups = written(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("fps")),
                     "components")
    named = written(join_groups(rooted, groups, ["root"], "fps").select("fp", "n", "root", "component_id"), "named")
    return join_groups(rows, named, ["fp"], "n").select("row_no", "doc_id", "fp", "root", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                     max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (nulls last, then the first row)."""
    rows, row = numbered(docs)
    found = near_duplicates(rows, id_col, text_col, row, shingle, max_bits)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_no")).alias("f"))
    return rows.join(first.select(F.col("f.row_no").alias(row)), row, "left_semi").drop(row)
